"""Media files of a folder, joined to the catalog."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsense.functions.items import media_url


STEM = r"([^/]+)\.[^./]+$"


def media_files(spark: SparkSession, folder: str, pattern: str = "*.mp4", id_pattern: str = STEM) -> DataFrame:
    """Id (the file stem) and size; file contents are pruned and never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(F.regexp_extract("path", id_pattern, 1).alias("video_id"), "length")
    )


def media_inventory(files: DataFrame, catalog: DataFrame) -> DataFrame:
    return files.join(catalog, "video_id", "left").select(
        "*",
        F.lit(True).alias("has_file"),
        media_url(F.col("video_id"), "stream").alias("stream_url"),
        media_url(F.col("video_id"), "cover").alias("cover_url"),
    )


def media_stats(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
