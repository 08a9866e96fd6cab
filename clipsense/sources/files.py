"""Readers of the text files the data sets ship as."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsense import schemas

_CSV = {"quote": '"', "escape": '"'}


def pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """user,item,timestamp(ms) with a header; userID,videoID is also accepted.

    Reading starts from the text columns, so there is no inference pass.
    """
    raw = spark.read.option("header", True).options(**_CSV).csv(path)
    user = "user" if "user" in raw.columns else "userID"
    item = "item" if "item" in raw.columns else "videoID"
    return raw.select(
        F.col(user).alias("user_id"),
        F.col(item).alias("video_id"),
        F.col("timestamp").try_cast("bigint").alias("timestamp"),
    )


def _without_header(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.filter(F.col("video_id").isNull() | ~F.col("video_id").isin(*names))


def titles_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(schemas.TITLES).options(**_CSV).csv(path)
    return _without_header(df, ("video_id", "videoID", "item"))


def likes_views_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LIKES_VIEWS).option("sep", "\t").csv(path)


def tags_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(schemas.TAGS).options(**_CSV).csv(path)
    return _without_header(df, ("video_id", "videoID", "item"))


def comments_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Quotes are plain text in comments, so quoting is off."""
    return spark.read.schema(schemas.COMMENTS).options(sep="\t", quote="").csv(path)


def sequence_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``user \\t v1 v2 …`` in time order, to one row per position."""
    parts = F.split(F.col("value"), "\t", 2)
    return (
        spark.read.text(path)
        .select(parts[0].alias("user_id"), F.split(F.trim(parts[1]), " +").alias("sequence"))
        .select("user_id", F.posexplode("sequence").alias("pos", "video_id"))
    )


def item_attributes_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ITEM_ATTRIBUTES).option("header", True).csv(path)


def user_attributes_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.USER_ATTRIBUTES).option("header", True).csv(path)


def flag_rows_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FLAG_ROWS).option("header", True).csv(path)


def collection(spark: SparkSession, folder: str, name: str, schema=None) -> DataFrame:
    """A stored table. With a schema, a table not yet written reads as empty."""
    path = f"{folder}/{name}"
    if schema is None:
        return spark.read.parquet(path)
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jvm_path)


def first_existing(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """The first of the candidate CSV files that is there."""
    for name in names:
        path = f"{folder}/{name}"
        if _exists(spark, path):
            return spark.read.option("header", True).options(**_CSV).csv(path)
    raise FileNotFoundError(f"none of {', '.join(names)} in {folder}")
