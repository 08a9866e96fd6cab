"""Catalog search by a posting table of trigrams.

The table has a row for each video and each run of three characters in one of the
searched columns, in lower case, in order of the runs, so that a reader skips
most of it. A pattern of three characters and more can only be in videos that
have all its runs; those few are looked up in the catalog and the pattern is
looked for in them. Shorter patterns scan the catalog. Either way the rows are
those of ``catalog.search``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsense.operators.catalog import search

GRAM = 3
COLUMNS = ("title", "video_id", "category")


def grams(text: Column) -> Column:
    """The different runs of three characters; null in a null text, none in a short one."""
    places = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    runs = F.array_distinct(F.transform(places, lambda at: F.substring(text, at, GRAM)))
    return F.when(F.length(text) >= GRAM, runs).otherwise(F.array().cast("array<string>"))


def postings(catalog: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """gram and video_id, each pair once.

    Rows of one video meet while they are texts, so that no task keeps the pairs to compare them.
    """
    tasks = int(catalog.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = F.array(*[F.lower(F.coalesce(c, F.lit(""))) for c in columns])
    rows = catalog.select("video_id", texts.alias("texts")).repartition(tasks, "video_id").groupBy("video_id").agg(F.flatten(F.collect_set("texts")).alias("texts"))
    every = F.array_distinct(F.flatten(F.transform("texts", grams)))
    return rows.select("video_id", F.explode(every).alias("gram"))


def write_postings(catalog: DataFrame, path: str, columns: tuple[str, ...] = COLUMNS) -> None:
    """In order of the runs; a common one may lie in several files."""
    postings(catalog, columns).repartitionByRange("gram", "video_id").sortWithinPartitions("gram", "video_id").write.mode("overwrite").parquet(path)


def candidates(index: DataFrame, pattern: str) -> DataFrame | None:
    """The videos that have all runs of the pattern; None where it is too short to have one."""
    wanted = index.sparkSession.range(1).select(grams(F.lower(F.lit(pattern))).alias("g")).first()["g"]
    if not wanted:
        return None
    held = index.filter(F.col("gram").isin(wanted)).groupBy("video_id").agg(F.count("*").alias("n"))
    return held.filter(F.col("n") == len(wanted)).select("video_id")


def search_indexed(index: DataFrame, catalog: DataFrame, pattern: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The rows of ``catalog.search``, from an index over the same columns."""
    held = candidates(index, pattern)
    return search(catalog if held is None else catalog.join(held, "video_id", "left_semi"), pattern, columns)
