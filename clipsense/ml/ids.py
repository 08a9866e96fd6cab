"""Dense integer ids for users and videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 3


def id_index(df: DataFrame, key: str, name: str, digits: int = PREFIX_DIGITS) -> DataFrame:
    """(key, name): ids from 0 without gaps, the same on every run.

    Order is by the first hex digits of md5, then by the key. Keys are numbered
    inside their digit group, and the 16^digits group sizes are summed up to
    offsets, so no window ever sees all keys.
    """
    keys = df.select(key).distinct().filter(F.col(key).isNotNull())
    grouped = keys.withColumn("_group", F.substring(F.md5(F.col(key).cast("string")), 1, digits))
    sizes = grouped.groupBy("_group").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_group", F.coalesce(before, F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_group").orderBy(key))
    # At most 16^digits offset rows, so this side is small by construction.
    return grouped.withColumn("_place", place).join(F.broadcast(offsets), "_group").select(
        key, (F.col("_offset") + F.col("_place") - 1).cast("int").alias(name)
    )


def indexed(df: DataFrame, users: DataFrame, videos: DataFrame) -> DataFrame:
    """Add both ids; rows with an unknown user or video are dropped."""
    return df.join(users, "user_id").join(videos, "video_id")


def extended_index(known: DataFrame, df: DataFrame, key: str, name: str, digits: int = PREFIX_DIGITS) -> DataFrame:
    """The known ids as they are, and numbers behind them, without gaps, for keys that are new.

    ``known`` (key, name) must be stored, as a saved model has it; new keys are
    numbered like those of ``id_index``, from the first number that is free.
    """
    new = id_index(df.join(known.select(key), key, "left_anti"), key, name, digits)
    first = known.agg(F.coalesce(F.max(name) + 1, F.lit(0)).cast("int").alias("_first"))
    # One row.
    behind = new.join(F.broadcast(first)).select(key, (F.col(name) + F.col("_first")).cast("int").alias(name))
    return known.select(key, F.col(name).cast("int").alias(name)).unionByName(behind)
