"""Top-k per key and overall, always with the id as second sort key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows per key.

    ``row_number() <= k`` is pruned inside each task before the shuffle
    (WindowGroupLimit), so a hot key sends at most k rows per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top(df: DataFrame, score: str, tie: str, n: int) -> DataFrame:
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(n)


def ranked_top(df: DataFrame, score: str, tie: str, n: int) -> DataFrame:
    """``top`` with a rank column; the window only sees the n rows left."""
    window = Window.orderBy(F.col(score).desc_nulls_last(), F.col(tie))
    return top(df, score, tie, n).withColumn("rank", F.row_number().over(window))
