"""Running sums and gapless numbers over groups of any size.

A window over a whole group would sort a hot group in one task. Here rows are
dealt to buckets by a hash of their order columns, each bucket is summed by
itself, and the bucket totals, a few rows a group, are summed after that. The
order of rows is by bucket, then by the order columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a bucket has on average.
BUCKET_ROWS = 4_000


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def running(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], weight: Column, name: str, buckets: int
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the group that come before.

    Rows must be told apart by the order columns, or be equal; null groups are groups.
    """
    marked = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    keys = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy(*keys).agg(F.sum(weight).alias("_total")).select(
        *[F.col(key).alias(f"_at_{key}") for key in keys],
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"),
    )
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = marked.withColumn("_within", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    same = [F.col(key).eqNullSafe(F.col(f"_at_{key}")) for key in keys]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    return within.join(starts, on).withColumn(name, (F.col("_start") + F.col("_within")).cast("long")).drop(
        "_bucket", "_start", "_within", *[f"_at_{key}" for key in keys]
    )
