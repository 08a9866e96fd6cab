"""The checked queries, each next to its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(fn(spark, sf_dir.rstrip("/")))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def present(df: DataFrame) -> DataFrame:
    """Plain column types that compare alike in both engines.

    Nine decimals: sums differ between engines in the last bits only, and means
    of the given two-decimal values seldom end exactly half-way between two
    such numbers, as they often do for six.
    """
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind in ("double", "float") or kind.startswith("decimal"):
            column = F.round(column.cast("double"), 9)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "array<string>":
            column = F.array_join(column, "|")
        columns.append(column.alias(name))
    return df.select(*columns)
