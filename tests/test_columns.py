"""Bounds, NULLs and forms that the given tables do not hold."""

import math

import pytest
from pyspark.sql import functions as F

from clipsense.functions import events as E
from clipsense.functions import items as C
from clipsense.functions import users as U
from clipsense.functions import weights as W
from clipsense.functions.rules import hash_fraction


def values(df, name="r"):
    return [row[name] for row in df.collect()]


def test_view_weight_bounds_are_strict(spark):
    rows = [(x,) for x in (0.3, 0.30001, 0.5, 0.6, 0.7, 0.8, 0.80001, None, 1.2)]
    df = spark.createDataFrame(rows, "c double").coalesce(1)
    assert values(df.select(W.view_weight(F.col("c")).alias("r"))) == [0.5, 1.0, 1.0, 3.0, 3.0, 3.0, 5.0, 0.5, 5.0]


def test_interaction_and_loader_weights(spark):
    kinds = ["like", "share", "comment", "skip", "view", "other", None]
    df = spark.createDataFrame([(k,) for k in kinds], "k string").coalesce(1)
    assert values(df.select(W.interaction_weight(F.col("k")).alias("r"))) == [10.0, 15.0, 8.0, -2.0, 1.0, 1.0, 1.0]
    assert values(df.select(W.loader_weight(F.col("k")).alias("r"))) == [2.0, 4.0, 3.0, None, 1.0, None, None]


def test_unknown_weight_scale_is_refused(spark):
    with pytest.raises(ValueError):
        W.event_weight(F.lit("view"), F.lit(1.0), scale="both")


def test_tag_forms(spark):
    forms = [None, "", "a|b, c", "a, b", "a", "a| b"]
    df = spark.createDataFrame([(f,) for f in forms], "t string").coalesce(1)
    assert values(df.select(C.parse_tags(F.col("t")).alias("r"))) == [[], [], ["a", "b, c"], ["a", "b"], ["a"], ["a", " b"]]


def test_user_without_views_is_not_at_the_cap(spark):
    row = "select 0L total_views, 1L total_likes, 0L total_comments, 0L total_shares, 1.0D engagement_rate, cast(null as double) avg_completion_rate"
    df = spark.sql(row)
    assert df.select(U.user_score()).first()[0] == 52.0
    assert df.select(U.user_score(null_as_max=True)).first()[0] == 100.0


def test_user_type_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (80.0, 79.9, 50.0, 20.0, 19.9, None)], "s double").coalesce(1)
    expected = ["power_user", "active_user", "active_user", "casual_user", "new_user", "new_user"]
    assert values(df.select(U.user_type(F.col("s")).alias("r"))) == expected


def test_completion_is_clamped_and_safe(spark):
    df = spark.createDataFrame([(90.0, 60.0), (30.0, 60.0), (5.0, 0.0), (None, 60.0)], "w double, d double").coalesce(1)
    assert values(df.select(E.completion(F.col("w"), F.col("d")).alias("r"))) == [1.0, 0.5, None, None]


def test_rating_without_value_is_a_skip(spark):
    df = spark.createDataFrame([(4.0,), (3.0,), (2.9,), (None,)], "x double").coalesce(1)
    assert values(df.select(E.rating_event_type(F.col("x")).alias("r"))) == ["like", "view", "skip", "skip"]


def test_event_time_takes_iso_text_and_milliseconds(spark):
    raw = ["2024-01-01T00:00:01.500000", "1704067201500", "soon", None]
    df = spark.createDataFrame([(x,) for x in raw], "t string").coalesce(1)
    stamps = values(df.select(F.unix_micros(E.event_time(F.col("t"))).alias("r")))
    assert stamps == [1704067201500000, 1704067201500000, None, None]


def test_search_ignores_case_and_null(spark):
    df = spark.createDataFrame([("Red Bolt", None), (None, "BOLTS"), (None, None), ("nut", "x")], "a string, b string")
    assert df.filter(C.matches("bOlT", F.col("a"), F.col("b"))).count() == 2


def test_age_counts_begun_days(spark):
    df = spark.sql(
        "select 10L view_count, 1L like_count, 0L share_count, 0L comment_count, explode(array("
        "timestamp'2024-01-03 00:00:00', timestamp'2024-01-01 12:00:00', timestamp'2024-01-04 00:00:00')) created_at"
    ).coalesce(1)
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    assert values(df.select(C.engagement_age_score(F.col("created_at"), now).alias("r"))) == [15.0, 7.5, 15.0]


def test_hash_fraction_is_even_and_repeatable(spark):
    df = spark.range(20_000).select(hash_fraction("s", F.col("id")).alias("r"))
    first, second = values(df), values(df)
    assert first == second and all(0 <= x < 1 for x in first)
    assert math.isclose(sum(x < 0.3 for x in first) / len(first), 0.3, abs_tol=0.02)
