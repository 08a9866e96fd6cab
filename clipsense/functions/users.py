"""Columns about users: scores, types, method weights."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.rules import lookup, steps, weighted_sum


def engagement_rate() -> Column:
    acts = F.col("total_likes") + F.col("total_comments") + F.col("total_shares")
    return acts / (F.col("total_views") + 1)


def user_score(null_as_max: bool = False) -> Column:
    """Capped activity score.

    Without views the completion is NULL; it counts as 0 unless
    ``null_as_max`` asks for the old result, where ``least`` skips the NULL
    sum and gives the cap.
    """
    terms = dict(V.USER_SCORE_TERMS)
    share = F.col("avg_completion_rate")
    if not null_as_max:
        share = F.coalesce(share, F.lit(0.0))
    total = share * terms.pop("avg_completion_rate") + weighted_sum(terms)
    return F.least(F.lit(V.USER_SCORE_MAX), total)


def user_type(score: Column) -> Column:
    return steps(score, V.USER_TYPE_STEPS, V.USER_TYPE_OTHER)


def diversity_bonus(methods: Column) -> Column:
    return steps(methods, V.DIVERSITY_STEPS, 0.0)


def method_weight(user_type: Column, method: Column) -> Column:
    """Weight of a method for a user type; a NULL type means no profile."""
    chain = F.when(user_type.isNull(), lookup(method, V.METHOD_WEIGHTS_UNKNOWN, None))
    for name, weights in V.METHOD_WEIGHTS.items():
        chain = chain.when(user_type == name, lookup(method, weights, None))
    return chain.otherwise(lookup(method, V.METHOD_WEIGHTS_PROFILED, None))


def segment_label(position: Column) -> Column:
    """Name of the n-th cluster, counted from 0."""
    chain = F
    for i, name in enumerate(V.SEGMENT_LABELS):
        chain = chain.when(position == i, F.lit(name))
    return chain.otherwise(F.lit(V.SEGMENT_OTHER))
