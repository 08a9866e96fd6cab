"""Columns about single events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.rules import lookup, steps


def completion(watch_time: Column, duration: Column) -> Column:
    """Watched share, at most 1; NULL for a zero or missing duration."""
    share = F.try_divide(watch_time, duration)
    return F.when(share.isNotNull(), F.least(F.lit(1.0), share))


def rating_event_type(rating: Column) -> Column:
    return steps(F.coalesce(rating, F.lit(0.0)), V.RATING_STEPS, V.RATING_OTHER)


def topic(event_type: Column) -> Column:
    return lookup(event_type, V.TOPIC_BY_EVENT, V.TOPIC_OTHER)


def has_required_fields() -> Column:
    return reduce(lambda a, b: a & b, (F.col(f).isNotNull() for f in V.REQUIRED_EVENT_FIELDS))


def comment_length(length: Column, text: Column) -> Column:
    """The length sent with the event, else that of the text."""
    return F.coalesce(length, F.length(text))


def event_time(raw: Column) -> Column:
    """ISO text or epoch milliseconds as text, to TIMESTAMP; NULL if neither."""
    millis = F.when(raw.rlike(r"^\d+$"), raw.try_cast("bigint"))
    return F.coalesce(F.timestamp_millis(millis), F.try_to_timestamp(raw))
