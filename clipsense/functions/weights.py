"""Event weights. Two scales exist; callers name the one they want."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsense import fixed_values as V
from clipsense.functions.rules import lookup, steps


def view_weight(completion: Column) -> Column:
    return steps(completion, V.VIEW_WEIGHT_STEPS, V.VIEW_WEIGHT_OTHER, strict=True)


def interaction_weight(event_type: Column) -> Column:
    return lookup(event_type, V.INTERACTION_WEIGHTS, V.INTERACTION_WEIGHT_OTHER)


def loader_weight(event_type: Column) -> Column:
    return lookup(event_type, V.LOADER_WEIGHTS, None)


def event_weight(event_type: Column, completion: Column, scale: str = "streaming") -> Column:
    if scale == "loader":
        return loader_weight(event_type)
    if scale != "streaming":
        raise ValueError(f"unknown weight scale: {scale}")
    return F.when(event_type == "view", view_weight(completion)).otherwise(
        interaction_weight(event_type)
    )
