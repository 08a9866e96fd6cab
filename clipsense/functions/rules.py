"""Column builders for step and lookup tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def steps(value: Column, bounds: Iterable[tuple[float, Any]], other: Any, strict: bool = False) -> Column:
    """The result of the first bound that ``value`` reaches (passes, if strict).

    NULL reaches no bound and gets ``other``.
    """
    chain = F
    for bound, result in bounds:
        test = value > F.lit(bound) if strict else value >= F.lit(bound)
        chain = chain.when(test, F.lit(result))
    return chain.otherwise(F.lit(other))


def lookup(key: Column, table: Mapping[str, Any], other: Any) -> Column:
    """``table[key]``, or ``other`` for keys that are missing or NULL."""
    chain = F
    for name, result in table.items():
        chain = chain.when(key == F.lit(name), F.lit(result))
    return chain.otherwise(F.lit(other))


def weighted_sum(terms: Mapping[str, float]) -> Column:
    return reduce(lambda a, b: a + b, (F.col(name) * F.lit(w) for name, w in terms.items()))


def hash_fraction(salt: str, *keys: Column) -> Column:
    """A repeatable number in [0, 1) drawn from the key columns.

    First 32 bits of md5, so other SQL engines can compute the same draw.
    """
    digest = F.md5(F.concat_ws("|", F.lit(salt), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def micros(time: Column) -> Column:
    """Microseconds since the epoch, for either timestamp type (UTC session)."""
    return F.unix_micros(time.cast("timestamp"))
