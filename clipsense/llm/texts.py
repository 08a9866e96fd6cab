"""What the text operators share: words, batches of documents, row keys.

A word is a run of characters other than blank, tab, line feed, vertical tab,
form feed and carriage return. ``bytes.split()`` splits at exactly these six
characters, ``bytes.lower()`` lowers A-Z only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

WHITE = " \t\n\x0b\x0c\r"
#: The same words in Spark's regular expressions.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows of a batch that a task holds as Python objects at once.
SLICE = 256

RowFunction = Callable[..., tuple]


def n_words(text: Column) -> Column:
    """Words of a text; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_WORD = re.compile(WORD)


def word_spans(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the words, in code points."""
    spans = [m.span() for m in _WORD.finditer(text)]
    return [s for s, _ in spans], [e for _, e in spans]


def split_words(text: str) -> list[str]:
    """The words; ``str.split()`` would also split at other white space, which belongs to words here."""
    return [word.decode() for word in text.encode().split()]


def row_key(columns: Sequence[str]) -> Column:
    """The same number for equal rows; it joins results back without multiplying repeated rows."""
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def per_row(df: DataFrame, columns: Sequence[str], make: Callable[[], RowFunction], schema: str) -> DataFrame:
    """Apply a Python function to the given columns of each row, in Arrow batches.

    ``make`` runs once in a task and returns the function; that takes one row's
    values and returns the values of ``schema``. Other columns of ``df`` are
    not read, so no name can clash.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for part in slices(batches):
            rows = [apply(*values) for values in zip(*(c.to_pylist() for c in part.columns))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind.type) for values, kind in zip(zip(*rows), arrow)], schema=arrow
            )

    return df.select(*columns).mapInArrow(run, schema)


def with_value(df: DataFrame, columns: Sequence[str], make: Callable[[], Callable], name: str, kind: str) -> DataFrame:
    """All columns of ``df`` and one more, computed in Python from the given ones."""
    at = [df.columns.index(c) for c in columns]
    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"`{name}` {kind}").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for part in slices(batches):
            values = [apply(*row) for row in zip(*(part.column(i).to_pylist() for i in at))]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, arrow[-1].type)], names=arrow.names)

    return df.mapInArrow(run, schema)
