"""A collection of JSON documents in a folder as a data source of its own.

    register(spark)
    spark.read.format("json_collection").schema(...).load(folder)
    spark.readStream.format("json_collection").schema(...).load(folder)

Files hold one document a line. A read has one partition for each ``files``
files; comparisons of plain columns with constants are taken over and applied
while documents are read, before rows are made. A stream goes on from the file names
it has seen: new documents come in files whose names follow those before, at most
``files_per_batch`` in a batch. Folders are reached through Arrow's file systems,
so paths may be of any store that these know. Broken lines give a row of nulls in
``PERMISSIVE`` mode and are left out in ``DROPMALFORMED``, the default.

``register`` also turns on ``spark.sql.python.filterPushdown.enabled``, without which
Spark takes no source that pushes filters down.
"""

from __future__ import annotations

import json
import operator
from collections.abc import Iterable, Iterator
from datetime import date, datetime

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual,
)

_COMPARE = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
}


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


def _listed(folder: str) -> list[str]:
    """The folder's data files, in order of their names."""
    store, path = _store(folder)
    found = store.get_file_info(fs.FileSelector(path, recursive=False))
    names = [f.base_name for f in found if f.is_file]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), folder


def _converted(value: object, kind: T.DataType) -> object:
    """A JSON value as the column's type has it; null where it does not fit."""
    if value is None:
        return None
    try:
        if isinstance(kind, T.StringType):
            return value if isinstance(value, str) else json.dumps(value)
        if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
            return int(value) if not isinstance(value, bool) and float(value) == int(float(value)) else None
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return float(value) if not isinstance(value, bool) else None
        if isinstance(kind, T.BooleanType):
            return value if isinstance(value, bool) else None
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return datetime.fromisoformat(value)
        if isinstance(kind, T.DateType):
            return date.fromisoformat(value)
        if isinstance(kind, T.ArrayType):
            return [_converted(v, kind.elementType) for v in value] if isinstance(value, list) else None
        if isinstance(kind, T.StructType):
            return tuple(_converted(value.get(f.name), f.dataType) for f in kind.fields) if isinstance(value, dict) else None
    except (ValueError, TypeError, AttributeError):
        return None
    raise TypeError(f"no JSON form of {kind.simpleString()}")


class _Documents:
    """Reads the documents of a partition; shared by batch and stream."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.folder = schema, options["path"].rstrip("/")
        self.permissive = options.get("mode", "DROPMALFORMED").upper() == "PERMISSIVE"
        self.files = int(options.get("files", 1))
        self.files_per_batch = int(options.get("files_per_batch", 1_000))
        self.wanted: list[Filter] = []

    def holds(self, row: tuple) -> bool:
        for f in self.wanted:
            value = row[self.schema.names.index(f.attribute[0])]
            if value is None:
                return False
            if isinstance(f, In) and value not in f.value:
                return False
            if type(f) in _COMPARE and not _COMPARE[type(f)](value, f.value):
                return False
        return True

    def partitions_of(self, names: list[str]) -> list[Files]:
        return [Files(names[at : at + self.files]) for at in range(0, len(names), self.files)]

    def rows(self, partition: Files) -> Iterator[tuple]:
        store, path = _store(self.folder)
        for name in partition.paths:
            with store.open_input_stream(f"{path}/{name}", compression="detect") as stream:
                for line in _lines(stream):
                    try:
                        document = json.loads(line)
                    except ValueError:
                        document = None
                    if not isinstance(document, dict):
                        if not self.permissive:
                            continue
                        document = {}
                    row = tuple(_converted(document.get(f.name), f.dataType) for f in self.schema.fields)
                    if self.holds(row):
                        yield row


def _lines(stream: Iterable) -> Iterator[bytes]:
    """Lines with something in them, a piece of the file at a time."""
    rest = b""
    while piece := stream.read(1 << 20):
        *whole, rest = (rest + piece).split(b"\n")
        yield from (line for line in whole if line.strip())
    if rest.strip():
        yield rest


class Reader(_Documents, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes over comparisons of plain columns; hands back the others."""
        for f in filters:
            plain = isinstance(f, (In, IsNotNull, *_COMPARE)) and len(f.attribute) == 1
            if plain and isinstance(self.schema[f.attribute[0]].dataType, (T.StringType, T.NumericType, T.BooleanType)):
                self.wanted.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        return self.partitions_of(_listed(self.folder))

    def read(self, partition: Files) -> Iterator[tuple]:
        return self.rows(partition)


class StreamReader(_Documents, DataSourceStreamReader):
    """Offsets are names of files; a batch has those behind the start and up to the end."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        super().__init__(schema, options)
        self.reached = ""

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        names = [name for name in _listed(self.folder) if name > self.reached][: self.files_per_batch]
        self.reached = names[-1] if names else self.reached
        return {"after": self.reached}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        self.reached = max(self.reached, end["after"])
        return self.partitions_of([name for name in _listed(self.folder) if start["after"] < name <= end["after"]])

    def read(self, partition: Files) -> Iterator[tuple]:
        return self.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class JsonCollection(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_collection"

    def schema(self) -> str:
        raise ValueError("give the collection a schema")

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(schema, dict(self.options))

    def streamReader(self, schema: T.StructType) -> StreamReader:
        return StreamReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(JsonCollection)
