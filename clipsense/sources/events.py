"""Event topics: JSON values to typed columns, batch and streaming alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipsense import fixed_values as V
from clipsense import schemas
from clipsense.functions.events import comment_length, event_time


def kafka_topics(spark: SparkSession, servers: str, topics: Sequence[str] = V.TOPICS, **options: str) -> DataFrame:
    """Stream of ``value`` strings from Kafka; needs the Kafka package on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "latest")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_topic(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of ``value`` strings from files of JSON lines."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _parse(values: DataFrame, schema: T.StructType) -> DataFrame:
    """Exploded, a value is parsed once; a projection would be copied into the filter, and parse anew for each field there."""
    return values.select(F.col("value"), F.explode(F.array(F.from_json("value", schema))).alias("data"))


def _empty(schema: T.StructType) -> Column:
    """Whether a value was no JSON object, or held none of the fields."""
    return F.coalesce(*[F.col(f"data.{f}").cast("string") for f in schema.names]).isNull()


def rejects(values: DataFrame, schema: T.StructType = schemas.VIEW_EVENT) -> DataFrame:
    """Values that are not JSON objects, or hold none of the fields, as they arrived."""
    return _parse(values, schema).filter(_empty(schema)).select("value")


def accepted(values: DataFrame, schema: T.StructType) -> DataFrame:
    """The other values, parsed: value and data."""
    return _parse(values, schema).filter(~_empty(schema))


def view_events(values: DataFrame) -> DataFrame:
    """Nine nullable columns of the view-event topic; see ``rejects`` for what is left out."""
    return accepted(values, schemas.VIEW_EVENT).select("data.*")


def interaction_events(values: DataFrame) -> DataFrame:
    """Six columns of the interaction topic; the length may come from the text."""
    names = [n for n in schemas.INTERACTION_EVENT.names if not n.startswith("comment_")]
    return accepted(values, schemas.INTERACTION_EVENT).select(
        *[f"data.{n}" for n in names],
        comment_length(F.col("data.comment_length"), F.col("data.comment_text")).alias("comment_length"),
    )


def item_events(values: DataFrame) -> DataFrame:
    return accepted(values, schemas.ITEM_METADATA_EVENT).select("data.*")


def timed(events: DataFrame) -> DataFrame:
    """Add ``event_time`` TIMESTAMP parsed from the text ``timestamp``."""
    return events.withColumn("event_time", event_time(F.col("timestamp")))
