"""Streaming jobs. Each takes and returns DataFrames; ``run`` starts them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clipsense import fixed_values as V
from clipsense.functions.events import has_required_fields, topic
from clipsense.functions.weights import event_weight, interaction_weight, view_weight
from clipsense.operators.recency import interaction_counter, latest_first
from clipsense.operators.ranking import top_per_key


def with_processing_time(events: DataFrame) -> DataFrame:
    return events.withColumn("processing_time", F.current_timestamp())


def weighted_views(views: DataFrame) -> DataFrame:
    return with_processing_time(views).withColumn("weight", view_weight(F.col("completion_rate")))


def weighted_interactions(events: DataFrame) -> DataFrame:
    return events.withColumn("weight", interaction_weight(F.col("event_type")))


def weighted_events(events: DataFrame) -> DataFrame:
    return events.withColumn("weight", event_weight(F.col("event_type"), F.col("completion_rate")))


def run(df: DataFrame, path: str, checkpoint: str, name: str, mode: str = "append", once: bool = False) -> StreamingQuery:
    """Write a stream to a table. ``once`` takes what is there and stops."""
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.format("parquet").start(path)


def run_batches(df: DataFrame, handle, checkpoint: str, name: str, mode: str = "append", once: bool = False) -> StreamingQuery:
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(handle).start()


#: The name under which the console's progress reports count the rows of a batch.
CONSOLE_ROWS = "console"


def run_console(df: DataFrame, checkpoint: str, name: str, rows: int = 5, once: bool = False) -> StreamingQuery:
    """Print the first rows of each batch in full; a progress report's ``observedMetrics`` count all of them.

    Every row of a batch is read, but a task sends only its first ones: the console
    format of the library gathers whole batches in the driver.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        place = F.monotonically_increasing_id()
        first = batch.withColumn("_place", place).orderBy("_place").limit(rows + 1).drop("_place")
        print(f"{'-' * 43}\nBatch: {batch_id}\n{'-' * 43}")
        first.show(rows, truncate=False)

    counted = df.observe(CONSOLE_ROWS, F.count(F.lit(1)).alias("rows"))
    return run_batches(counted, show, checkpoint, name, once=once)


def batch_folder(run: str, batch_id: int) -> str:
    """The folder of one batch of one run.

    A run is the life of one checkpoint: replaying its batch replaces that
    batch's folder, and a new checkpoint counts its batches under a name of its own.
    """
    return f"run={run}/batch_id={batch_id}"


def batch_folder_writer(path: str, run: str):
    """Each batch replaces its own folder, so a replayed batch is not added twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{batch_folder(run, batch_id)}")

    return write


#: The run name of compacted data.
COMPACTED = "compacted"


class ProfileTables:
    """Interactions, counters and last videos per user, kept up to date by a stream.

    A batch only adds what it changes: its rows, its counts per user, its last
    rows per user, each to a folder named after the run and the batch. Give each
    checkpoint a run name of its own, or a reset checkpoint replaces old batches.
    Readers merge the folders; ``compact`` folds them into one when they grow many.
    """

    def __init__(self, spark: SparkSession, path: str, run: str, keep: int = 100):
        if run == COMPACTED:
            raise ValueError(f"{COMPACTED} is the name of compacted data")
        self.spark, self.path, self.run, self.keep = spark, path, run, keep

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        # Cached for this batch's three writes only; lost blocks are recomputed.
        batch = batch.persist()
        try:
            parts = {
                "interactions": batch,
                "counters": interaction_counter(batch),
                "recent": top_per_key(batch, "user_id", latest_first(), self.keep).drop("rank"),
            }
            for name, df in parts.items():
                df.write.mode("overwrite").parquet(f"{self.path}/{name}/{batch_folder(self.run, batch_id)}")
        finally:
            batch.unpersist()

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").drop("run", "batch_id")

    def interactions(self) -> DataFrame:
        return self._read("interactions")

    def counters(self) -> DataFrame:
        return self._read("counters").groupBy("user_id").agg(
            F.sum("total_interactions").alias("total_interactions"), F.max("last_activity").alias("last_activity")
        )

    def recent(self) -> DataFrame:
        return top_per_key(self._read("recent"), "user_id", latest_first(), self.keep)

    def compact(self, path: str) -> None:
        """Write the merged rows, counters and lists to a new location, as a run that no stream has."""
        parts = {"interactions": self.interactions(), "counters": self.counters(), "recent": self.recent().drop("rank")}
        for name, df in parts.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}/{batch_folder(COMPACTED, 0)}")


_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def seconds_of(interval: str) -> int:
    """Seconds of an interval such as "24 hours"."""
    number, unit = interval.split()
    return int(number) * _SECONDS[unit.rstrip("s")]


def trending_windows(events: DataFrame, length: str = "24 hours", slide: str | None = None, watermark: str = "1 hour") -> DataFrame:
    """Sum of weights per video and time window; rows too late are dropped.

    Sliding windows are put together from panes: events are summed once, by pane
    and video, the pane being the longest time that both the slide and the
    length are a multiple of; only the panes' sums, once closed, are copied to
    the windows over them. Append mode.
    """
    timely = events.withWatermark("event_time", watermark)
    number, weight = F.count("*"), F.sum("weight")
    if slide:
        pane = f"{math.gcd(seconds_of(length), seconds_of(slide))} seconds"
        timely = timely.groupBy(F.window("event_time", pane).alias("pane"), "video_id").agg(number.alias("n"), weight.alias("weight"))
        number = F.sum("n")
    window = F.window(F.window_time("pane"), length, slide) if slide else F.window("event_time", length)
    return (
        timely.groupBy(window.alias("window"), "video_id")
        .agg(number.alias("interaction_count"), weight.alias("score"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "video_id", "interaction_count", "score")
    )


def watch_metrics(events: DataFrame, length: str = "24 hours", watermark: str = "1 hour") -> DataFrame:
    """Watch time, completion and engagement per video and time window."""
    is_view = F.col("event_type") == "view"
    return (
        events.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", length).alias("window"), "video_id")
        .agg(
            F.count(F.when(is_view, 1)).alias("views"),
            F.sum(F.when(is_view, F.col("watch_time"))).alias("watch_time"),
            F.avg(F.when(is_view, F.col("completion_rate"))).alias("avg_completion_rate"),
            F.count(F.when(F.col("event_type").isin("like", "comment", "share"), 1)).alias("engagements"),
        )
        .select(F.col("window.start").alias("window_start"), "video_id", "views", "watch_time", "avg_completion_rate", "engagements")
    )


def _session_stream(events: DataFrame, keys: list[str], gap: int, watermark: str, *measures) -> DataFrame:
    return (
        events.withWatermark("event_time", watermark)
        .groupBy(F.session_window("event_time", f"{gap} seconds").alias("session"), *keys)
        .agg(*measures)
    )


def user_sessions(events: DataFrame, gap: int = V.SESSION_GAP, watermark: str = "1 hour") -> DataFrame:
    """Events, watch time and duration of each session of each user."""
    rows = _session_stream(
        events, ["user_id"], gap, watermark,
        F.count("*").alias("events"), F.coalesce(F.sum("watch_time"), F.lit(0.0)).alias("watch_time"),
    )
    seconds = F.unix_micros("session.end") - F.unix_micros("session.start") - gap * 1_000_000
    return rows.select(
        "user_id", F.col("session.start").alias("started_at"), "events", "watch_time",
        (seconds / 1_000_000).alias("duration_seconds"),
    )


def video_counter_sessions(events: DataFrame, ttl: int = V.COUNTER_TTL, watermark: str = "1 hour") -> DataFrame:
    """Counters per video between two pauses of all its events.

    One session per video, with a count column per event type, so that every
    type restarts the video's timer.
    """
    counts = [F.count(F.when(F.col("event_type") == t, 1)).alias(f"{t}_count") for t in V.EVENT_TYPES]
    rows = _session_stream(events, ["video_id"], ttl, watermark, *counts)
    return rows.select(
        "video_id", F.col("session.start").alias("started_at"), F.col("session.end").alias("expires_at"),
        *[f"{t}_count" for t in V.EVENT_TYPES],
    )


def deduplicated(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Each event_id once, as long as its copies arrive within the watermark."""
    return events.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])


def catalog_latest(changes: DataFrame, time: str = "event_time") -> DataFrame:
    """The latest row per video; run in update or complete mode."""
    rest = [c for c in changes.columns if c != "video_id"]
    return changes.groupBy("video_id").agg(F.max_by(F.struct(*rest), F.col(time)).alias("row")).select("video_id", "row.*")


def session_totals(events: DataFrame, watermark: str = "1 hour", length: str = "24 hours") -> DataFrame:
    """Events and watch time of each session id that clients send, by time window."""
    return (
        events.withWatermark("event_time", watermark)
        .filter(F.col("session_id").isNotNull())
        .groupBy(F.window("event_time", length).alias("window"), "session_id")
        .agg(
            F.count("*").alias("events"), F.coalesce(F.sum("watch_time"), F.lit(0.0)).alias("watch_time"),
            F.min("event_time").alias("started_at"), F.max("event_time").alias("ended_at"),
        )
        .select(F.col("window.start").alias("window_start"), "session_id", "events", "watch_time", "started_at", "ended_at")
    )


def ingest(path: str, schema: T.StructType, run: str):
    """Batch handler for raw values: valid events by topic, the others, as they arrived, to ``rejected``.

    Every row carries the time of its arrival.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.select("value", F.from_json("value", schema).alias("data")).select("value", "data.*")
        name = F.when(has_required_fields(), topic(F.col("event_type"))).otherwise("rejected")
        marked = parsed.withColumn("topic", name).withColumn("received_at", F.current_timestamp())
        marked.write.mode("overwrite").partitionBy("topic").parquet(f"{path}/{batch_folder(run, batch_id)}")

    return write
