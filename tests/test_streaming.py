"""Replays, late rows, idle timers, and state across batches."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipsense.functions.weights import event_weight
from clipsense.sources import events
from clipsense.streaming import jobs
from clipsense.streaming.state import latest_lists, recent_videos_state

SHAPE = "event_id bigint, event_type string, user_id string, video_id string, timestamp string, watch_time double, completion_rate double"


def line(event_id, user, video, stamp, kind="view"):
    return (
        f'{{"event_id":{event_id},"event_type":"{kind}","user_id":"{user}","video_id":"{video}",'
        f'"timestamp":"{stamp}","watch_time":30.0,"completion_rate":0.9}}'
    )


def stream(spark, folder, batches):
    """One file per batch; files are read in the order of their times."""
    import os

    folder.mkdir()
    for i, lines in enumerate(batches):
        path = folder / f"{i}.txt"
        path.write_text("\n".join(lines), encoding="utf-8")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    values = events.file_topic(spark, str(folder), files_per_batch=1)
    rows = events.timed(values.select(F.from_json("value", SHAPE).alias("d")).select("d.*"))
    return rows.withColumn("weight", event_weight(F.col("event_type"), F.col("completion_rate")))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_replayed_batch_is_counted_once(spark, tmp_path):
    state = jobs.ProfileTables(spark, str(tmp_path / "state"), "a", keep=2)
    rows = [line(i, "u", str(i), f"2024-01-01T00:0{i}:00") for i in range(4)]
    df = stream(spark, tmp_path / "in", [rows[:2], rows[2:]])
    finish(jobs.run_batches(df, state.write_batch, str(tmp_path / "c"), "replay", once=True))
    batch = state.interactions().filter("event_id >= 2")
    state.write_batch(spark.createDataFrame(batch.collect(), batch.schema), 1)
    assert [tuple(r)[:2] for r in state.counters().collect()] == [("u", 4)]
    assert [r.video_id for r in state.recent().orderBy("rank").collect()] == ["3", "2"]
    state.compact(str(tmp_path / "packed"))
    packed = jobs.ProfileTables(spark, str(tmp_path / "packed"), "b", keep=2)
    assert [tuple(r)[:2] for r in packed.counters().collect()] == [("u", 4)]
    assert [r.video_id for r in packed.recent().orderBy("rank").collect()] == ["3", "2"]
    assert packed.interactions().count() == 4
    # A stream that starts on compacted data with a new checkpoint adds to it, batch 0 included.
    more = stream(spark, tmp_path / "more", [[line(9, "u", "9", "2024-01-02T00:00:00")]])
    finish(jobs.run_batches(more, packed.write_batch, str(tmp_path / "c2"), "restart", once=True))
    assert [tuple(r)[:2] for r in packed.counters().collect()] == [("u", 5)] and packed.interactions().count() == 5


def test_rows_keep_type_and_watch_columns(spark, tmp_path):
    state = jobs.ProfileTables(spark, str(tmp_path / "state"), "a")
    df = stream(spark, tmp_path / "in", [[line(1, "u", "1", "2024-01-01T00:00:00")]])
    finish(jobs.run_batches(df, state.write_batch, str(tmp_path / "c"), "columns", once=True))
    row = state.interactions().first()
    assert (row.event_type, row.watch_time, row.completion_rate, row.weight) == ("view", 30.0, 0.9, 5.0)


def test_late_rows_are_dropped_from_windows(spark, tmp_path):
    """Spark judges lateness by the watermark of the batch before."""
    batches = [
        [line(1, "u", "1", "2024-01-05T00:30:00")],
        [line(3, "u", "1", "2024-01-05T00:40:00")],
        [line(2, "u", "1", "2024-01-01T00:30:00")],
        [line(4, "u", "1", "2024-01-09T00:00:00")],
        [line(5, "u", "1", "2024-01-09T00:00:01")],
    ]
    df = jobs.trending_windows(stream(spark, tmp_path / "in", batches), length="1 hour")
    out = str(tmp_path / "out")
    finish(jobs.run(df, out, str(tmp_path / "c"), "late", once=True))
    rows = spark.read.schema(df.schema).parquet(out).collect()
    assert [(str(r.window_start), r.interaction_count) for r in rows] == [("2024-01-05 00:00:00", 2)]


def test_copies_are_dropped_across_batches(spark, tmp_path):
    a, b = line(1, "u", "1", "2024-01-01T00:00:00"), line(2, "u", "1", "2024-01-01T00:00:10")
    df = jobs.deduplicated(stream(spark, tmp_path / "in", [[a, a], [a, b], [b]]))
    finish(jobs.run(df, str(tmp_path / "out"), str(tmp_path / "c"), "dedup_batches", once=True))
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def recent_lists(spark, tmp_path, batches):
    """What was emitted per user, in batch order."""
    emitted = []
    df = recent_videos_state(stream(spark, tmp_path / "in", batches))

    def keep(batch, batch_id):
        rows = batch.orderBy("user_id", "pos").collect()
        for user in sorted({r.user_id for r in rows}):
            emitted.append((user, [r.video_id for r in rows if r.user_id == user]))

    finish(jobs.run_batches(df, keep, str(tmp_path / "c"), "state", once=True))
    return emitted


def test_state_merges_batches_in_any_order(spark, tmp_path):
    first = [line(1, "u", "1", "2024-01-01T02:00:00")]
    second = [line(2, "u", "2", "2024-01-01T01:30:00"), line(3, "u", "3", "2024-01-01T03:00:00")]
    lists = recent_lists(spark, tmp_path, [first, second])
    assert lists == [("u", ["1"]), ("u", ["3", "1", "2"])]


def test_state_drops_what_lies_before_a_pause(spark, tmp_path):
    """24 h apart stays, a second more drops; equal to the batch form."""
    rows = [
        line(1, "kept", "1", "2024-01-01T00:00:00"), line(2, "kept", "2", "2024-01-02T00:00:00"),
        line(3, "cut", "1", "2024-01-01T00:00:00"), line(4, "cut", "2", "2024-01-02T00:00:01"),
    ]
    assert recent_lists(spark, tmp_path, [rows]) == [("cut", ["2"]), ("kept", ["2", "1"])]


def test_idle_state_times_out(spark, tmp_path):
    batches = [
        [line(1, "u", "1", "2024-01-01T00:00:00")],
        [line(2, "other", "9", "2024-01-10T00:00:00")],
        [line(3, "other", "9", "2024-01-10T00:00:01")],
        [line(4, "u", "2", "2024-01-10T00:00:02")],
    ]
    lists = recent_lists(spark, tmp_path, batches)
    assert lists[0] == ("u", ["1"]) and ("u", ["2"]) in lists and ("u", ["2", "1"]) not in lists


def test_ingest_keeps_rejects_as_they_arrived(spark, tmp_path):
    rows = [line(1, "u", "1", "2024-01-01T00:00:00"), '{"event_id":2,"event_type":"like","user_id":"u"}', "{broken"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "0.txt").write_text("\n".join(rows), encoding="utf-8")
    values = events.file_topic(spark, str(folder))
    handler = jobs.ingest(str(tmp_path / "out"), T.StructType.fromDDL(SHAPE), "a")
    finish(jobs.run_batches(values, handler, str(tmp_path / "c"), "ingest_test", once=True))
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.topic, r.event_id, r.value) for r in found} == {("user-views", 1, rows[0]), ("rejected", 2, rows[1]), ("rejected", None, rows[2])}
    assert all(r.received_at for r in found)


def test_last_list_of_each_user_can_be_read_back(spark, tmp_path):
    batches = [
        [line(1, "u", "1", "2024-01-01T00:00:00"), line(5, "v", "5", "2024-01-01T00:00:00")],
        [line(2, "u", "2", "2024-01-01T01:00:00")],
        [line(3, "other", "9", "2024-01-10T00:00:00")],
        [line(4, "other", "9", "2024-01-10T00:00:01")],
        [line(6, "u", "6", "2024-01-10T00:00:02")],
    ]
    df = recent_videos_state(stream(spark, tmp_path / "in", batches))
    finish(jobs.run(df, str(tmp_path / "out"), str(tmp_path / "c"), "lists", once=True))
    last = latest_lists(spark.read.schema(df.schema).parquet(str(tmp_path / "out"))).orderBy("user_id", "pos").collect()
    assert [(r.user_id, r.video_id) for r in last if r.user_id != "other"] == [("u", "6"), ("v", "5")]


def test_state_goes_on_after_a_restart(spark, tmp_path):
    """A second run with the same checkpoint knows the list of the first, and rewrites it only when it has doubled."""
    folder = tmp_path / "in"
    first = [line(i, "u", f"{i:03}", f"2024-01-01T00:{i // 60:02}:{i % 60:02}") for i in range(150)]
    emitted = []

    def keep(batch, batch_id):
        emitted.append([r.video_id for r in batch.orderBy("pos").collect()])

    def go(df):
        finish(jobs.run_batches(df, keep, str(tmp_path / "c"), "restart_state", once=True))

    go(recent_videos_state(stream(spark, folder, [first[:90], first[90:]])))
    rows = [x for x in emitted if x]
    assert rows[-1] == [f"{i:03}" for i in range(149, 49, -1)]
    import os

    path = folder / "2.txt"
    path.write_text(line(500, "u", "new", "2024-01-01T03:00:00"), encoding="utf-8")
    os.utime(path, (1_700_000_010, 1_700_000_010))
    values = events.file_topic(spark, str(folder), files_per_batch=1)
    again = events.timed(values.select(F.from_json("value", SHAPE).alias("d")).select("d.*"))
    emitted.clear()
    go(recent_videos_state(again.withColumn("weight", event_weight(F.col("event_type"), F.col("completion_rate")))))
    assert [x for x in emitted if x][-1] == ["new", *[f"{i:03}" for i in range(149, 50, -1)]]


def test_panes_make_one_state_row_a_pane_and_video(spark, tmp_path):
    """Ten events of a video in one hour: one pane, and one row in each of the 24 windows over it."""
    rows = [line(i, "u", "1", f"2024-01-01T00:{i:02}:00") for i in range(10)]
    late = [line(90 + k, "u", "2", f"202{5 + k}-01-01T00:00:00") for k in range(2)]
    df = jobs.trending_windows(stream(spark, tmp_path / "in", [rows, late[:1], late[1:]]), slide="1 hour")
    out = str(tmp_path / "out")
    query = jobs.run(df, out, str(tmp_path / "c"), "panes", once=True)
    finish(query)
    found = spark.read.schema(df.schema).parquet(out).filter("video_id = '1'").collect()
    assert len(found) == 24 and {(r.interaction_count, r.score) for r in found} == {(10, 50.0)}
    first = [p for p in query.recentProgress if p["stateOperators"]][0]["stateOperators"]
    assert max(op["numRowsUpdated"] for op in first) == 1


class _Held:
    """One state of one user, and how often it was written."""

    def __init__(self):
        self.value, self.writes = [], 0

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    put = update

    def appendList(self, rows):
        self.update(self.value + rows)

    def clear(self):
        self.value = []


class _Handle:
    def __init__(self):
        self.events, self.about, self.timers, self.moved = _Held(), _Held(), [], 0

    def getListState(self, name, schema):
        return self.events

    def getValueState(self, name, schema):
        return self.about

    def registerTimer(self, ms):
        self.timers.append(ms)

    def deleteTimer(self, ms):
        self.moved += 1


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_users_batch_moves_no_timer_and_a_later_event_keeps_the_state():
    """The timer is set once in a user's life, and anew only when it goes off too early."""
    from pyspark.sql import Row

    from clipsense.streaming.state import RecentVideos

    handle, user = _Handle(), RecentVideos(10_000_000)
    user.init(handle)
    for second in range(4):
        rows = [Row(event_us=second * 1_000_000 + i, video_id=str(i), weight=1.0) for i in range(2)]
        out = list(user.handleInputRows(("u",), iter(rows), None))
    assert [(r.video_id, r.pos, r.n) for r in out][:2] == [("1", 1, 8), ("0", 2, 8)]
    assert handle.timers == [10_000] and handle.moved == 0 and handle.events.writes == 4
    assert list(user.handleExpiredTimer(("u",), _Clock(10_500), None)) == []
    assert handle.timers == [10_000, 13_000] and len(handle.events.value) == 8
    assert list(user.handleExpiredTimer(("u",), _Clock(13_500), None)) == []
    assert handle.events.value == [] and handle.about.value == []
