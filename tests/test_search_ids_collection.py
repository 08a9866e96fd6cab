"""The posting table, ids that grow, and the JSON collection as a data source."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

from clipsense.ml import als
from clipsense.ml.ids import extended_index, id_index
from clipsense.operators import search
from clipsense.operators.catalog import search as scan
from clipsense.session import forget, staged
from clipsense.sources.collection import Reader, register
from clipsense.streaming import jobs


def ids(df):
    return {r["user_id"]: r["idx"] for r in df.collect()}


def test_known_ids_stay_and_new_ones_follow(spark):
    names = lambda a, b: spark.createDataFrame([(f"u{i}",) for i in range(a, b)] + [(None,)], "user_id string")
    first = staged(id_index(names(0, 40), "user_id", "idx"))
    second = staged(extended_index(first, names(20, 90), "user_id", "idx"))
    third = staged(extended_index(second, names(20, 60), "user_id", "idx"))
    assert ids(first).items() <= ids(second).items() and ids(third) == ids(second)
    assert sorted(ids(second).values()) == list(range(90))
    none = staged(first.filter("false"))
    assert sorted(ids(extended_index(none, names(0, 5), "user_id", "idx")).values()) == list(range(5))
    assert ids(extended_index(none, names(0, 5), "user_id", "idx")) == ids(id_index(names(0, 5), "user_id", "idx"))


def test_a_model_trained_again_keeps_its_ids(spark, tmp_path):
    draw = random.Random(1)
    rows = [(f"u{draw.randrange(30)}", f"v{draw.randrange(20)}", 1.0) for _ in range(300)]
    shape = "user_id string, video_id string, weight double"
    old = als.train(spark.createDataFrame(rows[:60], shape), rank=3, maxIter=2)
    old.save(str(tmp_path / "m"))
    loaded = als.Recommender.load(spark, str(tmp_path / "m"))
    new = als.train(spark.createDataFrame(rows, shape), known=loaded, rank=3, maxIter=2)
    for table in ("users", "videos"):
        before, after = ({tuple(r) for r in getattr(m, table).collect()} for m in (old, new))
        assert before < after
    assert {r["user_id"] for r in new.for_all(2).collect()} == {r[0] for r in rows}


@pytest.fixture(scope="module")
def videos(spark):
    draw = random.Random(2)
    words = ["Bolt", "bolero", "Été", "ab", "a", "straße", "100%", "long-tail"]
    rows = [(f"v{i}", draw.choice([None, "", " ".join(draw.choice(words) for _ in range(draw.randint(1, 5)))]), draw.choice([None, "Tools", "to"])) for i in range(200)]
    return staged(spark.createDataFrame(rows, "video_id string, title string, category string"))


@pytest.mark.parametrize("pattern", ["", "b", "ol", "BOL", "bolt bol", "ÉTÉ", "été a", "0%", "100% ", "tail straße", "v19", "tools", "nowhere", "bolbolbol"])
def test_search_by_postings_is_the_scan(spark, videos, tmp_path, pattern):
    search.write_postings(videos, str(tmp_path / "p"))
    index = spark.read.parquet(str(tmp_path / "p"))
    names = lambda df: sorted(r["video_id"] for r in df.collect())
    assert names(search.search_indexed(index, videos, pattern)) == names(scan(videos, pattern))
    held = search.candidates(index, pattern)
    assert (held is None) == (len(pattern) < 3)


SHAPE = "n bigint, name string, score double, at timestamp, tags array<string>, place struct<x:double>"


def write(folder, name, documents):
    (folder / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents), encoding="utf-8")


def test_documents_are_read_as_the_schema_says(spark, tmp_path):
    register(spark)
    odd = [
        {"n": 1, "name": "é", "score": 1, "at": "2024-01-01T00:00:00+00:00", "tags": ["a", "b"], "place": {"x": 2}},
        {"n": "7", "name": {"k": 1}, "score": "x", "at": "never", "tags": "a", "place": 3, "more": 1},
        {}, "broken {", "[1]", "",
    ]
    write(tmp_path, "a.json", odd)
    write(tmp_path, "_hidden", [{"n": 99}])
    read = lambda **o: [tuple(r) for r in spark.read.format("json_collection").schema(SHAPE).options(**o).load(str(tmp_path)).select("n", "name", "score", F.col("at").isNotNull(), "tags", "place.x").collect()]
    good = [(1, "é", 1.0, True, ["a", "b"], 2.0), (7, '{"k": 1}', None, False, None, None), (None, None, None, False, None, None)]
    assert read() == good
    assert read(mode="PERMISSIVE") == good + [(None, None, None, False, None, None)] * 2


def test_partitions_and_filters(spark, tmp_path):
    register(spark)
    for k in range(7):
        write(tmp_path, f"{k}.json", [{"n": 10 * k + i, "name": "odd" if i % 2 else "even"} for i in range(10)])
    reader = Reader(T.StructType.fromDDL(SHAPE), {"path": str(tmp_path), "files": "3"})
    assert [len(p.paths) for p in reader.partitions()] == [3, 3, 1]
    over = [EqualTo(("name",), "odd"), GreaterThan(("n",), 50), IsNotNull(("n",)), In(("name",), ("odd", "x")), EqualTo(("place", "x"), 1.0), StringContains(("name",), "o")]
    assert list(reader.pushFilters(over)) == over[4:]
    assert [r[0] for p in reader.partitions() for r in reader.read(p)] == [51, 53, 55, 57, 59, 61, 63, 65, 67, 69]
    df = spark.read.format("json_collection").schema(SHAPE).load(str(tmp_path)).filter("name = 'odd' AND n > 50 AND name LIKE '%d'")
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Only the filter that the source has handed back is left to Spark.
    assert "EndsWith(name" in plan and "odd" not in plan and "> 50" not in plan


def test_a_stream_goes_on_from_the_files_it_has_seen(spark, tmp_path):
    register(spark)
    source = tmp_path / "in"
    source.mkdir()
    out, progress = str(tmp_path / "out"), str(tmp_path / "c")

    def go():
        df = spark.readStream.format("json_collection").schema("n bigint").option("files_per_batch", 2).load(str(source))
        running = jobs.run(df, out, progress, "documents")
        running.processAllAvailable()
        running.stop()
        return sorted(r["n"] for r in spark.read.schema("n bigint").parquet(out).collect())

    for k in range(5):
        write(source, f"{k:03}.json", [{"n": k}])
    assert go() == [0, 1, 2, 3, 4]
    write(source, "005.json", [{"n": 5}])
    assert go() == [0, 1, 2, 3, 4, 5]
    assert go() == [0, 1, 2, 3, 4, 5]


def test_forgotten_tables_are_gone(spark):
    import os

    df = staged(spark.range(3))
    assert df.count() == 3 and os.path.isdir(df.staged_at)
    forget(df)
    assert not os.path.isdir(df.staged_at)
