"""Postings of repeated, null and short rows, without a comparison of all pairs."""

from clipsense.operators import search


def test_postings_of_repeated_rows(spark):
    rows = [("v1", "Red bolt", "x"), ("v1", "Red bolt", "x"), ("v1", "blue BOLT", None), (None, "nut", "ab"), ("v22", None, "")]
    catalog = spark.createDataFrame(rows, "video_id string, title string, category string")
    expected = {(v, t[i : i + 3]) for v, *_ in rows for r in rows if r[0] == v for t in [(x or "").lower() for x in r] for i in range(len(t) - 2)}
    index = search.postings(catalog)
    found = [(r["video_id"], r["gram"]) for r in index.collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    plan = index._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [video_id" in plan and "Aggregate [gram" not in plan and "Aggregate [video_id#" in plan.split("Generate explode")[1]
    assert not any("Aggregate" in line for line in plan.split("Generate explode")[0].split("\n"))
