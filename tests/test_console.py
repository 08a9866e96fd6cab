"""The console sees each batch's first rows, the driver no more than those."""

from clipsense.sources import events
from clipsense.streaming import jobs


def test_console_shows_first_rows_and_counts_all(spark, tmp_path, capsys):
    spark.range(40).selectExpr("concat('row', lpad(id, 2, '0')) AS value").coalesce(1).write.text(str(tmp_path / "lines"))
    lines = events.file_topic(spark, str(tmp_path / "lines"))
    running = jobs.run_console(lines, str(tmp_path / "progress"), "console_rows", rows=3, once=True)
    running.awaitTermination()
    done = [p for p in running.recentProgress if p["numInputRows"]]
    assert [(p["numInputRows"], p["observedMetrics"][jobs.CONSOLE_ROWS]["rows"]) for p in done] == [(40, 40)]
    shown = capsys.readouterr().out
    assert "Batch: 0" in shown and "only showing top 3 rows" in shown
    assert [f"row{i:02}" in shown for i in range(5)] == [True, True, True, False, False]


def test_console_takes_batches_beyond_the_drivers_result_size(spark, tmp_path):
    """A batch whose rows are more than the driver may take."""
    spark.range(0, 400_000, 1, 4).selectExpr("concat(repeat(md5(string(id)), 8), id) AS value").write.text(str(tmp_path / "lines"))
    session = spark.newSession()
    most = spark.sparkContext._jsc.sc().conf()
    before = most.get("spark.driver.maxResultSize", "1g")
    most.set("spark.driver.maxResultSize", "4m")
    try:
        running = jobs.run_console(events.file_topic(session, str(tmp_path / "lines")), str(tmp_path / "progress"), "console_large", once=True)
        running.awaitTermination()
        assert sum(p["numInputRows"] for p in running.recentProgress) == 400_000
    finally:
        most.set("spark.driver.maxResultSize", before)
