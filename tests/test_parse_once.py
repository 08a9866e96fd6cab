"""Parsers of event topics parse a value once, and leave out the same values as before."""

import pytest

from clipsense.sources import events

LINES = ['{"video_id": "1", "title": "t", "created_at": "x"}', '{"user_id": "2", "comment_text": "abc"}', "[1]", "{cut", "{}", None]


@pytest.mark.parametrize("parse, rows", [(events.view_events, 2), (events.interaction_events, 2), (events.item_events, 1), (events.rejects, 4)])
def test_a_value_is_parsed_once(spark, parse, rows):
    parsed = parse(spark.createDataFrame([(line,) for line in LINES], "value string"))
    assert parsed.count() == rows
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
