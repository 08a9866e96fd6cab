"""Schemas of every input the library reads."""

from pyspark.sql import types as T

_S, _D, _I, _L, _B = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


VIEW_EVENT = _struct(
    event_type=_S, user_id=_S, video_id=_S, timestamp=_S,
    watch_time=_D, total_duration=_D, completion_rate=_D,
    device_type=_S, session_id=_S,
)

# comment_text is what producers send; comment_length is what readers expect.
INTERACTION_EVENT = _struct(
    event_type=_S, user_id=_S, video_id=_S, timestamp=_S, session_id=_S,
    comment_length=_I, comment_text=_S,
)

ITEM_METADATA_EVENT = _struct(
    video_id=_S, title=_S, creator_id=_S, category=_S, tags=T.ArrayType(_S),
    duration=_D, created_at=_S, resolution=_S, language=_S,
)

TITLES = _struct(video_id=_S, title=_S)
LIKES_VIEWS = _struct(video_id=_S, likes=_I, views=_I)
TAGS = _struct(video_id=_S, tags=_S)
COMMENTS = _struct(user_id=_S, video_id=_S, comment_content=_S)

FLAG_ROWS = _struct(
    user_id=_S, pid=_S, exposed_time=_L, p_date=_I, p_hour=_I, watch_time=_D,
    cvm_like=_B, comment=_B, follow=_B, collect=_B, forward=_B,
    effective_view=_B, hate=_B,
)

ITEM_ATTRIBUTES = _struct(
    pid=_S, category_level=_I, category_id=_S, parent_id=_S, root_id=_S, duration=_D,
    author_id=_S, author_fans_count=_L, tag_name=_S, title=_S,
)

USER_ATTRIBUTES = _struct(
    user_id=_S, gender=_S, age=_I, mod_price=_D, fre_city=_S, fre_community_type=_S, fre_city_level=_S,
)

INTERACTION = _struct(
    user_id=_S, video_id=_S, event_type=_S, event_time=T.TimestampType(), weight=_D,
    watch_time=_D, total_duration=_D, completion_rate=_D,
)
