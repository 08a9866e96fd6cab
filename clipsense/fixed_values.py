"""Every number, label and name that results must agree on."""

# Event names.
EVENT_TYPES = ("view", "like", "share", "comment", "skip")
PROFILE_EVENT_TYPES = ("view", "like", "comment", "share", "collect")
REQUIRED_EVENT_FIELDS = ("event_type", "user_id", "video_id")

# Streaming weight scale (completion bounds are strict).
VIEW_WEIGHT_STEPS = ((0.8, 5.0), (0.5, 3.0), (0.3, 1.0))
VIEW_WEIGHT_OTHER = 0.5
INTERACTION_WEIGHTS = {"like": 10.0, "share": 15.0, "comment": 8.0, "skip": -2.0}
INTERACTION_WEIGHT_OTHER = 1.0

# Batch-loader weight scale.
LOADER_WEIGHTS = {"view": 1.0, "like": 2.0, "comment": 3.0, "share": 4.0}

# Loader defaults and sampling rates.
DEFAULT_DURATION = 60.0
DEFAULT_ITEM_DURATION = 30.0
WATCH_TIME_LOW = 10.0
WATCH_TIME_SPAN = 60.0
LIKE_SAMPLE = (0.6, 0.3)  # completion at least, share of rows
SHARE_SAMPLE = (0.8, 0.1)

# Topics.
TOPICS = ("user-events", "user-views", "user-interactions")
TOPIC_BY_EVENT = {
    "view": "user-views",
    "like": "user-interactions",
    "share": "user-interactions",
    "comment": "user-interactions",
}
TOPIC_OTHER = "user-events"

# Rating bounds of data sets without an event type.
RATING_STEPS = ((4.0, "like"), (3.0, "view"))
RATING_OTHER = "skip"

# Flag columns of the exposure data set.
FLAG_EVENTS = {
    "cvm_like": "like",
    "comment": "comment",
    "follow": "follow",
    "collect": "collect",
    "forward": "share",
    "effective_view": "view",
    "hate": "skip",
}

# Item scores.
ENGAGEMENT_COUNTS = {"like_count": 2.0, "comment_count": 3.0, "share_count": 4.0}
QUALITY_COMPLETION, QUALITY_ENGAGEMENT, QUALITY_REACH = 50.0, 30.0, 10.0
AGE_SCORE_COUNTS = {
    "view_count": 1.0,
    "like_count": 5.0,
    "share_count": 10.0,
    "comment_count": 8.0,
}

# User scores.
USER_SCORE_TERMS = {
    "total_views": 0.3,
    "total_likes": 2.0,
    "total_comments": 3.0,
    "total_shares": 4.0,
    "engagement_rate": 50.0,
    "avg_completion_rate": 30.0,
}
USER_SCORE_MAX = 100.0
USER_TYPE_STEPS = ((80, "power_user"), (50, "active_user"), (20, "casual_user"))
USER_TYPE_OTHER = "new_user"
CLUSTER_FEATURES = (
    "total_views",
    "total_likes",
    "total_comments",
    "engagement_rate",
    "avg_completion_rate",
    "activity_frequency",
)
SEGMENT_LABELS = ("casual_browsers", "engaged_viewers", "power_users", "new_users")
SEGMENT_OTHER = "churned_users"

# Neighbour recommenders.
LIKE_NEIGHBOURS, COMMENT_NEIGHBOURS, WATCH_NEIGHBOURS = 50, 30, 40
WATCH_SIMILAR_COMPLETION, WATCH_CANDIDATE_COMPLETION = 0.7, 0.6
DIVERSITY_STEPS = ((3, 10.0), (2, 5.0))
METHOD_WEIGHTS = {
    "power_user": {"likes": 0.4, "comments": 0.4, "watch_patterns": 0.2},
    "active_user": {"likes": 0.35, "comments": 0.35, "watch_patterns": 0.3},
}
METHOD_WEIGHTS_PROFILED = {"likes": 0.3, "comments": 0.2, "watch_patterns": 0.5}
METHOD_WEIGHTS_UNKNOWN = {"likes": 0.33, "comments": 0.33, "watch_patterns": 0.34}

# Item similarity and ALS.
COSINE_THRESHOLD = 0.3
ALS_SETTINGS = {"rank": 64, "maxIter": 15, "regParam": 0.01}
ALS_GRID_START = {"maxIter": 10, "regParam": 0.1}
ALS_METHOD = "distributed_als"
ALS_GRID = {"rank": [10, 20, 30], "regParam": [0.01, 0.1, 0.5], "alpha": [1.0, 10.0, 40.0]}
SPLIT_SHARE, SEED = 0.8, 42

# Time limits in seconds.
RECENT_TTL = 86_400
COUNTER_TTL = 86_400
API_COUNTER_TTL = 7 * 86_400
TRENDING_TTL = 3_600
PROFILE_TTL = 3_600
SESSION_GAP = 1_800

# What a snapshot of a hot profile holds.
HOT_PROFILE_FIELDS = ("user_score", "user_type", "engagement_rate", "total_views", "total_likes")
