"""Row types shared by the pipeline, and the level domains."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])



LOG_RECORD = _struct(
    timestamp=T.StringType(),
    level=T.StringType(),
    message=T.StringType(),
    filename=T.StringType(),
)

LOG_DATA = _struct(
    log_id=T.StringType(),
    file_name=T.StringType(),
    timestamp=T.StringType(),
    log_type=T.StringType(),
    log_message=T.StringType(),
    event_ts=T.TimestampNTZType(),
    src_pos=T.LongType(),
)

RATINGS = _struct(
    user_id=T.IntegerType(),
    item_id=T.IntegerType(),
    rating=T.IntegerType(),
    ts=T.LongType(),
)

USERS = _struct(
    user_id=T.IntegerType(),
    age=T.IntegerType(),
    gender=T.StringType(),
    occupation=T.StringType(),
    zip=T.StringType(),
)

# Levels a producer may write.
PRODUCER_LEVELS = ("DEBUG", "INFO", "WARN", "ERROR")

# Dashboard levels in display order, with their colours.
LEVEL_COLORS = {
    "WARN": "#f64740",
    "ERROR": "#c3423f",
    "SEVERE": "#fabc2a",
    "WARNING": "#5c80bc",
    "DEBUG": "#1c5253",
    "INFO": "#453643",
}
DASHBOARD_LEVELS = tuple(LEVEL_COLORS)

# Likelihood range of each level, closed at both ends.
LEVEL_RANGES = (
    ("ERROR", 0.0, 0.01),
    ("WARN", 0.01, 0.2),
    ("DEBUG", 0.2, 0.3),
    ("INFO", 0.3, 1.0),
)
DEFAULT_LEVEL = "INFO"

# Generated text has 10 to 50 printable characters around an
# instance of this pattern.
MESSAGE_PATTERN = "([a-c][e-g][0-3]|[A-Z][5-9][f-w]){5,15}"
MIN_MESSAGE_LENGTH = 10
MAX_MESSAGE_LENGTH = 50
MIN_SYMBOL = 32
MAX_SYMBOL = 126
