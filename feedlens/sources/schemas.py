"""Declared schemas of the two input fact tables and the published cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_PROFILE = [
    T.StructField("gender", T.IntegerType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("os", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
]

# One row per feed action (view or like).
FEED = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("time", T.TimestampType(), False),
        T.StructField("action", T.StringType(), False),
        T.StructField("exp_group", T.IntegerType(), False),
        *_PROFILE,
    ]
)

# One row per message; profile columns describe the sender (user_id).
MESSAGES = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("receiver_id", T.LongType(), False),
        T.StructField("time", T.TimestampType(), False),
        *_PROFILE,
    ]
)

# Internal name of a date partition column carried from the source table, so
# day filters can prune partitions (see readers.read_feed).
PART_DAY = "_part_day"
PART_EVENT_DAY = "_part_event_day"  # the earliest day of events in the partition

MEASURES = ["views", "likes", "messages_sent", "users_sent", "messages_received", "users_received"]

# Long-format daily metric cube, partitioned by event_date.
CUBE = T.StructType(
    [
        T.StructField("dimension", T.StringType(), False),
        T.StructField("dimension_value", T.StringType(), False),
        *[T.StructField(m, T.LongType(), False) for m in MEASURES],
        T.StructField("event_date", T.DateType(), False),
    ]
)

CUBE_DDL = (
    "dimension STRING, dimension_value STRING, views BIGINT, likes BIGINT, "
    "messages_sent BIGINT, users_sent BIGINT, messages_received BIGINT, "
    "users_received BIGINT, event_date DATE"
)

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType)


def check_schema(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Reject a frame whose columns or types differ from the declared schema.

    Extra columns are allowed (and pruned by Catalyst if unused); a timestamp
    column may be zoned or zone-less.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
            continue
        got = have[f.name]
        if isinstance(f.dataType, _TIME_TYPES):
            if not isinstance(got, _TIME_TYPES):
                problems.append(f"{f.name}: {got.simpleString()} is not a timestamp")
        elif got != f.dataType:
            problems.append(f"{f.name}: {got.simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{name} does not match its schema: " + "; ".join(problems))
    return df
