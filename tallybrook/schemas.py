"""Declared schemas for the two source tables, the stream envelope and every result table.

Identifiers are strings (UUID text) in production and longs in some feeds, so each schema is a
function of the identifier type. Result tables are cast to these types before they are written,
which is what keeps a table's columns the same from run to run.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

CONTENT_TYPES = ("podcast", "newsletter", "video")
EVENT_TYPES = ("play", "pause", "finish", "click")
DEVICES = ("ios", "android", "web-chrome", "web-safari", "web-edge")

CONTENT_REQUIRED = ("slug", "title", "publish_ts", "updated_at")
EVENT_REQUIRED = ("event_ts", "updated_at")
MESSAGE_REQUIRED = ("id", "event_ts")


def content_schema(id_type: DataType = StringType()) -> StructType:
    return (
        StructType()
        .add("id", id_type)
        .add("slug", StringType())
        .add("title", StringType())
        .add("content_type", StringType())
        .add("length_seconds", IntegerType())
        .add("publish_ts", TimestampType())
        .add("updated_at", TimestampType())
    )


def payload_schema(id_type: DataType = StringType()) -> StructType:
    """The JSON body of one streamed event."""
    return (
        StructType()
        .add("id", LongType())
        .add("content_id", id_type)
        .add("user_id", id_type)
        .add("event_type", StringType())
        .add("event_ts", TimestampType())
        .add("duration_ms", IntegerType())
        .add("device", StringType())
        .add("raw_payload", StringType())
    )


def event_schema(id_type: DataType = StringType()) -> StructType:
    """The stored event: the streamed body plus the time of its last change."""
    return payload_schema(id_type).add("updated_at", TimestampType())


def envelope_schema() -> StructType:
    """What a message bus hands over, whatever the body holds."""
    return (
        StructType()
        .add("key", BinaryType())
        .add("value", BinaryType())
        .add("timestamp", TimestampType())
        .add("partition", IntegerType())
        .add("offset", LongType())
    )


_CONTENT_METRICS = """
    content_id {id}, content_slug string, content_title string, content_type string,
    content_length_seconds int, content_publish_ts timestamp, total_events bigint,
    play_count bigint, pause_count bigint, finish_count bigint, click_count bigint,
    total_duration_ms bigint, avg_duration_ms double, last_event_ts timestamp,
    first_event_ts timestamp, unique_users bigint, completion_rate double
"""

# Result tables by name, as DDL with the identifier type left open.
RESULT_TABLES = {
    "content_engagement_metrics": _CONTENT_METRICS + ", engagement_score double",
    "content_metrics_export": _CONTENT_METRICS,
    "content_engagement_daily": """
        content_id {id}, content_slug string, content_title string, content_type string,
        length_seconds int, event_type string, event_date date, events_count bigint,
        total_duration_ms bigint, avg_duration_ms double, unique_users bigint,
        avg_engagement_seconds double, avg_engagement_pct double
    """,
    "content_engagement_daily_export": """
        content_id {id}, content_slug string, content_title string, content_type string,
        event_date date, events_count bigint, play_count bigint, finish_count bigint,
        total_duration_ms bigint, unique_users bigint
    """,
    "content_type_analysis": """
        content_type string, total_content_items bigint, total_events bigint,
        total_plays bigint, total_finishes bigint, avg_duration_ms double,
        total_unique_users bigint, avg_events_per_content double, completion_rate double
    """,
    "device_analysis": """
        device string, total_events bigint, play_count bigint, finish_count bigint,
        avg_duration_ms double, unique_users bigint, completion_rate double
    """,
    "engagement_events_stream": """
        id bigint, content_id {id}, user_id {id}, event_type string, event_ts timestamp,
        duration_ms int, device string, raw_payload string, updated_at timestamp,
        content_slug string, content_title string, content_type string
    """,
    "enriched_events": """
        id bigint, content_id {id}, user_id {id}, event_type string, event_ts timestamp,
        duration_ms int, device string, content_type string, length_seconds int,
        engagement_seconds double, engagement_pct double
    """,
    "serving_view": """
        family string, key string, value string, ttl_seconds int,
        written_at timestamp, expires_at timestamp
    """,
}


def result_schema(table: str, id_type: DataType = StringType()) -> StructType:
    return StructType.fromDDL(RESULT_TABLES[table].format(id=id_type.simpleString()))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns, in its order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
