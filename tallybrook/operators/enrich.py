"""Events with the attributes of their content and the engagement measures."""

from pyspark.sql import DataFrame, functions as F

from tallybrook.functions.measures import engagement_pct, engagement_seconds
from tallybrook.operators.keyed_join import keyed_join
from tallybrook.session import scratch
from tallybrook.sources.tables import after_id

ENRICHED = (
    "id",
    "content_id",
    "user_id",
    "event_type",
    "event_ts",
    "duration_ms",
    "device",
    "content_type",
    "length_seconds",
    "engagement_seconds",
    "engagement_pct",
)


def with_content(events: DataFrame, content: DataFrame, *columns, **join) -> DataFrame:
    """Every event, with the named content columns; null where the content is absent or unknown."""
    wanted = content.select(F.col("id").alias("content_id"), *columns)
    return keyed_join(events, wanted, "content_id", "left", **join)


def enrich_events(events: DataFrame, content: DataFrame, keep: tuple[str, ...] = (), **join) -> DataFrame:
    """The enriched event; ``keep`` names further event columns to carry along."""
    joined = with_content(events, content, "content_type", "length_seconds", **join)
    return with_measures(joined, *keep)


def next_events(events: DataFrame, content: DataFrame, cursor: int, most: int = 1000) -> DataFrame:
    """The next ``most`` events above an id, enriched.

    The page is written down first, so it is read from the table once. The catalogue is cut to the page's
    items by a semi-join with at most ``most`` keys, so it is filtered where it is scanned and not shuffled.
    """
    spark = events.sparkSession
    path = scratch(spark, "page")
    after_id(events, cursor, most).write.parquet(path)
    page = spark.read.schema(events.schema).parquet(path)
    asked = F.broadcast(page.select(F.col("content_id").alias("id")).distinct())
    return enrich_events(page, content.join(asked, "id", "left_semi"))


def with_measures(joined: DataFrame, *keep: str) -> DataFrame:
    ms, length = F.col("duration_ms"), F.col("length_seconds")
    return joined.withColumns(
        {"engagement_seconds": engagement_seconds(ms), "engagement_pct": engagement_pct(ms, length)}
    ).select(*ENRICHED, *keep)


def export_rows(events: DataFrame, content: DataFrame, **join) -> DataFrame:
    """Events as the outside event table takes them: whole payload, content slug and title."""
    described = (F.col("slug").alias("content_slug"), F.col("title").alias("content_title"), "content_type")
    return with_content(events, content, *described, **join).select(
        "id", "content_id", "user_id", "event_type", "event_ts", "duration_ms", "device",
        "raw_payload", "updated_at", "content_slug", "content_title", "content_type",
    )
