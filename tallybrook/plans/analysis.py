"""The four analysis tables and the two export tables.

Each table can be asked for on its own, straight from the sources. ``run_analysis`` makes all of
them from one daily rollup, so that the events are read once for the content tables and once, two
columns wider, for the device table.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.functions.measures import completion_rate, engagement_score
from tallybrook.operators import rollup as r
from tallybrook.schemas import conform, result_schema
from tallybrook.session import scratch

ANALYSIS_TABLES = (
    "content_engagement_metrics",
    "content_engagement_daily",
    "content_type_analysis",
    "device_analysis",
)

_DESCRIBED = {
    "content_id": "id",
    "content_slug": "slug",
    "content_title": "title",
    "content_type": "content_type",
}


def _described(content: DataFrame, **more: str) -> DataFrame:
    return content.select(*[F.col(c).alias(name) for name, c in {**_DESCRIBED, **more}.items()])


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def content_metrics_export(content: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per content, also for those without events. ``summary`` is keyed by content."""
    items = _described(
        content, content_length_seconds="length_seconds", content_publish_ts="publish_ts"
    )
    plays, finishes = _zero("n_play"), _zero("n_finish")
    return items.join(summary, "content_id", "left").select(
        *items.columns,
        _zero("n_events").alias("total_events"),
        plays.alias("play_count"),
        _zero("n_pause").alias("pause_count"),
        finishes.alias("finish_count"),
        _zero("n_click").alias("click_count"),
        F.col("sum_ms").alias("total_duration_ms"),
        r.mean("sum_ms", "n_ms").alias("avg_duration_ms"),
        F.col("last_ts").alias("last_event_ts"),
        F.col("first_ts").alias("first_event_ts"),
        _zero("n_users").alias("unique_users"),
        completion_rate(plays, finishes).alias("completion_rate"),
    )


def content_engagement_metrics(content: DataFrame, summary: DataFrame) -> DataFrame:
    """``unique_users`` counts events with a user, not different users; see the distinct variant."""
    score = engagement_score(F.col("total_events"), F.col("unique_users"), F.col("completion_rate"))
    return content_metrics_export(content, summary).withColumn("engagement_score", score)


def content_engagement_metrics_distinct(
    content: DataFrame, events: DataFrame, approximate: bool = False
) -> DataFrame:
    """The same table with different users counted, exactly or from sketches."""
    named = r.events_with_content(events)
    if approximate:
        users = r.merge_user_sketches(r.user_sketches(named, "content_id"), "content_id")
    else:
        users = r.distinct_users(named, "content_id")
    table = content_metrics_export(content, r.by_content(events)).drop("unique_users")
    counted = table.join(users, "content_id", "left").withColumn("unique_users", _zero("unique_users"))
    score = engagement_score(F.col("total_events"), F.col("unique_users"), F.col("completion_rate"))
    return counted.withColumn("engagement_score", score)


def content_engagement_daily(content: DataFrame, rollup: DataFrame) -> DataFrame:
    """One row per content, event type and day on which there were events."""
    items = _described(content, length_seconds="length_seconds")
    dated = rollup.where(F.col("event_date").isNotNull())
    return dated.join(items, "content_id", "inner").select(
        *items.columns,
        "event_type",
        "event_date",
        F.col("n_events").alias("events_count"),
        F.col("sum_ms").alias("total_duration_ms"),
        r.mean("sum_ms", "n_ms").alias("avg_duration_ms"),
        F.col("n_users").alias("unique_users"),
        (r.mean("sum_ms", "n_ms") / F.lit(1000.0)).alias("avg_engagement_seconds"),
        (r.mean("sum_pct", "n_pct") / F.lit(100.0)).alias("avg_engagement_pct"),
    )


def content_engagement_daily_export(content: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per content and day. ``summary`` is keyed by content and ``event_date``."""
    dated = summary.where(F.col("event_date").isNotNull())
    items = _described(content)
    return dated.join(items, "content_id", "inner").select(
        *items.columns,
        "event_date",
        F.col("n_events").alias("events_count"),
        F.col("n_play").alias("play_count"),
        F.col("n_finish").alias("finish_count"),
        F.col("sum_ms").alias("total_duration_ms"),
        F.col("n_users").alias("unique_users"),
    )


def by_content_and_day(events: DataFrame) -> DataFrame:
    dated = r.events_with_content(events).where(F.col("event_ts").isNotNull())
    return r.summarise(dated, "content_id", F.to_date("event_ts").alias("event_date"))


def content_type_analysis(content: DataFrame, summary: DataFrame, corrected: bool = False) -> DataFrame:
    """Per content type. ``total_content_items`` counts an item once for each of its events (once
    if it has none), as a count over the joined rows does; ``corrected`` counts every item once.
    """
    kinds = content.select(F.col("id").alias("content_id"), "content_type")
    n = _zero("n_events")
    items = F.lit(1) if corrected else F.greatest(n, F.lit(1))
    grouped = kinds.join(summary, "content_id", "left").groupBy("content_type").agg(
        F.sum(items).cast("bigint").alias("total_content_items"),
        F.sum(n).alias("total_events"),
        F.sum(_zero("n_play")).alias("total_plays"),
        F.sum(_zero("n_finish")).alias("total_finishes"),
        F.sum("sum_ms").alias("sum_ms"),
        F.sum(_zero("n_ms")).alias("n_ms"),
        F.sum(_zero("n_users")).alias("total_unique_users"),
    )
    return grouped.select(
        "content_type",
        "total_content_items",
        "total_events",
        "total_plays",
        "total_finishes",
        r.mean("sum_ms", "n_ms").alias("avg_duration_ms"),
        "total_unique_users",
        (F.col("total_events") / F.col("total_content_items")).alias("avg_events_per_content"),
        completion_rate(F.col("total_plays"), F.col("total_finishes")).alias("completion_rate"),
    )


def device_analysis(events: DataFrame) -> DataFrame:
    """Per device, busiest first; events without a content or a device count too."""
    grouped = events.groupBy("device").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_type") == "play").alias("play_count"),
        F.count_if(F.col("event_type") == "finish").alias("finish_count"),
        F.avg("duration_ms").alias("avg_duration_ms"),
        F.count("user_id").alias("unique_users"),
    )
    rate = completion_rate(F.col("play_count"), F.col("finish_count"))
    return grouped.withColumn("completion_rate", rate).orderBy(F.col("total_events").desc())


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """One row over ``content_engagement_metrics``; zeros where the table is empty."""
    two_places = "decimal(10,2)"
    zero = F.lit(0).cast(two_places)
    return metrics.agg(
        F.coalesce(F.avg("total_events").cast(two_places), zero).alias("avg_events"),
        F.coalesce(F.avg("engagement_score").cast(two_places), zero).alias("avg_engagement_score"),
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"),
    )


Save = Callable[[DataFrame, str], None]


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A step that several tables start from, written to the shared folder and read back: losing
    an executor later costs a re-read of this table, and never of the events."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_analysis(content: DataFrame, events: DataFrame, save: Save) -> None:
    """Make the four tables and hand each, typed, to ``save(table, name)``."""
    rollup = _stored(r.daily_rollup(events, content), "daily-rollup")
    per_content = _stored(r.resummarise(r.spread_types(rollup), "content_id"), "content-summary")
    tables = {
        "content_engagement_metrics": content_engagement_metrics(content, per_content),
        "content_engagement_daily": content_engagement_daily(content, rollup),
        "content_type_analysis": content_type_analysis(content, per_content),
        "device_analysis": device_analysis(events),
    }
    _save_all(tables, content, save)


def run_export(content: DataFrame, events: DataFrame, save: Save) -> None:
    """Make the two export tables, both from one summary per content and day."""
    day = F.to_date("event_ts").alias("event_date")
    daily = _stored(r.summarise(r.events_with_content(events), "content_id", day), "daily-summary")
    tables = {
        "content_metrics_export": content_metrics_export(content, r.resummarise(daily, "content_id")),
        "content_engagement_daily_export": content_engagement_daily_export(content, daily),
    }
    _save_all(tables, content, save)


def _save_all(tables: dict[str, DataFrame], content: DataFrame, save: Save) -> None:
    id_type = content.schema["id"].dataType
    for name, table in tables.items():
        save(conform(table, result_schema(name, id_type)), name)
