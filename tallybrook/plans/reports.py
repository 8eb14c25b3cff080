"""Small reports over the source and result tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybrook.functions.text import key_of
from tallybrook.operators.latest import latest_per_key, latest_per_many_keys
from tallybrook.sources.tables import matching_tables, newest


def count_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def first_content(content: DataFrame, n: int = 10) -> DataFrame:
    return content.orderBy("id").limit(n)


def recent_content(content: DataFrame, n: int = 50) -> DataFrame:
    shown = content.select("id", "slug", "title", "content_type", "length_seconds", "publish_ts")
    return newest(shown, "publish_ts", n)


def recent_events(events: DataFrame, n: int = 20) -> DataFrame:
    shown = events.select("id", "content_id", "event_type", "event_ts", "duration_ms", "device")
    return newest(shown, "event_ts", n)


def latest_events_per_content(events: DataFrame, n: int = 100) -> DataFrame:
    """The ring of each content: its newest events by id, rank 1 the newest."""
    return latest_per_many_keys(events.where(F.col("content_id").isNotNull()), "content_id", n)


def latest_events_per_type(events: DataFrame, n: int = 1000) -> DataFrame:
    """The ring of each event type; events without a type have a ring of their own."""
    return latest_per_key(events, "event_type", n)


def ring_range(ring: DataFrame, first: int, last: int) -> DataFrame:
    """Positions ``first`` to ``last`` of every ring, counted from 0, both ends included."""
    return ring.where(F.col("rank").between(first + 1, last + 1))


def daily_on(daily: DataFrame, day) -> DataFrame:
    """One day's rows of the daily table, most events first. ``day`` may be ``current_date()``."""
    return daily.where(F.col("event_date") == day).orderBy(F.col("events_count").desc())


def metrics_by_events(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.col("total_events").desc())


def event_stats(events: DataFrame) -> DataFrame:
    """``stats:*`` keys: one total and one count per event type, from one pass over the events."""
    per_type = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = per_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.select(F.lit("stats:total_events").alias("key"), "n").unionByName(
        per_type.select(key_of("stats", "events", F.col("event_type")).alias("key"), "n")
    )


# Name patterns by which result tables are recognised (fixed values).
ANALYSIS_PATTERNS = ("%analysis%", "%metrics%")


def matching_counts(spark: SparkSession, counts: dict[str, int], patterns=ANALYSIS_PATTERNS) -> DataFrame:
    """Of the rows counted while tables were written, those of tables whose names match."""
    return matching_tables(spark.createDataFrame(sorted(counts.items()), "table_name string, n bigint"), patterns)


def analysis_table_counts(tables: dict[str, DataFrame], patterns=ANALYSIS_PATTERNS) -> DataFrame:
    """Row counts of the tables whose names match; a plain ``%`` pattern, as in SQL LIKE."""
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return matching_tables(counts, patterns)
