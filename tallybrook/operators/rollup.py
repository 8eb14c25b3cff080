"""Mergeable summaries of events.

``summarise`` counts and sums events by any set of keys; ``resummarise`` merges such summaries to
coarser keys and gives the same numbers as summarising the events directly. Averages are divided
only at the end, so merging never averages averages. Summaries are partly built before the shuffle,
so a key that holds a third of all events sends one row per task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.functions.measures import pct_hundredths
from tallybrook.operators.enrich import with_content
from tallybrook.schemas import EVENT_TYPES

ROLLUP_KEYS = ("content_id", "event_type", "event_date")
_COUNTED = ("n_events", "n_users", "n_ms", "sum_ms")
_PER_TYPE = tuple(f"n_{kind}" for kind in EVENT_TYPES)
_PERCENT = ("n_pct", "sum_pct")


def summarise(events: DataFrame, *keys: str | Column) -> DataFrame:
    """Counts, sums and bounds of the events per key. Sums stay null where nothing was measured."""
    return events.groupBy(*keys).agg(
        F.count("id").alias("n_events"),
        F.count("user_id").alias("n_users"),
        F.count("duration_ms").alias("n_ms"),
        F.sum("duration_ms").alias("sum_ms"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        *[F.count_if(F.col("event_type") == kind).alias(f"n_{kind}") for kind in EVENT_TYPES],
    )


def resummarise(summary: DataFrame, *keys: str) -> DataFrame:
    have = set(summary.columns)
    sums = [c for c in (*_COUNTED, *_PER_TYPE, *_PERCENT) if c in have]
    return summary.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )


def events_with_content(events: DataFrame) -> DataFrame:
    return events.where(F.col("content_id").isNotNull())


def by_content(events: DataFrame) -> DataFrame:
    return summarise(events_with_content(events), "content_id")


def daily_rollup(events: DataFrame, content: DataFrame, **join) -> DataFrame:
    """Per content, event type and day, with the percent sums: the base of the content tables.

    The percent of an event needs its content's length, so the length (and nothing else) is joined
    to the events before they are grouped.
    """
    named = events_with_content(events)
    measured = with_content(named, content, "length_seconds", **join).withColumns(
        {
            "event_date": F.to_date("event_ts"),
            "_pct": pct_hundredths(F.col("duration_ms"), F.col("length_seconds")),
        }
    )
    return measured.groupBy(*ROLLUP_KEYS).agg(
        F.count("id").alias("n_events"),
        F.count("user_id").alias("n_users"),
        F.count("duration_ms").alias("n_ms"),
        F.sum("duration_ms").alias("sum_ms"),
        F.count("_pct").alias("n_pct"),
        F.sum("_pct").alias("sum_pct"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )


def spread_types(rollup: DataFrame) -> DataFrame:
    """A rollup keyed by event type, with one count column per type instead."""
    kind, n = F.col("event_type"), F.col("n_events")
    return rollup.withColumns(
        {f"n_{t}": F.when(kind == t, n).otherwise(F.lit(0)) for t in EVENT_TYPES}
    )


def mean(total: str, n: str) -> Column:
    """Null where nothing was counted."""
    return F.when(F.col(n) > 0, F.col(total) / F.col(n))


def distinct_users(events: DataFrame, *keys: str) -> DataFrame:
    """Exact distinct users per key. Distinct (key, user) pairs are formed first, spread over both,
    so a popular key is counted by many tasks."""
    pairs = events.where(F.col("user_id").isNotNull()).select(*keys, "user_id").distinct()
    return pairs.groupBy(*keys).agg(F.count("user_id").alias("unique_users"))


def user_sketches(events: DataFrame, *keys: str) -> DataFrame:
    """One small mergeable sketch of the users per key, for when exact pairs are too many."""
    return events.groupBy(*keys).agg(
        F.hll_sketch_agg(F.col("user_id").cast("string")).alias("user_sketch")
    )


def merge_user_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("user_sketch")).alias("unique_users")
    )


# Three standard errors of a sketch of 2**12 registers, 1.04 / 64 each.
SKETCH_ERROR = 0.05


def store_user_sketches(events: DataFrame, path: str, *keys: str) -> None:
    """One sketch per key and day, by month: the users of any range of days follow from these alone.

    An event without a time is on no day. A day is rewritten with its month.
    """
    daily = user_sketches(events.withColumn("event_date", F.to_date("event_ts")).where("event_date is not null"), *keys, "event_date")
    monthly = daily.withColumn("event_month", F.date_format("event_date", "yyyyMM").cast("int"))
    monthly.repartition("event_month").write.mode("overwrite").partitionBy("event_month").parquet(path)


def users_between(sketches: DataFrame, low, high, *keys: str) -> DataFrame:
    """Different users per key on the days from ``low`` to ``high``, within ``SKETCH_ERROR`` of their number.

    Opens the months of the range only; sketches merge before they are shuffled.
    """
    month = lambda day: day.year * 100 + day.month
    days = sketches.where(F.col("event_month").between(month(low), month(high)) & F.col("event_date").between(F.lit(low), F.lit(high)))
    return merge_user_sketches(days, *keys)
