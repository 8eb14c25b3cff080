"""The serving view: one table of (family, key, value) that a key/value reader can load as it is.

Values are text: JSON for records and lists, digits for counters. Every row has the lifetime of its
key; readers skip rows that have expired. Families partition the table on disk, so a lookup of one
kind of key does not read the others.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.functions.text import iso_text, key_of, record_json
from tallybrook.operators.enrich import ENRICHED, enrich_events
from tallybrook.plans import reports

HOUR, MINUTE = 3600, 60
CONTENT_LIST, RECENT_EVENTS = 50, 20
CONTENT_RING, TYPE_RING = 100, 1000


def _text_ids(*columns: str) -> dict[str, Column]:
    return {c: F.col(c).cast("string") for c in columns}


def event_record() -> Column:
    """The stored record of one enriched event."""
    shaped = {**_text_ids("content_id", "user_id"), "event_ts": iso_text(F.col("event_ts"))}
    return F.struct(*[shaped.get(c, F.col(c)).alias(c) for c in ENRICHED])


def content_record() -> Column:
    shaped = {**_text_ids("id"), "publish_ts": iso_text(F.col("publish_ts"))}
    columns = ("id", "slug", "title", "content_type", "length_seconds", "publish_ts")
    return F.struct(*[shaped.get(c, F.col(c)).alias(c) for c in columns])


def recent_record() -> Column:
    shaped = {**_text_ids("content_id"), "event_ts": iso_text(F.col("event_ts"))}
    columns = ("id", "content_id", "event_type", "event_ts", "duration_ms", "device")
    return F.struct(*[shaped.get(c, F.col(c)).alias(c) for c in columns])


def entries(
    rows: DataFrame, family: str, key: Column, value: Column, ttl: int | None, written_at: Column | None = None
) -> DataFrame:
    """Rows of the view; ``written_at`` where rows were written at times of their own."""
    columns = [
        F.lit(family).alias("family"),
        key.alias("key"),
        value.cast("string").alias("value"),
        F.lit(ttl).cast("int").alias("ttl_seconds"),
    ]
    if written_at is not None:
        columns.append(written_at.alias("written_at"))
    return rows.select(*columns)


def _ordered_list(order: Column, record: Column) -> Column:
    """Records of a group that is bounded by its feature (a ring, a top-k), in order."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("_at"), record.alias("_record"))))
    return record_json(F.transform(pairs, lambda p: p["_record"]))


def event_entries(enriched: DataFrame, written_at: Column | None = None) -> DataFrame:
    """``event:{id}``: a projection, without a shuffle."""
    key = key_of("event", F.col("id"))
    return entries(enriched, "event", key, record_json(event_record()), HOUR, written_at)


def ring_entries(ring: DataFrame, family: str, key: Column, by: str, written_at: Column | None) -> DataFrame:
    """Ring lists, newest first. ``ring`` holds enriched events with their ``rank``."""
    lists = ring.groupBy(by).agg(
        _ordered_list(F.col("rank"), event_record()).alias("_list"),
        *([] if written_at is None else [F.max(written_at).alias("_at")]),
    )
    return entries(lists, family, key, F.col("_list"), HOUR, None if written_at is None else F.col("_at"))


def content_ring_entries(ring: DataFrame, written_at: Column | None = None) -> DataFrame:
    key = key_of("content", F.col("content_id"), "events")
    return ring_entries(ring, "content_events", key, "content_id", written_at)


def type_ring_entries(ring: DataFrame, written_at: Column | None = None) -> DataFrame:
    key = key_of("events", F.col("event_type"))
    return ring_entries(ring, "type_events", key, "event_type", written_at)


def content_entries(content: DataFrame, n: int = CONTENT_LIST) -> DataFrame:
    """Snapshot of the newest items: one key each, the list of them, and how many they are."""
    latest = reports.recent_content(content, n)
    items = entries(latest, "content", key_of("content", F.col("id")), record_json(content_record()), HOUR)
    order = F.struct(-F.unix_micros(F.col("publish_ts").cast("timestamp")), "id")
    listed = latest.agg(_ordered_list(order, content_record()).alias("_list"), F.count(F.lit(1)).alias("_n"))
    whole = entries(listed, "content_list", F.lit("content:list"), F.col("_list"), HOUR)
    size = entries(listed, "content_list", F.lit("content:count"), F.col("_n"), HOUR)
    return items.unionByName(whole).unionByName(size)


def stats_entries(events: DataFrame) -> DataFrame:
    counts = entries(reports.event_stats(events), "stats", F.col("key"), F.col("n"), HOUR)
    latest = reports.recent_events(events, RECENT_EVENTS)
    order = F.struct(-F.unix_micros(F.col("event_ts").cast("timestamp")), "id")
    listed = latest.agg(_ordered_list(order, recent_record()).alias("_list"))
    return counts.unionByName(
        entries(listed, "stats", F.lit("engagement:recent"), F.col("_list"), HOUR)
    )


def analysis_entries(table_counts: DataFrame, summary: DataFrame) -> DataFrame:
    """``table_counts`` and ``summary`` as made by the reports and the metrics summary."""
    counts = entries(
        table_counts, "analysis", key_of("analysis", F.col("table_name"), "count"), F.col("n"), HOUR
    )
    record = F.struct(
        F.col("avg_events").cast("double").alias("avg_events"),
        F.col("avg_engagement_score").cast("double").alias("avg_engagement_score"),
        F.col("total_events"),
    )
    return counts.unionByName(
        entries(summary, "analysis", F.lit("analysis:metrics:summary"), record_json(record), HOUR)
    )


def progress_entries(progress: DataFrame) -> DataFrame:
    """``streaming:*`` keys from one row (event_count, latest_id, total_events, updated_at)."""
    at = F.col("updated_at")
    beat = F.struct(iso_text(at).alias("timestamp"), "event_count", "latest_id")
    values = {
        "latest_event_id": (F.col("latest_id"), None),
        "total_events": (F.col("total_events"), None),
        "last_update": (record_json(beat), MINUTE),
    }
    parts = [
        entries(progress, "streaming", F.lit(f"streaming:{name}"), value, ttl, at)
        for name, (value, ttl) in values.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def with_expiry(view: DataFrame, written_at: Column | None = None) -> DataFrame:
    """Add when each row expires. Without ``written_at`` the rows bring their own."""
    lifetime = F.make_dt_interval(secs=F.col("ttl_seconds"))
    if written_at is not None:
        view = view.withColumn("written_at", written_at)
    return view.withColumn(
        "expires_at", F.when(F.col("ttl_seconds").isNotNull(), F.col("written_at") + lifetime)
    )


def alive(view: DataFrame, now: Column) -> DataFrame:
    """Rows a reader may still see. Keys without a lifetime never expire."""
    return view.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def lookup(view: DataFrame, key: str, family: str | None = None) -> DataFrame:
    """One key; naming its family as well prunes the scan to that partition."""
    if family is not None:
        view = view.where(F.col("family") == family)
    return view.where(F.col("key") == key)


def all_keys(view: DataFrame) -> DataFrame:
    return view.select("key").distinct()


def key_count(view: DataFrame) -> DataFrame:
    return view.agg(F.count_distinct("key").alias("n_keys"))


def rings(events: DataFrame, content: DataFrame, by: str, n: int, **join) -> DataFrame:
    """Enriched ring members. Ranking comes first, so only members are joined to their content,
    and no content has more than ``n`` of them per ring."""
    ranked = (
        reports.latest_events_per_content(events, n)
        if by == "content_id"
        else reports.latest_events_per_type(events, n)
    )
    return enrich_events(ranked, content, keep=("rank",), skewed=False, **join)


def cache_view(
    content: DataFrame, events: DataFrame, table_counts: DataFrame, summary: DataFrame, written_at: Column
) -> DataFrame:
    """The keys of one cache cycle: items, statistics, analysis results and the cycle's stamp."""
    stamp = summary.select(iso_text(written_at).alias("_at"))
    return with_expiry(
        content_entries(content)
        .unionByName(stats_entries(events))
        .unionByName(analysis_entries(table_counts, summary))
        .unionByName(entries(stamp, "cache", F.lit("cache:last_update"), F.col("_at"), HOUR)),
        written_at,
    )


def events_view(content: DataFrame, events: DataFrame, written_at: Column, **join) -> DataFrame:
    """The keys of the enriched events: one per event, one ring per content and per type."""
    return with_expiry(
        event_entries(enrich_events(events, content, **join))
        .unionByName(content_ring_entries(rings(events, content, "content_id", CONTENT_RING, **join)))
        .unionByName(type_ring_entries(rings(events, content, "event_type", TYPE_RING, **join))),
        written_at,
    )


def write_view(view: DataFrame, path: str) -> None:
    """One folder per family; large families are split, small ones merged, by the planner."""
    view.hint("rebalance", "family").write.mode("overwrite").partitionBy("family").parquet(path)
