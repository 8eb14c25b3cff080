"""Every registered query, over the test tables: name -> (spark, folder) -> DataFrame."""

from datetime import date, datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybrook.operators import maintain, quality
from tallybrook.operators import rollup as r
from tallybrook.operators.enrich import enrich_events, export_rows, next_events
from tallybrook.operators.keyed_join import keyed_join
from tallybrook.plans import analysis, reports, serving
from tallybrook.session import scratch, use_utc
from tallybrook.functions import text
from tallybrook.sinks.tables import create_table, insert_into, into_folder
from tallybrook.sources import tables, testdata

WRITTEN_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
DAY = date(2024, 1, 15)
SHIFT = 10_000_000_000  # above every identifier of the test data


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    use_utc(spark)
    return testdata.content(spark, sf_dir), testdata.engagement_events(spark, sf_dir)


def over_sources(query):
    """A query of (content, events) as one of (spark, folder)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return testdata.as_wall_clock(query(*_sources(spark, sf_dir)))

    return run


def over_folder(query):
    """A query that reads further test tables itself."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return testdata.as_wall_clock(query(spark, sf_dir))

    return run


def metrics(content: DataFrame, events: DataFrame) -> DataFrame:
    return analysis.content_engagement_metrics(content, r.by_content(events))


def daily(content: DataFrame, events: DataFrame) -> DataFrame:
    return analysis.content_engagement_daily(content, r.daily_rollup(events, content))


def written_tables(content: DataFrame, events: DataFrame) -> tuple[str, DataFrame]:
    """The analysis tables, written once, and their row counts, taken while they were written."""
    root, counts = scratch(content.sparkSession, "analysis"), {}
    analysis.run_analysis(content, events, into_folder(root, counts))
    return root, reports.matching_counts(content.sparkSession, counts)


def table_counts(content: DataFrame, events: DataFrame) -> DataFrame:
    return written_tables(content, events)[1]


def summary(content: DataFrame, events: DataFrame) -> DataFrame:
    return analysis.metrics_summary(metrics(content, events))


def serving_view(content: DataFrame, events: DataFrame) -> DataFrame:
    root, counts = written_tables(content, events)
    known = analysis.metrics_summary(content.sparkSession.read.parquet(f"{root}/content_engagement_metrics"))
    cached = serving.cache_view(content, events, counts, known, F.lit(WRITTEN_AT))
    return cached.unionByName(serving.events_view(content, events, F.lit(WRITTEN_AT)))


def key_families(content: DataFrame, events: DataFrame) -> DataFrame:
    keys = serving.all_keys(serving_view(content, events))
    family = F.substring_index("key", ":", 1)
    return keys.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("n_keys"))


# Feeds of changes, made from the test tables: the raw kind of an event says what happens to it.


def changed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of ``view`` events, late and so outdated copies of ``signup`` events, new rows
    for ``purchase`` events, and unchanged copies of ``click`` events."""
    events = testdata.engagement_events(spark, sf_dir)
    kind = F.col("event_type")
    day = F.expr("INTERVAL 1 DAY")
    return events.where(kind.isNotNull()).select(
        F.when(kind == "finish", F.col("id") + SHIFT).otherwise(F.col("id")).alias("id"),
        "content_id",
        "user_id",
        "event_type",
        "event_ts",
        F.when(kind.isin("play", "pause"), F.col("duration_ms") * 2)
        .otherwise(F.col("duration_ms"))
        .alias("duration_ms"),
        "device",
        "raw_payload",
        F.when(kind == "play", F.col("updated_at") + day)
        .when(kind == "pause", F.col("updated_at") - day)
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )


def events_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.engagement_events(spark, sf_dir)
    changed = changed_events(spark, sf_dir)
    earlier = changed.withColumn("updated_at", F.col("updated_at") - F.expr("INTERVAL 1 HOUR"))
    touched = F.lit("2024-03-01").cast("timestamp_ntz")
    return maintain.upsert(events, changed.unionByName(earlier), touch=touched)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of ``changed_events`` as an upsert, followed for ``pause`` events by a delete,
    and for ``click`` events preceded by one."""
    changed = changed_events(spark, sf_dir)
    ups = changed.withColumns({"op": F.lit("u"), "seq": F.col("id") * 3 + 1})
    kind = F.col("event_type")
    downs = changed.where(kind.isin("pause", "click")).withColumns(
        {"op": F.lit("d"), "seq": F.col("id") * 3 + F.when(kind == "pause", 2).otherwise(0)}
    )
    return ups.unionByName(downs)


def apply_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.engagement_events(spark, sf_dir)
    return maintain.apply_change_feed(events, change_feed(spark, sf_dir))


def incoming_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New items offered to the catalogue, each slug twice, some of them known already."""
    number = F.expr("p_partkey div 2 * 3")
    return testdata.raw_parts(spark, sf_dir).select(
        (F.col("p_partkey") + SHIFT).alias("id"),
        F.concat(F.lit("part-"), number.cast("string")).alias("slug"),
        F.col("p_name").alias("title"),
    )


def content_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintain.insert_if_absent(
        testdata.content(spark, sf_dir), incoming_content(spark, sf_dir), "slug", "id"
    )


def events_insert_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New events of the offered items, numbered on from the stored ones."""
    fresh = content_insert_if_absent(spark, sf_dir).select("slug", F.col("title"))
    start = maintain.next_serial(testdata.engagement_events(spark, sf_dir))
    return maintain.with_serial(fresh, "slug", start).select("id", "slug", "title")


def retired_content(content: DataFrame) -> DataFrame:
    return content.where(F.col("content_type") == "newsletter")


def cascade_delete_events(content: DataFrame, events: DataFrame) -> DataFrame:
    return maintain.cascade_delete(events, retired_content(content).select("id"))


def quality_orphans(content: DataFrame, events: DataFrame) -> DataFrame:
    """Checked against the catalogue without its retired items."""
    current = content.where(F.col("content_type") != "newsletter")
    return quality.orphans(events, current).select("id", "content_id")


def faulty_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part list taken as it is: its types, names and brands are not ours."""
    return testdata.raw_parts(spark, sf_dir).select(
        F.col("p_partkey").alias("id"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("slug"),
        F.when(F.col("p_size") > 5, F.col("p_name")).alias("title"),
        F.lower("p_type").alias("content_type"),
    )


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry taken as it is: kinds of events we do not know, errors without a time."""
    kind = F.col("event_type")
    return testdata.raw_events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.when(kind != "click", kind).alias("event_type"),
        F.when(kind != "error", F.col("ts")).alias("event_ts"),
        F.when(F.col("value") > 1.0, F.col("ts")).alias("updated_at"),
        F.col("user_id").alias("session_id"),
    )


def quality_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_violations(faulty_content(spark, sf_dir), "content").unionByName(
        quality.domain_violations(faulty_events(spark, sf_dir), "engagement_events")
    )


def quality_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_violations(faulty_content(spark, sf_dir), "content").unionByName(
        quality.null_violations(faulty_events(spark, sf_dir), "engagement_events")
    )


def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(faulty_content(spark, sf_dir), "content", "id", "slug").unionByName(
        quality.duplicate_keys(faulty_events(spark, sf_dir), "engagement_events", "id", "session_id")
    )


def quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events are valid and why the others are not."""
    valid, rejected = quality.split_valid(faulty_events(spark, sf_dir), "engagement_events")
    both = valid.withColumn("reason", F.lit("valid")).unionByName(rejected)
    return reports.count_by(both, "reason")


def payload_by_slug(content: DataFrame, events: DataFrame) -> DataFrame:
    """Events that name their content by slug (stored ones and an inline list), given its id."""
    spark = events.sparkSession
    inline = spark.sql(
        """
        SELECT * FROM VALUES
            ('part-7', 'play', 300000, 'ios', '{"k": 7}'),
            ('part-7', 'finish', 1800000, 'ios', '{"k": 7}'),
            ('part-9', 'click', NULL, 'web-edge', '{"k": 9}'),
            ('part-none', 'click', NULL, 'web-edge', '{"k": 0}')
        AS t(slug, event_type, duration_ms, device, raw_payload)
        """
    )
    named = events.select(
        "id",
        F.concat(F.lit("part-"), F.get_json_object("raw_payload", "$.k")).alias("slug"),
        "event_type",
        "duration_ms",
        "device",
        "raw_payload",
    )
    ids = content.select("slug", F.col("id").alias("content_id"))
    k = F.get_json_object("raw_payload", "$.k").try_cast("int")
    offered = named.unionByName(inline, allowMissingColumns=True).withColumn("k", k)
    return keyed_join(offered, ids, "slug", "inner").select(
        "content_id", "event_type", "duration_ms", "device", "k"
    )


def incremental_by_updated_at(content: DataFrame, events: DataFrame) -> DataFrame:
    """The export of all events in three increments that overlap by ten minutes, as a poller with
    late commits reads them; a change that two increments see is exported once. Identifiers
    and payload leave as text."""
    cuts = [None, datetime(2024, 1, 10), datetime(2024, 1, 20), None]
    overlap = F.expr("INTERVAL 10 MINUTES")
    parts = None
    for low, high in zip(cuts, cuts[1:]):
        low = None if low is None else F.lit(low).cast("timestamp_ntz") - overlap
        high = None if high is None else F.lit(high).cast("timestamp_ntz")
        part = tables.changed_between(events, low, high)
        parts = part if parts is None else parts.unionByName(part)
    once = parts.dropDuplicates(["id", "updated_at"])
    named = content.withColumn("id", F.col("id").cast("string"))
    return export_rows(tables.with_text_ids(once), named)


RANGES = ((date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 1, 8), date(2024, 1, 14)), (DAY, DAY))


def users_by_range(content: DataFrame, events: DataFrame) -> DataFrame:
    """Different users per type and range of days, counted, and whether the stored sketches come near that."""
    path = scratch(events.sparkSession, "user-sketches")
    r.store_user_sketches(events, path, "event_type")
    stored = events.sparkSession.read.parquet(path)

    def one(low: date, high: date) -> DataFrame:
        exact = r.distinct_users(events.where(F.to_date("event_ts").between(F.lit(low), F.lit(high))), "event_type")
        close = r.users_between(stored, low, high, "event_type").withColumnsRenamed({"event_type": "_type", "unique_users": "_n"})
        near = F.abs(F.col("_n") - F.col("unique_users")) <= r.SKETCH_ERROR * F.col("unique_users") + 1
        return exact.join(close, F.col("event_type").eqNullSafe(F.col("_type")), "left").select(
            F.lit(low).alias("first_day"), F.lit(high).alias("last_day"), "event_type", "unique_users",
            F.coalesce(near, F.lit(False)).alias("sketch_is_near"))

    return reduce(DataFrame.unionByName, (one(low, high) for low, high in RANGES))


def payload_fields(content: DataFrame, events: DataFrame) -> DataFrame:
    """The payload's fields in the types that all payloads together ask for."""
    return text.with_variant_fields(events.select("id", "raw_payload"), "raw_payload").drop("raw_payload")


def typed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events inserted into a catalogue table by joining them to another one; what an insert leaves out has a default."""
    items, events = testdata.content(spark, sf_dir), testdata.engagement_events(spark, sf_dir)
    own = uuid4().hex
    create_table(spark, f"content_{own}", items.schema)
    insert_into(items, f"content_{own}")
    defaults = {"device": "'unknown'", "updated_at": "TIMESTAMP_NTZ '2024-02-01 00:00:00'"}
    create_table(spark, f"events_{own}", events.schema, defaults=defaults)
    known = spark.table(f"content_{own}").select(F.col("id").alias("content_id"))
    named = keyed_join(events, known, "content_id", "inner")
    insert_into(named.where("device is not null"), f"events_{own}")
    insert_into(named.where("device is null").drop("device", "updated_at"), f"events_{own}")
    return spark.table(f"events_{own}")


def point_lookup(content: DataFrame, events: DataFrame) -> DataFrame:
    view = serving.event_entries(enrich_events(events, content))
    return serving.lookup(view, "event:76", "event").select("key", "value", "ttl_seconds")


def ring_head(content: DataFrame, events: DataFrame) -> DataFrame:
    return reports.ring_range(reports.latest_events_per_content(events), 0, 10)


_ring = ("id", "content_id", "event_type", "event_ts", "duration_ms", "rank")

BATCH_QUERIES = {
    "enriched_events": over_sources(lambda c, e: enrich_events(e, c)),
    "content_engagement_metrics": over_sources(metrics),
    "content_engagement_metrics_distinct": over_sources(analysis.content_engagement_metrics_distinct),
    "content_engagement_daily": over_sources(daily),
    "content_engagement_daily_export": over_sources(
        lambda c, e: analysis.content_engagement_daily_export(c, analysis.by_content_and_day(e))
    ),
    "content_metrics_export": over_sources(
        lambda c, e: analysis.content_metrics_export(c, r.by_content(e))
    ),
    "content_type_analysis": over_sources(
        lambda c, e: analysis.content_type_analysis(c, r.by_content(e))
    ),
    "content_type_analysis_corrected": over_sources(
        lambda c, e: analysis.content_type_analysis(c, r.by_content(e), corrected=True)
    ),
    "device_analysis": over_sources(lambda c, e: analysis.device_analysis(e)),
    "content_by_type": over_sources(lambda c, e: reports.count_by(c, "content_type")),
    "events_by_type": over_sources(lambda c, e: reports.count_by(e, "event_type")),
    "first_content": over_sources(lambda c, e: reports.first_content(c)),
    "recent_content": over_sources(lambda c, e: reports.recent_content(c)),
    "recent_events": over_sources(lambda c, e: reports.recent_events(e)),
    "latest_ten_events": over_sources(lambda c, e: tables.newest(e, "event_ts", 10)),
    "latest_events_per_content": over_sources(
        lambda c, e: reports.latest_events_per_content(e).select(*_ring)
    ),
    "latest_events_per_type": over_sources(
        lambda c, e: reports.latest_events_per_type(e).select(*_ring)
    ),
    "ring_head": over_sources(lambda c, e: ring_head(c, e).select(*_ring)),
    "metrics_summary": over_sources(summary),
    "metrics_by_events": over_sources(lambda c, e: reports.metrics_by_events(metrics(c, e))),
    "todays_daily_by_events": over_sources(lambda c, e: reports.daily_on(daily(c, e), DAY)),
    "analysis_table_counts": over_sources(table_counts),
    "event_stats": over_sources(lambda c, e: reports.event_stats(e)),
    "serving_view": over_sources(serving_view),
    "serving_keys": over_sources(key_families),
    "serving_lookup": over_sources(point_lookup),
    "incremental_by_id": over_sources(lambda c, e: next_events(e, c, cursor=0)),
    "incremental_by_updated_at": over_sources(incremental_by_updated_at),
    "content_insert_if_absent": over_folder(content_insert_if_absent),
    "events_insert_serial": over_folder(events_insert_serial),
    "events_upsert": over_folder(events_upsert),
    "apply_change_feed": over_folder(apply_change_feed),
    "cascade_delete_events": over_sources(cascade_delete_events),
    "quality_orphans": over_sources(quality_orphans),
    "quality_domain": over_folder(quality_domain),
    "quality_nulls": over_folder(quality_nulls),
    "quality_duplicates": over_folder(quality_duplicates),
    "quality_split": over_folder(quality_split),
    "payload_join_by_slug": over_sources(payload_by_slug),
    "users_by_range": over_sources(users_by_range),
    "payload_fields": over_sources(payload_fields),
    "typed_tables": over_folder(typed_tables),
}
