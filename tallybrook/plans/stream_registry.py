"""Registered queries that run a stream to its end and return what it wrote."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from tallybrook.plans import serving
from tallybrook.plans.registry import over_folder
from tallybrook.operators.enrich import export_rows
from tallybrook.session import scratch
from tallybrook.sinks.folders import data_files
from tallybrook.sinks.tables import partitioned_export
from tallybrook.sources import tables, testdata
from tallybrook.sources.kafka import envelope_files
from tallybrook.streaming import envelope, polling, rings, serve, windows
from tallybrook.streaming.runner import drain

BATCHES = 4
PAGE = 40_000
# Rows of one file of a feed, if a step's rows are even: no task writes or reads a whole step.
FILE_ROWS = 100_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.as_instants(testdata.engagement_events(spark, sf_dir))


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.as_instants(testdata.content(spark, sf_dir))


def in_slices(rows: DataFrame, by: str, path: str, slices: int = BATCHES) -> int:
    """Write all rows to a folder in ``slices`` steps of rising ``by``, as a feed would arrive.

    Every step has the same number of files, which is returned: a stream that takes that many per
    trigger sees one step per batch, and no batch holds rows older than an earlier one.
    """
    spark = rows.sparkSession
    low, high, n = rows.agg(F.min(by), F.max(by), F.count(F.lit(1))).first()
    step = (high - low) // slices + 1
    files = max(-(-len(rows.inputFiles()) // slices), -(-n // (slices * FILE_ROWS)))
    for i in range(slices):
        start = low + i * step
        part = rows.where((F.col(by) >= start) & (F.col(by) < start + step))
        part.repartition(files).write.mode("append").parquet(path)
        # A step of fewer rows than files lacks some of them.
        for _ in range(data_files(spark, path), files * (i + 1)):
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(path)
    return files


def event_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    raw = testdata.raw_events(spark, sf_dir)
    per_step = in_slices(raw, "event_id", f"{folder}/input")
    files = (
        spark.readStream.schema(raw.schema)
        .option("maxFilesPerTrigger", per_step)
        .parquet(f"{folder}/input")
    )
    return testdata.as_instants(testdata.events_view(files))


def _served(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch(spark, "serve")
    stream = event_stream(spark, sf_dir, folder)
    handler = serve.serve_events(lambda: _content(spark, sf_dir), f"{folder}/out")
    drain(stream, handler, f"{folder}/checkpoint")
    return f"{folder}/out"


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.read_enriched(spark, _served(spark, sf_dir))


def stream_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of ring, the first batches folded into a base."""
    root = _served(spark, sf_dir)
    columns = ("id", "content_id", "event_type", "engagement_pct", "rank")
    kinds = None
    for key, n in serve.RINGS.items():
        path = serve.ring_path(root, key)
        rings.fold(spark, path, key, n, ttl_seconds=3600, through=1)
        ring = rings.read(spark, path, key, n).select(F.lit(key).alias("ring"), *columns)
        kinds = ring if kinds is None else kinds.unionByName(ring)
    return kinds


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.progress(spark, _served(spark, sf_dir)).drop("updated_at")


def stream_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heartbeat's count and latest id, as they stand in its value."""
    beat = serving.progress_entries(serve.progress(spark, _served(spark, sf_dir))).where(F.col("key") == "streaming:last_update")
    said = lambda name: F.get_json_object("value", f"$.{name}").try_cast("long").alias(name)
    return beat.select("key", said("event_count"), said("latest_id"), "ttl_seconds")


def stream_serving_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key but the heartbeat, whose value is the time of the run."""
    shown = serve.view(spark, _served(spark, sf_dir)).drop("written_at", "expires_at")
    return shown.where(F.col("key") != "streaming:last_update")


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving view after two rounds of merging, its batches gone."""
    root = _served(spark, sf_dir)
    serve.tidy(spark, root, fan_out=2)
    serve.tidy(spark, root, fan_out=2, ended=True)
    shown = serve.view(spark, root).drop("written_at", "expires_at")
    return shown.where(F.col("key") != "streaming:last_update")


def stream_window_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "windows")
    drain(event_stream(spark, sf_dir, folder), windows.keep_windows(f"{folder}/out"), f"{folder}/checkpoint")
    return windows.read_windows(spark, f"{folder}/out").drop("closed")


def stream_window_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed far out of order: events counted in their window, and those that came behind it."""
    folder = scratch(spark, "late-windows")
    raw = testdata.raw_events(spark, sf_dir)
    per_step = in_slices(raw.withColumn("turn", F.col("event_id") % BATCHES), "turn", f"{folder}/input")
    files = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", per_step).parquet(f"{folder}/input")
    stream = testdata.as_instants(testdata.events_view(files))
    drain(stream, windows.keep_windows(f"{folder}/out"), f"{folder}/checkpoint")
    key = ["window_start", "event_type"]
    on_time = windows.read_windows(spark, f"{folder}/out").select(*key, "n_events", F.lit(0).cast("long").alias("n_late"))
    late = windows.read_late(spark, f"{folder}/out").select(*key, F.lit(0).cast("long").alias("n_events"), F.lit(1).cast("long").alias("n_late"))
    return on_time.unionByName(late).groupBy(*key).agg(F.sum("n_events").alias("n_events"), F.sum("n_late").alias("n_late"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on a four-partition bus. Those of an unknown kind carry a body that is not JSON; of the others
    some have a length that is no number, some no time or one that is none, some no id, and some are cut short."""
    events = _events(spark, sf_dir)
    unknown = F.concat(F.lit("error at "), F.coalesce("device", F.lit("no device")))
    number = F.col("id").cast("string")
    body = (
        F.when(F.col("event_type").isNull(), unknown)
        .when(F.col("id") % 11 == 5, F.concat(F.lit('{"id":'), number, F.lit(',"event_ts":"2024-01-01","duration_ms":"soon"}')))
        .when(F.col("id") % 13 == 6, F.concat(F.lit('{"id":'), number, F.lit(',"event_ts":"never","duration_ms":2.5}')))
        .when(F.col("id") % 17 == 7, F.concat(F.lit('{"device":"'), number, F.lit('"}')))
        .when(F.col("id") % 19 == 8, F.concat(F.lit('{"id":'), number, F.lit(',"event_ts":"2024')))
        .otherwise(envelope.body_text(events))
    )
    return envelope.to_envelope(events, F.col("id") % 4, F.expr("id div 4"), body)


def _parsed(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch(spark, "messages")
    per_step = in_slices(_messages(spark, sf_dir), "offset", f"{folder}/input")
    stream = envelope.parse_envelope(envelope_files(spark, f"{folder}/input", per_step), LongType())
    drain(stream, envelope.store_events(f"{folder}/out"), f"{folder}/checkpoint")
    return f"{folder}/out"


def stream_parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(f"{_parsed(spark, sf_dir)}/events")
    return stored.drop("batch_id", "processed_at")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(f"{_parsed(spark, sf_dir)}/quarantine")
    return stored.drop("batch_id", "processed_at")


def poll_updated_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events exported by three polls, each continuing from the stored cursor."""
    root = scratch(spark, "poll")
    events = _events(spark, sf_dir)
    for high in (datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2024, 3, 1)):
        polling.poll_changes(
            spark,
            lambda low, top: tables.changed_between(events, low, top),
            lambda: _content(spark, sf_dir),
            root,
            high.replace(tzinfo=timezone.utc),
        )
    return polling.read_changes(spark, root)


def poll_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events served page by page, a seventh of them committed after higher ids had been served."""
    root = scratch(spark, "poll-ids")
    events = _events(spark, sf_dir)
    for there in (events.where("id % 7 <> 3 AND id % 5 <> 1"), events.where("id % 7 <> 3"), events):
        while polling.poll_ids(there, lambda: _content(spark, sf_dir), root, PAGE, backlog=True):
            pass
    return serve.read_enriched(spark, root)


def exported_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "export")
    partitioned_export(export_rows(_events(spark, sf_dir), _content(spark, sf_dir)), path)
    return spark.read.parquet(path)


STREAM_QUERIES = {
    "stream_enrich": over_folder(stream_enrich),
    "stream_rings": over_folder(stream_rings),
    "stream_totals": over_folder(stream_totals),
    "stream_heartbeat": over_folder(stream_heartbeat),
    "stream_serving_view": over_folder(stream_serving_view),
    "stream_compacted": over_folder(stream_compacted),
    "stream_window_5m": over_folder(stream_window_5m),
    "stream_window_late": over_folder(stream_window_late),
    "stream_parse_envelope": over_folder(stream_parse_envelope),
    "stream_quarantine": over_folder(stream_quarantine),
    "poll_updated_at": over_folder(poll_updated_at),
    "poll_by_id": over_folder(poll_by_id),
    "partitioned_export": over_folder(exported_by_month),
}
