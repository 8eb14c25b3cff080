"""Event counts per time window."""

from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tallybrook.sinks.tables import write_batch
from tallybrook.sources.tables import read_or_empty
from tallybrook.streaming.runner import Handler


def window_counts(events: DataFrame, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Events and play time per tumbling window and event type.

    On a stream a window comes out once, when the watermark (the newest event time less ``delay``)
    has passed its end; events later than that are dropped and the window's state is freed.
    """
    grouped = (
        events.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", width), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("duration_ms").alias("total_duration_ms"))
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "event_type",
        "n_events",
        "total_duration_ms",
    )


def store_windows(path: str) -> Handler:
    def handler(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return handler


PARTS = (
    "window_start timestamp, window_end timestamp, event_type string, n_events bigint, total_duration_ms bigint, newest timestamp"
)
PROGRESS = "newest timestamp, n_events bigint, n_late bigint, open array<struct<batch_id: bigint, last_end: timestamp>>"
COUNTS = ("window_start", "window_end", "event_type", "n_events", "total_duration_ms")


def keep_windows(root: str, width: str = "5 minutes", delay: timedelta = timedelta(minutes=10)) -> Handler:
    """Keep windows as mergeable parts, so that none is lost when a stream ends and no late event goes uncounted.

    Below ``root``: ``parts`` (a batch's counts per window), ``closed`` (windows whose end the watermark passed with
    that batch, each once), ``late`` (the events that came behind their closed window, as they are), and ``progress``
    (one row per batch). The watermark is the newest event time of earlier batches less ``delay``. The
    progress row names the batches that still have open windows; only their parts are read again, so a
    batch costs what is open and not what has been. Parts that no progress row names any more may be deleted.
    A replayed batch replaces what it wrote.
    """

    def handler(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _progress(spark, root, batch_id - 1)
        floor = None if before is None or before.newest is None else before.newest - delay
        span = F.window("event_ts", width)
        rows = batch.withColumn("window", span).withColumns(
            {"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")
        batch.persist()
        try:
            is_late = F.lit(False) if floor is None else F.col("window_end") <= F.lit(floor)
            late = write_batch(rows.where(is_late), f"{root}/late", batch_id)
            parts = write_batch(_counted(rows.where(~is_late)), f"{root}/parts", batch_id)
        finally:
            batch.unpersist()
        made = spark.read.schema(PARTS).parquet(parts).agg(
            F.max("newest").alias("newest"), F.max("window_end").alias("last_end"), F.sum("n_events").alias("n")).first()
        n_late = spark.read.schema(rows.schema).parquet(late).count()
        times = [t for t in (made.newest, None if before is None else before.newest) if t is not None]
        newest = max(times, default=None)
        still = [] if before is None else [(x.batch_id, x.last_end) for x in before.open]
        if made.last_end is not None:
            still.append((batch_id, made.last_end))
        if newest is not None:
            closing = _merged(spark, root, [n for n, _ in still]).where(F.col("window_end") <= F.lit(newest - delay))
            if floor is not None:
                closing = closing.where(F.col("window_end") > F.lit(floor))
            write_batch(closing, f"{root}/closed", batch_id)
            still = [(n, end) for n, end in still if end > newest - delay]
        row = (newest, made.n or 0, n_late, still)
        write_batch(spark.createDataFrame([row], PROGRESS), f"{root}/progress", batch_id)

    return handler


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_start", "window_end", "event_type").agg(
        F.count("*").alias("n_events"), F.sum("duration_ms").alias("total_duration_ms"), F.max("event_ts").alias("newest"))


def _merged(spark: SparkSession, root: str, batches: list[int]) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], PARTS).select(*COUNTS)
    parts = spark.read.schema(PARTS).parquet(*[f"{root}/parts/batch_id={n}" for n in batches])
    return parts.groupBy("window_start", "window_end", "event_type").agg(
        F.sum("n_events").alias("n_events"), F.sum("total_duration_ms").alias("total_duration_ms"))


def _progress(spark: SparkSession, root: str, batch_id: int) -> Row | None:
    return read_or_empty(spark, f"{root}/progress/batch_id={batch_id}", PROGRESS).first()


def read_windows(spark: SparkSession, root: str, delay: timedelta = timedelta(minutes=10)) -> DataFrame:
    """All windows so far; ``closed`` tells those that can't change any more."""
    batches = spark.read.schema(f"{PROGRESS}, batch_id bigint").parquet(f"{root}/progress")
    last = batches.orderBy(F.desc("batch_id")).first()
    done = read_or_empty(spark, f"{root}/closed", f"{PARTS}, batch_id bigint").where(F.col("batch_id") <= last.batch_id)
    still = _merged(spark, root, [x.batch_id for x in last.open])
    if last.newest is not None:
        still = still.where(F.col("window_end") > F.lit(last.newest - delay))
    return done.select(*COUNTS, F.lit(True).alias("closed")).unionByName(still.withColumn("closed", F.lit(False)))


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """The events that came too late for their window, with it."""
    return spark.read.parquet(f"{root}/late").drop("batch_id")
