"""Micro-batch enrichment into the tables behind the serving keys.

Below one root folder: ``enriched`` (every event), ``progress`` (one row per batch), and one ring
table per key. Totals, cursors and heartbeats are read from ``progress``, never counted up in place.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallybrook.operators.enrich import enrich_events
from tallybrook.plans import serving
from tallybrook.plans.serving import CONTENT_RING, HOUR, TYPE_RING
from tallybrook.sinks.tables import write_batch, write_batches
from tallybrook.streaming import levels, rings
from tallybrook.streaming.runner import Handler, together

RINGS = {"content_id": CONTENT_RING, "event_type": TYPE_RING}
FOLD_EVERY = 100
NEVER = (1 << 63) - 1  # behind every batch
PROGRESS = "event_count bigint, latest_id bigint, updated_at timestamp"


def enriched_path(root: str) -> str:
    return f"{root}/enriched"


def ring_path(root: str, key: str) -> str:
    return f"{root}/ring_{key}"


def serve_events(
    content: Callable[[], DataFrame],
    root: str,
    ring_sizes: dict[str, int] = RINGS,
    fold_every: int = FOLD_EVERY,
) -> Handler:
    """Enrich each batch and write its events, progress and ring entries.

    ``content`` is called per batch, so items published meanwhile are seen. The batch itself is
    read once; what follows comes from what was written, and counts from the write itself.
    """

    def handler(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        seen = Observation()
        enriched = enrich_events(batch, content()).observe(
            seen, F.count(F.lit(1)).alias("event_count"), F.max("id").alias("latest_id"))
        target = write_batch(enriched, enriched_path(root), batch_id)
        saved = spark.read.parquet(target)
        beat = spark.createDataFrame([(seen.get["event_count"], seen.get["latest_id"])], "event_count bigint, latest_id bigint")

        def push(key: str, n: int) -> None:
            path = ring_path(root, key)
            rings.push(saved, path, key, n, batch_id)
            if batch_id % fold_every == fold_every - 1:
                rings.fold(spark, path, key, n, HOUR, batch_id)

        beat = beat.withColumn("updated_at", F.current_timestamp())
        writes = [partial(write_batch, beat, f"{root}/progress", batch_id)]
        together(spark, writes + [partial(push, key, n) for key, n in ring_sizes.items()])

    return handler


def serve_pages(
    content: Callable[[], DataFrame],
    root: str,
    ring_sizes: dict[str, int] = RINGS,
    fold_every: int = FOLD_EVERY,
) -> Callable[[DataFrame, int, int], None]:
    """Enrich the batches from ``first`` to ``last``, named by the column ``batch_id``, and write of each what ``serve_events``
    writes, in a number of jobs that does not depend on how many they are. Rings are folded up to the last batch that asks for it."""

    def handler(pages: DataFrame, first: int, last: int) -> None:
        spark = pages.sparkSession
        write_batches(enrich_events(pages, content(), keep=("batch_id",)), enriched_path(root), first, last)
        written = [f"{enriched_path(root)}/batch_id={n}" for n in range(first, last + 1)]
        saved = spark.read.option("basePath", enriched_path(root)).parquet(*written)
        beats = saved.groupBy("batch_id").agg(F.count(F.lit(1)).alias("event_count"), F.max("id").alias("latest_id"))
        fold_through = (last + 1) // fold_every * fold_every - 1

        def push(key: str, n: int) -> None:
            path = ring_path(root, key)
            rings.push_pages(saved, path, key, n, first, last)
            if fold_through >= first:
                rings.fold(spark, path, key, n, HOUR, fold_through)

        beats = beats.withColumn("updated_at", F.current_timestamp())
        writes = [partial(write_batches, beats, f"{root}/progress", first, last)]
        together(spark, writes + [partial(push, key, n) for key, n in ring_sizes.items()])

    return handler


def read_enriched(spark: SparkSession, root: str) -> DataFrame:
    """Every event served; where batches have been merged, of one that came twice the last version."""
    return levels.read(spark, enriched_path(root)).drop("batch_id")


def _batches(spark: SparkSession, root: str) -> DataFrame:
    return levels.read(spark, f"{root}/progress", schema=PROGRESS)


def progress(spark: SparkSession, root: str) -> DataFrame:
    """One row: events so far, highest id, and the last batch's size and time."""
    return _batches(spark, root).agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_events"),
        F.coalesce(F.max("latest_id"), F.lit(0)).alias("latest_id"),
        F.max_by("event_count", "batch_id").alias("event_count"),
        F.max("updated_at").alias("updated_at"),
    )


def view(spark: SparkSession, root: str, now: Column | None = None) -> DataFrame:
    """The stream's serving keys as a reader sees them at ``now``: events of the last hour, the
    rings that were renewed in time, and the progress keys.

    Batches, and runs of merged ones, that have expired are not opened.
    """
    now = F.current_timestamp() if now is None else now
    batches = _batches(spark, root).select("batch_id", "updated_at")
    recent = batches.where(F.col("updated_at") > now - F.make_dt_interval(secs=F.lit(HOUR)))
    first = recent.agg(F.min("batch_id")).first()[0]
    # An event that came in several batches has one key; its last version is shown.
    events = levels.read(spark, enriched_path(root), "id", since=NEVER if first is None else first, batches=recent)
    shown = serving.event_entries(events, F.col("updated_at"))
    shown = shown.unionByName(serving.progress_entries(progress(spark, root)))
    lists = {"content_id": serving.content_ring_entries, "event_type": serving.type_ring_entries}
    for key, as_entries in lists.items():
        ring = rings.read(spark, ring_path(root, key), key, RINGS[key], HOUR, now)
        shown = shown.unionByName(as_entries(ring, F.col("pushed_at")))
    return serving.alive(serving.with_expiry(shown), now)


def tidy(spark: SparkSession, root: str, fan_out: int = levels.FAN_OUT, ended: bool = False) -> None:
    """Merge the batches of events and progress, and delete what merged runs and folded rings have replaced.

    Run it beside the stream, one at a time; its readers and the stream go on meanwhile.
    """

    def merge(path: str, key: str) -> None:
        levels.compact(spark, path, key, fan_out, ended)
        levels.expire(spark, path)

    tables = [partial(merge, enriched_path(root), "id"), partial(merge, f"{root}/progress", "batch_id")]
    together(spark, tables + [partial(rings.expire, spark, ring_path(root, key)) for key in RINGS])
