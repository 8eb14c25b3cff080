"""Rings kept by a stream: the newest N events per key, with the lifetime of the whole list.

A batch appends only its own newest N per key (a segment). A reader takes the newest N over the
segments; ``fold`` merges the segments so far into one base so that readers stay cheap. Neither
touches what other batches wrote, so a replay or a lost executor cannot damage the ring.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallybrook.operators.latest import latest_per_key
from tallybrook.sinks.folders import children, complete_batches, delete
from tallybrook.sinks.tables import write_batch, write_batches
from tallybrook.sources.tables import read_or_empty


def push(events: DataFrame, path: str, key: str, n: int, batch_id: int, written_at: Column | None = None) -> None:
    """Add a batch to the ring; events without a content are in no content's ring."""
    if key == "content_id":
        events = events.where(F.col(key).isNotNull())
    written_at = F.current_timestamp() if written_at is None else written_at
    segment = latest_per_key(events, key, n).drop("rank").withColumn("written_at", written_at)
    write_batch(segment, f"{path}/segments", batch_id)


def push_pages(events: DataFrame, path: str, key: str, n: int, first: int, last: int) -> None:
    """The same for the batches from ``first`` to ``last`` at once, which ``events`` name in ``batch_id``."""
    if key == "content_id":
        events = events.where(F.col(key).isNotNull())
    segments = latest_per_key(events, (key, "batch_id"), n).drop("rank").withColumn("written_at", F.current_timestamp())
    write_batches(segments, f"{path}/segments", first, last)


def fold(spark: SparkSession, path: str, key: str, n: int, ttl_seconds: int, through: int) -> None:
    """Merge everything up to batch ``through`` into a new base. The base counts from the moment
    its row in ``folded`` is there; until then readers use the previous one. A replay of a batch
    that was folded already leaves the base as it is. What a base has replaced may be deleted."""
    last = _last_fold(spark, path)
    if last is not None and last >= through:
        return
    rows = _rows(spark, path).where(F.col("batch_id") <= through)
    alive = _unlapsed(rows, key, ttl_seconds).withColumns(
        {"run_start": F.col("_since"), "run_end": F.col("pushed_at")}).drop("_since", "pushed_at")
    newest_alive = latest_per_key(alive, key, n, slices=1).drop("rank")
    # Readers without a lifetime see lapsed rows too, as long as they are among the newest.
    newest = latest_per_key(rows, key, n, slices=1).drop("rank")
    same = newest["id"].eqNullSafe(newest_alive["id"]) & newest[key].eqNullSafe(newest_alive[key])
    kept = newest_alive.unionByName(newest.join(newest_alive, same, "left_anti"))
    kept.write.mode("overwrite").parquet(f"{path}/bases/{through}")
    write_batch(spark.range(1).select(F.lit(through).cast("bigint").alias("through")), f"{path}/folded", through)


def read(
    spark: SparkSession, path: str, key: str, n: int, ttl_seconds: int | None = None, now: Column | None = None
) -> DataFrame:
    """The rings, newest first by ``rank``. With a lifetime, as a store would show them at ``now``:
    each push renews a list, and one that was not renewed in time is gone; ``pushed_at`` is the
    time of the list's last push."""
    rows = _rows(spark, path)
    if ttl_seconds is not None:
        rows = _unlapsed(rows, key, ttl_seconds, F.current_timestamp() if now is None else now).drop("_since")
    # A key has at most n rows per segment, so ranking it at once is safe.
    return latest_per_key(rows.drop("batch_id", "written_at", "run_start", "run_end"), key, n, slices=1)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """A row's run is the time from the first to the last push by which its list was kept alive, as far as known."""
    segments = spark.read.parquet(f"{path}/segments").withColumns({"run_start": F.col("written_at"), "run_end": F.col("written_at")})
    last = _last_fold(spark, path)
    if last is None:
        return segments
    base = spark.read.parquet(f"{path}/bases/{last}")
    return base.unionByName(segments.where(F.col("batch_id") > last))


def _last_fold(spark: SparkSession, path: str) -> int | None:
    """The batch up to which the current base goes (the table has one row per fold)."""
    return read_or_empty(spark, f"{path}/folded", "through bigint").agg(F.max("through")).first()[0]


def _unlapsed(rows: DataFrame, key: str, ttl_seconds: int, now: Column | None = None) -> DataFrame:
    """Drop what was pushed before a list last expired, and lists that have expired by ``now``.

    Decided on the runs per key, which are as many as there are segments to read.
    """
    earlier = Window.partitionBy(key).orderBy("run_start", "run_end").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy(key, "run_start", "run_end").agg(F.count(F.lit(1)).alias("_n"))
    lifetime = F.make_dt_interval(secs=F.lit(ttl_seconds))
    before = F.max("run_end").over(earlier)
    starts = before.isNull() | (F.col("run_start") > before + lifetime)
    lists = (
        runs.withColumn("_starts", F.when(starts, F.col("run_start")))
        .groupBy(key)
        .agg(F.max("_starts").alias("_since"), F.max("run_end").alias("pushed_at"))
        .withColumnRenamed(key, "_key")
    )
    if now is not None:
        lists = lists.where(F.col("pushed_at") + lifetime > now)
    same = rows[key].eqNullSafe(lists["_key"]) & (rows["written_at"] >= lists["_since"])
    return rows.join(lists, same, "inner").drop("_key")


def expire(spark: SparkSession, path: str) -> int:
    """Delete the segments, bases and marks that neither the last fold nor the one before it needs."""
    folds = complete_batches(spark, f"{path}/folded")
    if len(folds) < 2:
        return 0
    before = folds[-2]
    gone = [f"{path}/segments/batch_id={b}" for b in complete_batches(spark, f"{path}/segments") if b <= before]
    gone += [f"{path}/bases/{name}" for name in children(spark, f"{path}/bases") if int(name) < before]
    gone += [f"{path}/folded/batch_id={b}" for b in folds if b < before]
    for folder in gone:
        delete(spark, folder)
    return len(gone)
