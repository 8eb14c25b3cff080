"""Batches of a stream merged into few sorted runs, beside the handler that writes them.

A stream writes ``path/batch_id=N``. ``compact`` takes the batches that can no longer be replayed and
merges them level by level: ``fan_out`` runs of one level become one run of the next, sorted by
key, of each key only its version from the latest batch. A row is so rewritten once per level at most (once
per compaction, however many levels it rises), and the live runs of n batches are at most ``fan_out`` times log(n).

The **manifest** names the live runs, one small file per version, written as the last step of a
compaction; a reader follows the newest version and adds the batches behind it. Runs are never changed,
so a reader is not disturbed by a merge, and a merge that dies leaves files that no version names.
``expire`` deletes what neither the newest version nor the one before it names. There must be one
compactor per path at a time; the stream itself needn't stop.
"""

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tallybrook.sinks.folders import children, complete_batches, delete
from tallybrook.sinks.tables import write_batch

FAN_OUT = 16
MANIFEST = "run string, level int, first_batch bigint, last_batch bigint"


@dataclass(frozen=True)
class Run:
    """Sorted rows of the batches from ``first`` to ``last``; level 0 is a batch as the stream wrote it."""

    name: str
    level: int
    first: int
    last: int


def _home(path: str) -> str:
    return f"{path}_levels"


def _folder(path: str, run: Run) -> str:
    return f"{path}/{run.name}" if run.level == 0 else f"{_home(path)}/runs/{run.name}"


def manifest(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, list[Run]]:
    """The newest version (below ``before``) and its live runs in order of their batches; version -1 has none."""
    written = complete_batches(spark, f"{_home(path)}/manifest")
    version = max((v for v in written if before is None or v < before), default=-1)
    if version < 0:
        return -1, []
    rows = spark.read.schema(MANIFEST).parquet(f"{_home(path)}/manifest/batch_id={version}").collect()  # one per live run
    return version, sorted((Run(r.run, r.level, r.first_batch, r.last_batch) for r in rows), key=lambda r: r.first)


def live_runs(spark: SparkSession, path: str) -> list[Run]:
    """The manifest's runs, then every complete batch behind them."""
    _, runs = manifest(spark, path)
    through = max((r.last for r in runs), default=-1)
    tail = [Run(f"batch_id={b}", 0, b, b) for b in complete_batches(spark, path) if b > through]
    return runs + tail


def _read(spark: SparkSession, path: str, runs: list[Run], schema: StructType | str) -> DataFrame:
    """The rows of some runs with the ``batch_id`` each came by."""
    # Of no rows and no tasks; an empty list would have as many tasks as the session has cores.
    nothing = spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)
    parts = nothing.withColumn("batch_id", F.lit(0).cast("bigint"))
    merged = [_folder(path, r) for r in runs if r.level > 0]
    if merged:
        parts = parts.unionByName(spark.read.schema(parts.schema).parquet(*merged))
    batches = [_folder(path, r) for r in runs if r.level == 0]
    if batches:
        fresh = spark.read.schema(parts.schema).option("basePath", path).parquet(*batches)
        parts = parts.unionByName(fresh.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    return parts


def _schema(spark: SparkSession, path: str, runs: list[Run]) -> StructType:
    """As in the newest run's files, without the number of the batch."""
    found = spark.read.parquet(_folder(path, runs[-1])).schema
    return StructType([f for f in found if f.name != "batch_id"])


def read(
    spark: SparkSession,
    path: str,
    key: str | None = None,
    since: int | None = None,
    schema: StructType | str | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """Rows with their ``batch_id``: of each ``key`` its latest version, or all rows without a key.

    With ``since``, only rows of that batch and later ones; runs that end before it aren't opened. With
    ``batches``, one small row per ``batch_id``, only rows of those, and what else is known of their batch.
    The key is the one ``path`` is compacted by: a merged run has each key once, so that a reader who
    finds everything in one needn't compare versions.
    """
    runs = [r for r in live_runs(spark, path) if since is None or r.last >= since]
    if schema is None:
        # A reader that asks for later batches than there are gets no rows, of the same columns.
        known = runs or live_runs(spark, path)
        if not known:
            raise FileNotFoundError(f"no complete batch below {path}")
        schema = _schema(spark, path, known)
    rows = _read(spark, path, runs, schema)
    if since is not None:
        rows = rows.where(F.col("batch_id") >= since)
    if batches is not None:
        # Batches are few and each holds many rows: rows gathered by batch would be as few tasks as there are batches.
        rows = rows.join(F.broadcast(batches), "batch_id")
    one_merged = len(runs) == 1 and runs[0].level > 0
    return rows if key is None or one_merged else newest_versions(rows, key)


def newest_versions(rows: DataFrame, key: str) -> DataFrame:
    """Of each key its row from the latest batch; rows without a key all stay, and aren't gathered."""
    return _newest(rows.where(F.col(key).isNotNull()), key).unionByName(rows.where(F.col(key).isNull()))


def _newest(keyed: DataFrame, key: str) -> DataFrame:
    versions = Window.partitionBy(key).orderBy(F.desc("batch_id"))
    return keyed.withColumn("_version", F.row_number().over(versions)).where("_version = 1").drop("_version")


def _merged(runs: list[Run]) -> Run:
    """The run that takes the place of neighbours."""
    name = f"run-{runs[0].first}-{runs[-1].last}-{uuid4().hex[:8]}"
    return Run(name, max(r.level for r in runs) + 1, runs[0].first, runs[-1].last)


def _merge(spark: SparkSession, path: str, key: str, runs: list[Run], done: Run | None = None) -> Run:
    """One run out of several: a single shuffle by ranges of the key and a single sort serve both the choice and the order."""
    done = done or _merged(runs)
    rows = _read(spark, path, runs, _schema(spark, path, runs))
    _sorted_versions(rows, key).write.mode("overwrite").parquet(_folder(path, done))
    return done


def _sorted_versions(rows: DataFrame, key: str) -> DataFrame:
    # The choice leaves its rows in the order of the key. Behind the union that would be forgotten, and sorted again.
    named = _newest(rows.where(F.col(key).isNotNull()).repartitionByRange(key), key).sortWithinPartitions(key)
    return named.unionByName(rows.where(F.col(key).isNull()))


def compact(spark: SparkSession, path: str, key: str, fan_out: int = FAN_OUT, ended: bool = False) -> list[Run]:
    """Merge as long as ``fan_out`` runs share a level; returns the live runs of the new version.

    The last batch may still be replayed and stays out, unless the stream has ``ended``. A run that would
    itself be merged at once isn't written: its parts go straight into the run that is left.
    """
    version, before = manifest(spark, path)
    runs = live_runs(spark, path)
    if not ended and runs and runs[-1].level == 0 and runs[-1] not in before:
        runs = runs[:-1]
    parts = {r: [r] for r in runs}
    while True:
        # Levels never rise along the batches, so runs of one level are neighbours.
        by_level: dict[int, list[Run]] = {}
        for r in runs:
            by_level.setdefault(r.level, []).append(r)
        full = next((group[:fan_out] for _, group in sorted(by_level.items()) if len(group) >= fan_out), None)
        if full is None:
            break
        at = runs.index(full[0])
        done = _merged(full)
        parts[done] = [p for r in full for p in parts[r]]
        runs[at : at + fan_out] = [done]
    for r in runs:
        if parts[r] != [r]:
            _merge(spark, path, key, parts[r], r)
    # Batches that are not merged yet are found by their folders.
    kept = [r for r in runs if r.level > 0]
    if kept != before:
        rows = [(r.name, r.level, r.first, r.last) for r in kept]
        write_batch(spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{_home(path)}/manifest", version + 1)
    return kept


def expire(spark: SparkSession, path: str) -> int:
    """Delete batches, runs and versions that neither the newest version nor the one before it needs.

    Readers that opened their version before the last two compactions are the only ones disturbed.
    """
    version, now = manifest(spark, path)
    if version < 1:
        return 0
    _, previous = manifest(spark, path, before=version)
    named = {r.name for r in (*now, *previous)}
    # A batch goes when the version before the newest covers it already.
    through = max((r.last for r in previous), default=-1)
    gone = [f"{path}/batch_id={b}" for b in complete_batches(spark, path) if b <= through]
    gone += [f"{_home(path)}/runs/{name}" for name in children(spark, f"{_home(path)}/runs") if name not in named]
    versions = f"{_home(path)}/manifest"
    gone += [f"{versions}/batch_id={v}" for v in complete_batches(spark, versions) if v < version - 1]
    for folder in gone:
        delete(spark, folder)
    return len(gone)
