"""Incremental reading of a table that is no stream: by id, or by time of change.

Each call does one increment: it reads the stored cursor, reads up to a bound that is fixed first,
writes the rows under the increment's number, and stores the cursor last. After a crash the same
increment is done again and replaces what it had written.
"""

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window, functions as F

from tallybrook.operators.enrich import export_rows
from tallybrook.session import scratch
from tallybrook.sinks.tables import write_batch
from tallybrook.sources.tables import first_by_id, read_or_empty
from tallybrook.streaming import ledger as served_ids
from tallybrook.streaming.serve import enriched_path, serve_events, serve_pages

CURSOR = "high timestamp, batch_id bigint, recent array<struct<batch_id: bigint, newest: timestamp>>"
EXPORTED = "id bigint, updated_at timestamp"


def poll_changes(
    spark: SparkSession,
    changed: Callable[[datetime | None, datetime], DataFrame],
    content: Callable[[], DataFrame],
    root: str,
    high: datetime,
    first_low: datetime | None = None,
    overlap: timedelta = timedelta(minutes=10),
    deliver: Callable[[DataFrame, int], None] | None = None,
) -> int:
    """Export the rows changed since the last call, up to ``high``; return the increment's number.

    ``changed(low, high)`` reads the rows changed in (low, high]. Each increment looks back by
    ``overlap`` for rows that were committed late, and leaves out what earlier ones exported.
    ``deliver(rows, number)`` passes the increment on, e.g. to a database, before the cursor moves.

    The cursor is one row in one of two turns' folders. It names the increments that reach into the
    next look-back by their newest change, and only those are opened, whatever their number so far. A longer
    ``overlap`` than before takes effect one call later.
    """
    last = _cursor(spark, root)
    number = 0 if last is None else last.batch_id + 1
    low = first_low if last is None else last.high - overlap
    rows = changed(low, high).dropDuplicates(["id", "updated_at"])
    recent = [] if last is None else [(x.batch_id, x.newest) for x in last.recent if x.newest > low]
    if recent:
        done = spark.read.schema(EXPORTED).parquet(*[f"{root}/changes/batch_id={n}" for n, _ in recent])
        done = done.where(F.col("updated_at") > F.lit(low)).select(F.col("id"), "updated_at")
        rows = rows.join(done, ["id", "updated_at"], "left_anti")
    newest = Observation()
    exported = export_rows(rows, content()).observe(newest, F.max("updated_at").alias("newest"))
    # Sorted by change time, so that the next increment's look-back skips most row groups.
    written = write_batch(exported.sortWithinPartitions("updated_at"), f"{root}/changes", number)
    if deliver is not None:
        deliver(spark.read.parquet(written), number)
    reached = newest.get["newest"]
    if reached is not None:
        recent.append((number, reached))
    # Rows come back in local time without a zone.
    ahead = (high.astimezone().replace(tzinfo=None) if high.tzinfo else high) - overlap
    recent = [(n, newest) for n, newest in recent if newest > ahead]
    state = spark.createDataFrame([(high, number, recent)], CURSOR)
    state.write.mode("overwrite").parquet(f"{root}/cursor/turn={number % 2}")
    return number


def _cursor(spark: SparkSession, root: str) -> Row | None:
    turns = [read_or_empty(spark, f"{root}/cursor/turn={i}", CURSOR).first() for i in (0, 1)]
    return max((x for x in turns if x is not None), key=lambda x: x.batch_id, default=None)


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/changes").drop("batch_id")


def poll_ids(
    events: DataFrame,
    content: Callable[[], DataFrame],
    root: str,
    limit: int = 1000,
    page: Callable[[str, int], DataFrame] | None = None,
    settle: int | None = None,
    backlog: bool = False,
) -> int:
    """Serve the next ``limit`` events that no poll has served yet, lowest ids first; return how many there were.

    What was served is kept as intervals of ids (``ledger``), so an event committed late, below ids already
    served, is in a later page. ``page(condition, limit)`` reads a page where the source itself can take
    condition, order and limit, e.g. a database. Without ids an event can't be told from others and isn't served here.

    With ``backlog``, all that is unserved is taken at once, numbered and written as pages of ``limit`` events each: the table
    is read and the ledger advanced once, whatever the number of pages.
    """
    spark = events.sparkSession
    path = f"{root}/ledger"
    ledger = served_ids.load(spark, path)
    number = 0 if ledger.batch_id is None else ledger.batch_id + 1
    if backlog:
        return _poll_backlog(served_ids.unserved(events, ledger), content, root, limit, ledger, number, settle)
    condition = served_ids.open_condition(ledger) if page is not None else None
    rows = page(condition, limit) if condition else first_by_id(served_ids.unserved(events, ledger), limit)
    serve_events(content, root)(rows, number)
    # What was written decides: the page itself may read differently the next time.
    target = f"{enriched_path(root)}/batch_id={number}"
    written = read_or_empty(spark, target, "id bigint")
    count = written.count()
    if count:
        served_ids.advance(spark, path, ledger, written, number, settle)
    return count


def _poll_backlog(
    events: DataFrame, content: Callable[[], DataFrame], root: str, limit: int, ledger: served_ids.Ledger, number: int, settle: int | None
) -> int:
    spark = events.sparkSession
    path = scratch(spark, "backlog")
    # Counted within the tasks of a sort, and the rows of the tasks before by a table of one row per task.
    events.orderBy("id").withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_task", F.shiftright("_at", 33))
    tasks = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    begins = tasks.withColumn("_begin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    count = tasks.agg(F.sum("_n")).first()[0] or 0
    if count:
        place = F.col("_begin") + F.col("_at").bitwiseAND((1 << 33) - 1)
        pages = rows.join(F.broadcast(begins), "_task").withColumn("batch_id", F.lit(number) + F.floor(place / limit))
        last = number + (count - 1) // limit
        serve_pages(content, root)(pages.drop("_task", "_n", "_begin", "_at"), number, last)
        written = spark.read.parquet(*[f"{enriched_path(root)}/batch_id={n}" for n in range(number, last + 1)])
        served_ids.advance(spark, f"{root}/ledger", ledger, written, last, settle)
    return count
