"""Changing tables: insert-if-absent, serial numbers, upsert, change feeds and cascading deletes.

A table here may be the 100 TB one, the change set is usually small: wherever the change set fits a
broadcast the table is scanned but not shuffled.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybrook.operators.keyed_join import fits_broadcast, keyed_join
from tallybrook.operators.latest import newest_per_key
from tallybrook.session import scratch

# Insert, update, delete.
OPERATIONS = ("i", "u", "d")

# Serial numbers are dealt per bucket of the key's MD5: 16 ** 3 buckets of about equal size.
BUCKET_DIGITS = 3


def with_insert_defaults(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Fill in what an insert may leave out: a random identifier and the time of change."""
    now = F.current_timestamp() if now is None else now
    return rows.withColumns(
        {
            "id": F.coalesce(F.col("id").cast("string"), F.uuid()),
            "updated_at": F.coalesce(F.col("updated_at"), now),
        }
    )


def next_serial(table: DataFrame, name: str = "id") -> Column:
    """The table's highest number, as a scalar to start from."""
    return F.coalesce(table.select(F.max(name)).scalar(), F.lit(0))


def with_serial(rows: DataFrame, key: str, start: Column, name: str = "id") -> DataFrame:
    """Number new rows without gaps, from one above ``start``.

    ``key`` is unique text. Rows are dealt into buckets by its digest; a table of bucket sizes
    (4,096 rows at most) gives each bucket its first number, and inside a bucket rows are numbered
    in key order. The order of the numbers is therefore the order of (digest prefix, key).
    """
    dealt = rows.withColumn("_bucket", F.left(F.md5(F.col(key).cast("binary")), F.lit(BUCKET_DIGITS)))
    sizes = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        dealt.withColumn("_nth", nth)
        .join(F.broadcast(offsets), "_bucket", "inner")
        .withColumn(name, start + F.col("_before") + F.col("_nth"))
        .drop("_bucket", "_before", "_nth")
    )


def absent_from(rows: DataFrame, table: DataFrame, key: str, broadcast_limit: int | None = None) -> DataFrame:
    """The rows whose key the table lacks; ``rows`` holds each key once.

    Few rows are sent to the table, which is scanned for its key column only and not shuffled.
    """
    held = table.select(key)
    if fits_broadcast(rows, broadcast_limit):
        held = held.join(F.broadcast(rows.select(key)), key, "left_semi")
    return rows.join(held, key, "left_anti")


def insert_if_absent(
    table: DataFrame, incoming: DataFrame, key: str, order: str, broadcast_limit: int | None = None
) -> DataFrame:
    """The incoming rows whose key the table lacks, the first by ``order`` of each key.

    Appending the result to the table is the insert; the result is what was inserted.
    """
    rest = [c for c in incoming.columns if c != key]
    first = incoming.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    fresh = absent_from(first.select(key, "_row.*"), table, key, broadcast_limit)
    return fresh.select(*incoming.columns)


def upsert(
    table: DataFrame,
    incoming: DataFrame,
    key: str = "id",
    order: tuple[str, ...] = ("updated_at",),
    touch: Column | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """The table with each key's newest version. An incoming row replaces a stored one unless the
    stored one is newer by the first column of ``order``; ``touch`` stamps replaced rows.

    ``key`` is unique in the table; the incoming rows may repeat it any number of times.
    """
    columns = table.columns
    changes = _written_once(newest_per_key(incoming.select(*columns), key, order))
    return _apply(table, changes, columns, key, order[0], touch, None, broadcast_limit)


def apply_change_feed(
    table: DataFrame,
    feed: DataFrame,
    key: str = "id",
    sequence: str = "seq",
    op: str = "op",
    broadcast_limit: int | None = None,
) -> DataFrame:
    """The table after a feed of changes: each key's last change counts, op ``d`` deletes.

    The feed has the table's columns, an operation and a sequence that orders the changes of a key.
    Rows with another operation than ``OPERATIONS`` change nothing; ``unknown_operations`` has them.
    """
    columns = table.columns
    known = feed.where(F.col(op).isin(*OPERATIONS)).select(*columns, op, sequence)
    changes = _written_once(newest_per_key(known, key, (sequence,)).drop(sequence))
    return _apply(table, changes, columns, key, None, None, op, broadcast_limit)


def unknown_operations(feed: DataFrame, op: str = "op") -> DataFrame:
    return feed.where(~F.coalesce(F.col(op).isin(*OPERATIONS), F.lit(False)))


def _written_once(changes: DataFrame) -> DataFrame:
    """The change set, read by several joins, in the shared folder; its size is then known from its files."""
    path = scratch(changes.sparkSession, "changes")
    changes.write.parquet(path)
    return changes.sparkSession.read.schema(changes.schema).parquet(path)


def _apply(table, changes, columns, key, version, touch, op, broadcast_limit) -> DataFrame:
    new = changes.select(F.col(key), F.struct(*columns).alias("_new"), *([F.col(op).alias("_op")] if op else []))
    replaces = F.col("_new").isNotNull()
    if version is not None:
        stored = F.col(version)
        replaces = replaces & (stored.isNull() | (F.col(f"_new.{version}") >= stored))
    deleted = (F.col("_op") == "d") if op else F.lit(False)

    def chosen(rows: DataFrame) -> DataFrame:
        picked = {c: F.when(replaces, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns if c != key}
        if touch is not None:
            stored = F.col("_stored")
            picked["updated_at"] = F.when(replaces & stored, touch).otherwise(picked["updated_at"])
        rows = rows.where(~F.coalesce(deleted, F.lit(False)))
        return rows.select(F.col(key), *[e.alias(c) for c, e in picked.items()]).select(*columns)

    marked = table.withColumn("_stored", F.lit(True))
    if not fits_broadcast(changes, broadcast_limit):
        # Both sides hold a key once, so one shuffle by key is even.
        return chosen(marked.join(new, key, "full").withColumn("_stored", F.col("_stored").isNotNull()))
    kept = chosen(marked.join(F.broadcast(new), key, "left"))
    added = absent_from(new, table, key, broadcast_limit)
    if op:
        added = added.where(~F.coalesce(deleted, F.lit(False)))
    return kept.unionByName(added.select("_new.*").select(*columns))


def touch_updated(rows: DataFrame, changed: Column, now: Column | None = None) -> DataFrame:
    """Stamp the change time of the rows an update touched."""
    now = F.current_timestamp() if now is None else now
    return rows.withColumn("updated_at", F.when(changed, now).otherwise(F.col("updated_at")))


def cascade_delete(events: DataFrame, deleted: DataFrame, **join) -> DataFrame:
    """The events that remain once the contents in ``deleted`` (a column ``id``) are gone."""
    gone = deleted.select(F.col("id").alias("content_id")).distinct()
    return keyed_join(events, gone, "content_id", "left_anti", **join)
