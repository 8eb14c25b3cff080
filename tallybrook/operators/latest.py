"""The newest N rows per key, when one key may hold a third of all rows.

Spark itself limits a ``row_number() <= n`` to ``n`` rows per key inside each input task, before the
shuffle (up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000; raise that with a larger
``n``). What is left of a popular key still grows with the number of tasks, so larger inputs get one
of two treatments, both exact:

* few keys: a second limit among slices of the tasks, before the last one (``latest_per_key``);
* many keys, where a second shuffle of nearly all rows would be the cost: rows of the commonest keys
  that cannot be among the newest are dropped first (``latest_per_many_keys``).
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybrook.operators.keyed_join import estimated_bytes, hot_keys

SLICES = 64
# An input that one task could sort on its own needs no care about popular keys.
ONE_TASK_BYTES = 64 << 20


def newest_first(columns: tuple[str, ...]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def one_task_suffices(rows: DataFrame) -> bool:
    size = estimated_bytes(rows)
    return size is not None and size <= ONE_TASK_BYTES


def latest_per_key(
    rows: DataFrame,
    keys: str | tuple[str, ...],
    n: int,
    order: tuple[str, ...] = ("id",),
    slices: int | None = None,
) -> DataFrame:
    """At most ``n`` rows per key, newest first by ``order``, with their 1-based ``rank``.

    Ranked inside each input task, then among a slice of the tasks, then among the slices, each
    step passing on ``n`` rows per key. Small inputs skip the middle step.
    """
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    if slices is None:
        slices = 1 if one_task_suffices(rows) else SLICES
    if slices > 1:
        rows = rows.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
        rows = _top(rows, (*keys, "_slice"), n, order, "_rank").drop("_rank", "_slice")
    return _top(rows, keys, n, order, "rank")


def latest_per_many_keys(
    rows: DataFrame, key: str, n: int, order: str = "id", trim: bool | None = None
) -> DataFrame:
    """The same for a key of very many values, never null, and an ``order`` without ties.

    The rows themselves are shuffled once, and come out partitioned by the key.
    """
    if trim is None:
        trim = not one_task_suffices(rows)
    if trim:
        rows = without_outdated(rows, key, n, order)
    return latest_per_key(rows, key, n, (order,), slices=1)


def without_outdated(rows: DataFrame, key: str, n: int, order: str) -> DataFrame:
    """Rows of the commonest keys only from their ``n``-th newest on; all rows of other keys.

    The cut-offs, one row for each of a bounded number of keys, are found from two columns.
    """
    narrow = rows.select(key, order).join(F.broadcast(hot_keys(rows, key)), key, "left_semi")
    last_kept = latest_per_key(narrow, key, n, (order,), slices=SLICES).where(F.col("rank") == n)
    cutoffs = last_kept.select(key, F.col(order).alias("_oldest"))
    trimmed = rows.join(F.broadcast(cutoffs), key, "left")
    return trimmed.where(F.col("_oldest").isNull() | (F.col(order) >= F.col("_oldest"))).drop("_oldest")


def _top(rows: DataFrame, keys: tuple[str, ...], n: int, order: tuple[str, ...], name: str) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first(order)))
    return rows.withColumn(name, position).where(F.col(name) <= n)


def newest_per_key(rows: DataFrame, keys: str | tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key: the newest by ``order``. Each input task passes on one row per key, so even
    a key with a third of the rows reaches its last task as one row per input task."""
    return latest_per_key(rows, keys, 1, order, slices=1).drop("rank")
