"""Joining facts to a keyed table without trusting either the table's size or the key's spread.

* A table that the optimizer sizes below the session's broadcast threshold is broadcast: the facts
  are not shuffled, so skew does not matter.
* A larger one is joined by shuffle. A mergeable sketch of the facts' key column finds the keys that hold more
  than a task's share of the rows; their rows, and those without a key, are spread over as many salts as they
  hold shares, and the few table rows they meet are copied once per salt. Which keys are salted, and
  how far their counts are off, changes only the spread, never the result.
"""

from pyspark.sql import DataFrame, functions as F

# A sketch follows this many keys for each that can be hot; counts are then off by a small part of a share.
FOLLOWED = 8


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where the session does not expose one."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_threshold(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "b": 1}
    for suffix, size in units.items():
        if text.endswith(suffix):
            return int(text.removesuffix(suffix)) * size
    return int(text)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    size = estimated_bytes(df)
    allowed = broadcast_threshold(df) if limit is None else limit
    return size is not None and size <= allowed


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(facts: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Keys that hold more than one of ``tasks`` equal shares of the rows, with the ``_shares`` they hold.

    Fewer than ``tasks`` rows, from a scan of the key column that shuffles one sketch per input task.
    """
    tasks = shuffle_tasks(facts) if tasks is None else tasks
    top = F.expr(f"approx_top_k(`{key}`, {tasks}, {FOLLOWED * tasks})")
    seen = facts.select(key).where(F.col(key).isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("n"))
    shares = F.ceil(F.col("count") * F.lit(tasks) / F.col("n")).cast("int")
    found = seen.select(F.inline("top"), "n").select(F.col("item").alias(key), shares.alias("_shares"))
    return found.where("_shares > 1")


def keyed_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    spread: str = "id",
    broadcast_limit: int | None = None,
    skewed: bool = True,
) -> DataFrame:
    """``facts`` joined to ``table`` on ``key``, which must be unique in ``table``.

    ``how`` is any join that keeps the facts' side: left, inner, left_semi or left_anti. ``spread``
    is a column of the facts with many values, used to choose a row's salt. Facts that hold a
    bounded number of rows per key by construction need no salts (``skewed=False``).
    """
    if fits_broadcast(table, broadcast_limit):
        return facts.join(F.broadcast(table), key, how)
    if not skewed:
        return facts.join(table, key, how)
    return salted_join(facts, table, key, how, spread)


def salted_join(
    facts: DataFrame, table: DataFrame, key: str, how: str, spread: str = "id", tasks: int | None = None
) -> DataFrame:
    tasks = shuffle_tasks(facts) if tasks is None else tasks
    # Fewer than ``tasks`` rows. Both sides must salt alike, so they are found once and not per side.
    hot = hot_keys(facts, key, tasks)
    hot = F.broadcast(facts.sparkSession.createDataFrame(hot.collect(), hot.schema))
    salts = F.when(F.col(key).isNull(), F.lit(tasks)).otherwise(F.coalesce("_shares", F.lit(1)))
    some_salt = F.pmod(F.xxhash64(F.col(spread)), salts.cast("bigint")).cast("int")
    salted_facts = facts.join(hot, key, "left").withColumn("_salt", some_salt).drop("_shares")
    every_salt = F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)
    salted_table = table.join(hot, key, "left").withColumn("_salt", F.explode(every_salt)).drop("_shares")
    return salted_facts.join(salted_table, [key, "_salt"], how).drop("_salt")
