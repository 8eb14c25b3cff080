"""Which ids have been served, as intervals: what lies between them is open and is read again.

Ids are handed out before they are committed, so a row may appear below the highest id that was ever
read. A cursor would pass over it. The ledger keeps the served ids as intervals merged
by gaps and islands, and a poll reads whatever lies in none of them: below the first, in the gaps, and above the
last. Ids that are never committed leave their gaps open, at the price of one interval each; ``settle`` closes gaps below
an id once nothing can be committed there any more.

The state is written whole under two turns' folders, so a reader opens two small tables whatever the number of
polls. Each row says how many rows its state has: one that was not written to its end is not taken.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallybrook.sources.tables import read_or_empty

STATE = "low bigint, high bigint, batch_id bigint, n_rows bigint"
RANGES = 100
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def islands(intervals: DataFrame, widths: tuple[int, ...] = (1 << 16, 1 << 40)) -> DataFrame:
    """Disjoint (low, high) that cover the same ids; neighbours that touch become one.

    Merged within slices of the id space first, then within wider ones, then over all; each step gets the islands
    of the one before, so dense ids are few rows when they meet in one task.
    """
    for width in (*widths, None):
        slice_of = F.lit(0) if width is None else F.floor(F.col("low") / width)
        in_slice = Window.partitionBy("slice").orderBy("low", "high")
        reached = F.max("high").over(in_slice.rowsBetween(Window.unboundedPreceding, -1))
        # A reach of the greatest id has nothing behind it, and adding one would overflow.
        apart = reached.isNull() | (F.col("low") - 1 > reached)
        rows = intervals.select("low", "high", slice_of.alias("slice")).withColumn("starts", apart.cast("int"))
        rows = rows.withColumn("island", F.sum("starts").over(in_slice))
        intervals = rows.groupBy("slice", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return intervals.select("low", "high")


@dataclass(frozen=True)
class Ledger:
    """The served intervals (disjoint), and the number of the batch that was served last (None: none was)."""

    served: DataFrame
    batch_id: int | None
    turn: int = 0

    def gaps(self) -> DataFrame:
        """(low, high) between served intervals, both ends included."""
        after = F.lead("low").over(Window.orderBy("low"))
        # As many rows as there are open gaps, which settling bounds.
        return self.served.select((F.col("high") + 1).alias("low"), (after - 1).alias("high")).where("high IS NOT NULL")

    def ends(self) -> tuple[int, int] | None:
        row = self.served.agg(F.min("low"), F.max("high")).first()
        return None if row[0] is None else (row[0], row[1])


def load(spark: SparkSession, path: str) -> Ledger:
    turns = [read_or_empty(spark, f"{path}/turn={i}", STATE) for i in (0, 1)]
    both = reduce(DataFrame.unionByName, [t.withColumn("turn", F.lit(i)) for i, t in enumerate(turns)])
    written = both.groupBy("batch_id", "turn").agg(F.count("*").alias("n"), F.first("n_rows").alias("n_rows"))
    last, turn = written.where("n = n_rows").agg(F.max("batch_id"), F.max_by("turn", "batch_id")).first()
    if last is None:
        return Ledger(spark.createDataFrame([], "low bigint, high bigint"), None)
    return Ledger(turns[turn].where(F.col("batch_id") == last).select("low", "high"), last, turn)


def advance(spark: SparkSession, path: str, ledger: Ledger, ids: DataFrame, batch_id: int, settle: int | None = None) -> None:
    """Add a batch's ``ids`` to the ledger; ``settle`` takes everything up to that id as served."""
    intervals = ledger.served.unionByName(ids.where("id IS NOT NULL").select(F.col("id").alias("low"), F.col("id").alias("high")))
    if settle is not None:
        intervals = intervals.unionByName(spark.sql(f"SELECT {LEAST} + 1 AS low, cast({int(settle)} AS bigint) AS high"))
    state = islands(intervals).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    state = state.withColumn("n_rows", F.count("*").over(Window.partitionBy("batch_id")))
    # Never over the state that is read here, also where several batches were served at once.
    turn = batch_id % 2 if ledger.batch_id is None else 1 - ledger.turn
    state.write.mode("overwrite").parquet(f"{path}/turn={turn}")


def open_condition(ledger: Ledger, ranges: int = RANGES) -> str | None:
    """What an unserved id fulfils, as SQL that reaches a scan or a database; None if there are over ``ranges`` gaps."""
    ends = ledger.ends()
    if ends is None:
        return "id IS NOT NULL"
    gaps = ledger.gaps().limit(ranges + 1).collect()
    if len(gaps) > ranges:
        return None
    between = [f"id BETWEEN {g.low} AND {g.high}" for g in sorted(gaps)]
    return " OR ".join([f"id < {ends[0]}", *between, f"id > {ends[1]}"])


def unserved(events: DataFrame, ledger: Ledger, ranges: int = RANGES, width: int = 4096) -> DataFrame:
    """The events whose id lies in no served interval.

    Few gaps become one condition on the scan. Many are joined, cut at multiples of ``width`` so that an id finds its
    gap by an equal slice number; the scan then has their least and greatest id as a condition. The rows are the same.
    """
    condition = open_condition(ledger, ranges)
    if condition is not None:
        return events.where(condition)
    low, high = ledger.ends()
    slices = F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))
    gaps = ledger.gaps().withColumn("slice", F.explode(slices)).toDF("gap_low", "gap_high", "slice")
    inside = events.where(f"id BETWEEN {low} AND {high}")
    found = (F.floor(F.col("id") / width) == F.col("slice")) & F.col("id").between(F.col("gap_low"), F.col("gap_high"))
    late = inside.join(gaps, found, "left_semi")
    return late.unionByName(events.where(f"id < {low} OR id > {high}"))
