"""Parquet tables: typed overwrite, appends that can be replayed, and the partitioned export."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallybrook.schemas import conform
from tallybrook.sinks.folders import children, delete, mark_complete


def overwrite_table(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    (df if schema is None else conform(df, schema)).write.mode("overwrite").parquet(path)


def overwrite_counted(df: DataFrame, path: str) -> int:
    """Overwrite, and the number of rows as they were written; the table isn't read to be counted."""
    written = Observation()
    overwrite_table(df.observe(written, F.count(F.lit(1)).alias("n")), path)
    return written.get["n"]


def into_folder(root: str, counts: dict[str, int] | None = None):
    """A ``save(table, name)`` that overwrites one Parquet table per name below ``root``; ``counts`` gets
    the rows of each."""

    def save(df: DataFrame, name: str) -> None:
        n = overwrite_counted(df, f"{root}/{name}")
        if counts is not None:
            counts[name] = n

    return save


def write_batch(df: DataFrame, path: str, batch_id: int) -> str:
    """Write one batch into its own partition. Replaying the batch replaces what it wrote."""
    target = f"{path}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(target)
    return target


def write_batches(df: DataFrame, path: str, first: int, last: int) -> None:
    """Write the batches from ``first`` to ``last``, named by the column ``batch_id``, each into its own partition as
    ``write_batch`` does. What an attempt that died left from ``first`` on is deleted before."""
    spark = df.sparkSession
    for name in children(spark, path):
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) >= first:
            delete(spark, f"{path}/{name}")
    df.hint("rebalance", "batch_id").write.mode("append").partitionBy("batch_id").parquet(path)
    for batch_id in range(first, last + 1):
        mark_complete(spark, f"{path}/batch_id={batch_id}")


def partitioned_export(df: DataFrame, path: str, ts: str = "event_ts", then: tuple[str, ...] = ("content_id",)) -> None:
    """Partitioned by month and sorted by time in each file.

    The rebalance hint lets the adaptive planner merge small months and split a month that holds
    much of the data over several tasks, each with a file of its own.
    """
    monthly = df.withColumn("event_month", F.date_format(ts, "yyyyMM").cast("int"))
    (
        monthly.hint("rebalance", "event_month")
        .sortWithinPartitions("event_month", ts, *then)
        .write.mode("overwrite")
        .partitionBy("event_month")
        .parquet(path)
    )


def create_table(
    spark: SparkSession, name: str, schema: StructType, replace: bool = True, defaults: dict[str, str] | None = None
) -> None:
    """An empty typed table in the session catalogue. ``defaults`` gives columns their value, as SQL, where an
    insert leaves them out."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    defaults = defaults or {}
    columns = [
        f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema
    ]
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet")


def insert_into(df: DataFrame, name: str) -> None:
    """Append to a catalogue table, columns matched by name and cast to the table's types. Columns that ``df``
    lacks get their default, or null."""
    spark = df.sparkSession
    given = StructType([f for f in spark.table(name).schema if f.name in df.columns])
    unknown = [c for c in df.columns if c not in given.names]
    if unknown:
        raise ValueError(f"{name} has no columns {unknown}")
    spark.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {{rows}}", rows=conform(df, given))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of a frame, without running it whole."""
    return df.limit(n)
