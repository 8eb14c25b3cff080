"""Table scans, incremental scans and the catalogue."""

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_by_id(events: DataFrame, limit: int) -> DataFrame:
    """Order and limit together are a bounded top-k."""
    return events.orderBy("id").limit(limit)


def after_id(events: DataFrame, cursor: int, limit: int = 1000) -> DataFrame:
    """The next ``limit`` events above the cursor, lowest id first. The comparison reaches the scan."""
    return first_by_id(events.where(F.col("id") > cursor), limit)


def changed_between(rows: DataFrame, low, high) -> DataFrame:
    """Rows changed in (low, high]. ``None`` leaves that end open.

    Both ends are fixed before the scan, so reading the same interval again gives the same rows
    however many arrive meanwhile.
    """
    changed = F.col("updated_at")
    if low is not None:
        rows = rows.where(changed > F.lit(low))
    if high is not None:
        rows = rows.where(changed <= F.lit(high))
    return rows


def look_back(now: datetime, minutes: int = 5) -> datetime:
    """Where a reader without a cursor starts."""
    return now - timedelta(minutes=minutes)


def with_text_ids(events: DataFrame) -> DataFrame:
    """Identifiers and payload as text, as an outside store takes them."""
    return events.withColumns(
        {c: F.col(c).cast("string") for c in ("content_id", "user_id", "raw_payload")}
    )


def newest(rows: DataFrame, by: str, n: int, tie: str = "id") -> DataFrame:
    """The ``n`` newest rows overall, newest first; equal times go by ``tie``."""
    return rows.orderBy(F.col(by).desc(), F.col(tie)).limit(n)


def matching_tables(names: DataFrame, patterns: tuple[str, ...]) -> DataFrame:
    """Rows of a ``(table_name)`` relation whose name is like any of the patterns."""
    wanted: Column = F.lit(False)
    for pattern in patterns:
        wanted = wanted | F.col("table_name").like(pattern)
    return names.where(wanted)


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the tables in the session catalogue; temporary views are left out."""
    listed = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return listed.where(~F.col("isTemporary")).select(F.col("tableName").alias("table_name"))
