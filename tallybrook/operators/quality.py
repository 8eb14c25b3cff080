"""Checks the tables must pass: allowed values, required values, unique keys, known contents."""

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.operators.keyed_join import keyed_join
from tallybrook.schemas import CONTENT_REQUIRED, CONTENT_TYPES, EVENT_REQUIRED, EVENT_TYPES

DOMAINS = {
    "content": {"content_type": CONTENT_TYPES},
    "engagement_events": {"event_type": EVENT_TYPES},
}
REQUIRED = {"content": CONTENT_REQUIRED, "engagement_events": EVENT_REQUIRED}


def outside_domain(column: str, allowed: tuple[str, ...]) -> Column:
    """True for a value not allowed; a missing value is allowed."""
    return F.coalesce(~F.col(column).isin(*allowed), F.lit(False))


def _violations(rows: DataFrame, table: str, faults: dict[str, Column], value) -> DataFrame:
    """One row per violated column, found in a single pass over the rows."""
    found = F.array_compact(
        F.array(
            *[
                F.when(broken, F.struct(F.lit(c).alias("column_name"), value(c).alias("bad_value")))
                for c, broken in faults.items()
            ]
        )
    )
    return rows.select(
        F.lit(table).alias("table_name"),
        F.col("id").cast("string").alias("row_id"),
        F.explode(found).alias("_v"),
    ).select("table_name", "row_id", "_v.*")


def domain_violations(rows: DataFrame, table: str) -> DataFrame:
    faults = {c: outside_domain(c, allowed) for c, allowed in DOMAINS[table].items()}
    return _violations(rows, table, faults, lambda c: F.col(c).cast("string"))


def null_violations(rows: DataFrame, table: str) -> DataFrame:
    present = [c for c in REQUIRED[table] if c in rows.columns]
    faults = {c: F.col(c).isNull() for c in present}
    return _violations(rows, table, faults, lambda c: F.lit(None).cast("string")).drop("bad_value")


def split_valid(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy every rule of the table, the others with their first broken rule)."""
    rules = {f"{c} not allowed": outside_domain(c, v) for c, v in DOMAINS[table].items()}
    rules |= {f"{c} missing": F.col(c).isNull() for c in REQUIRED[table] if c in rows.columns}
    reason = F.coalesce(*[F.when(broken, F.lit(text)) for text, broken in rules.items()])
    judged = rows.withColumn("reason", reason)
    valid = judged.where(F.col("reason").isNull()).drop("reason")
    return valid, judged.where(F.col("reason").isNotNull())


def duplicate_keys(rows: DataFrame, table: str, *keys: str) -> DataFrame:
    """Values that occur more than once in a column that must be unique."""
    reports = [
        rows.where(F.col(k).isNotNull())
        .groupBy(F.col(k).cast("string").alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
        .select(F.lit(table).alias("table_name"), F.lit(k).alias("key_column"), "key_value", "n_rows")
        for k in keys
    ]
    report = reports[0]
    for more in reports[1:]:
        report = report.unionByName(more)
    return report


def orphans(events: DataFrame, content: DataFrame, **join) -> DataFrame:
    """Events that name a content the catalogue does not hold."""
    named = events.where(F.col("content_id").isNotNull())
    known = content.select(F.col("id").alias("content_id"))
    return keyed_join(named, known, "content_id", "left_anti", **join)
