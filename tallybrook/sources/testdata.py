"""The two source tables as views over the provided test tables.

``part`` plays the catalogue and ``events`` the telemetry; items and events get missing types,
users, devices and content on purpose.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(PART).parquet(f"{sf_dir}/part.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_view(raw_parts(spark, sf_dir))


def engagement_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_view(raw_events(spark, sf_dir))


def content_view(parts: DataFrame) -> DataFrame:
    return parts.selectExpr(
        "p_partkey AS id",
        "concat('part-', cast(p_partkey AS string)) AS slug",
        "p_name AS title",
        "CASE p_partkey % 3 WHEN 0 THEN 'podcast' WHEN 1 THEN 'newsletter' ELSE 'video' END AS content_type",
        "CASE WHEN p_partkey % 3 <> 1 THEN p_size * 60 END AS length_seconds",
        "cast(date_add(DATE '2023-01-01', cast(p_partkey % 365 AS int)) AS timestamp_ntz) AS publish_ts",
    )


def events_view(events: DataFrame) -> DataFrame:
    """The same for a table and for a stream of raw events."""
    return events.selectExpr(
        "event_id AS id",
        "CASE WHEN event_id % 50 <> 0 THEN cast(get_json_object(props, '$.k') AS bigint) END AS content_id",
        "CASE WHEN event_id % 20 <> 0 THEN user_id END AS user_id",
        """CASE event_type WHEN 'view' THEN 'play' WHEN 'signup' THEN 'pause'
             WHEN 'purchase' THEN 'finish' WHEN 'click' THEN 'click' END AS event_type""",
        "ts AS event_ts",
        "CASE WHEN event_type = 'click' THEN NULL ELSE cast(round(value * 1000) AS int) END AS duration_ms",
        """CASE event_id % 6 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web-chrome'
             WHEN 3 THEN 'web-safari' WHEN 4 THEN 'web-edge' END AS device""",
        "props AS raw_payload",
        "ts + make_dt_interval(0, 0, cast(event_id % 7 AS int)) AS updated_at",
    )


def as_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants (watermarks need them)."""
    return _recast(df, "timestamp_ntz", "timestamp")


def as_wall_clock(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, for comparison with engines that have only those."""
    return _recast(df, "timestamp", "timestamp_ntz")


def _recast(df: DataFrame, have: str, want: str) -> DataFrame:
    return df.select(*[F.col(n).cast(want).alias(n) if t == have else F.col(n) for n, t in df.dtypes])
