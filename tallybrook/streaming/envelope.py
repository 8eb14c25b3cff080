"""From message envelopes to typed events."""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType, StructType

from tallybrook.functions.text import iso_text
from tallybrook.schemas import MESSAGE_REQUIRED, payload_schema
from tallybrook.sinks.tables import write_batch
from tallybrook.sources import jdbc
from tallybrook.sources.jdbc import Database
from tallybrook.streaming.runner import Handler

ENVELOPE = ("kafka_key", "kafka_timestamp", "partition", "offset")


def body_fields(messages: DataFrame, schema: StructType) -> tuple[DataFrame, Column]:
    """``messages`` with each field of their VARIANT ``body`` in its declared type, and what is wrong with the body, null if nothing.

    A field is read as text and cast, so a number with a fraction or beyond its type's range is a fault and not
    another number. A field that is absent or JSON null is null. Text and value are columns of their own, computed once.
    """
    kept = messages.columns
    text = {f.name: F.col(f"_text_{f.name}") for f in schema}
    texts = messages.select(*kept, *[F.try_variant_get("body", f"$['{name}']", "string").alias(f"_text_{name}") for name in text])
    typed = texts.select(*texts.columns, *[text[f.name].try_cast(f.dataType).alias(f.name) for f in schema])
    broken = [
        F.when(text[f.name].isNotNull() & F.col(f.name).isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}")) for f in schema
    ]
    missing = [F.when(text[name].isNull(), F.lit(f"{name}: missing")) for name in MESSAGE_REQUIRED if name in text]
    return typed, F.nullif(F.concat_ws("; ", *broken, *missing), F.lit(""))


def parse_envelope(
    messages: DataFrame, id_type: DataType = StringType(), processed_at: Column | None = None
) -> DataFrame:
    """Envelope columns, the body's fields, the time of processing, the text of the body and its ``fault``.

    ``fault`` is null for an event, and else names every field that is absent though required or is not of
    its type, or says that the body is no JSON object. A body that names a field twice is none.
    """
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    text = F.col("json_value")
    # A parser may stop behind the first value; whatever follows it would be lost.
    is_object = F.schema_of_variant("body").startswith("OBJECT") & F.rtrim(text).endswith("}")
    bodies = messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        "partition",
        "offset",
        F.col("value").cast("string").alias("json_value"),
    ).withColumn("body", F.try_parse_json("json_value"))
    schema = payload_schema(id_type)
    fields, fault = body_fields(bodies, schema)
    return fields.select(
        *ENVELOPE,
        *schema.names,
        processed_at.alias("processed_at"),
        "json_value",
        F.when(text.isNull(), F.lit("body: absent"))
        .when(F.coalesce(is_object, F.lit(False)), fault)
        .otherwise(F.lit("body: no JSON object"))
        .alias("fault"),
    )


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, messages that hold none, with their text and what is wrong with it)."""
    events = parsed.where(F.col("fault").isNull()).drop("json_value", "fault")
    malformed = parsed.where(F.col("fault").isNotNull()).select(*ENVELOPE, "json_value", "fault", "processed_at")
    return events, malformed


def body_text(events: DataFrame) -> Column:
    """The JSON body of an event, its time to the microsecond."""
    fields = [c for c in payload_schema().names if c in events.columns]
    return F.to_json(
        F.struct(*[iso_text(F.col(c)).alias(c) if c == "event_ts" else F.col(c) for c in fields])
    )


def to_envelope(events: DataFrame, partition: Column, offset: Column, body: Column | None = None) -> DataFrame:
    """Events as a message bus would carry them (for feeds and tests)."""
    body = body_text(events) if body is None else body
    return events.select(
        F.col("content_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.col("event_ts").alias("timestamp"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
    )


@contextmanager
def held(batch: DataFrame):
    """Keep a batch while it is written twice, so that its messages are fetched and parsed once."""
    batch.persist()
    try:
        yield
    finally:
        batch.unpersist()


def store_events(root: str) -> Handler:
    """Write a batch's events to ``root/events`` and the rest to ``root/quarantine``."""

    def handler(parsed: DataFrame, batch_id: int) -> None:
        with held(parsed):
            events, malformed = split_malformed(parsed)
            write_batch(events, f"{root}/events", batch_id)
            write_batch(malformed, f"{root}/quarantine", batch_id)

    return handler


def append_events(db: Database, table: str, root: str) -> Handler:
    """Append a batch's events to a database table, once however often it is replayed; what holds no
    event goes to ``root/quarantine``. ``root`` names the stream in the table's ledger of batches."""

    def handler(parsed: DataFrame, batch_id: int) -> None:
        with held(parsed):
            events, malformed = split_malformed(parsed)
            write_batch(malformed, f"{root}/quarantine", batch_id)
            jdbc.append_once(events, db, table, root, batch_id, ("partition", "offset"))

    return handler
