"""Keys, JSON records and timestamp text of the serving view, and slugs of new items."""

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NullType, StringType, StructType, VariantType

_KEEP_NULLS = {"ignoreNullFields": "false"}


def iso_text(ts: Column) -> Column:
    """ISO-8601 with microseconds and the offset spelled out."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def record_json(record: Column) -> Column:
    """A struct, or an array of structs, as JSON that keeps its null fields."""
    return F.to_json(record, _KEEP_NULLS)


def key_of(*parts: str | Column) -> Column:
    """A serving key such as ``stats:events:play``; plain strings are literal parts.

    A missing part reads ``None``, so that a null group still has a key of its own.
    """
    pieces = [
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("None"))
        for p in parts
    ]
    return F.concat_ws(":", *pieces)


# How new items are named (fixed values).
SLUG_PREFIX, TITLE_PREFIX = "auto-content-", "Auto Generated Content "


def generated_slug(token: Column, prefix: str = SLUG_PREFIX) -> Column:
    """A slug from the first eight hex digits of an identifier."""
    return F.concat(F.lit(prefix), F.substring(F.replace(token, F.lit("-"), F.lit("")), 1, 8))


def generated_title(slug: Column, prefix: str = TITLE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.right(slug, F.lit(4)))


def payload_field(raw_payload: Column, name: str) -> Column:
    return F.get_json_object(raw_payload, f"$.{name}")


def payload_variant(raw_payload: Column) -> Column:
    """The payload as a VARIANT; text that is not JSON becomes null."""
    return F.try_parse_json(raw_payload)


def variant_schema(rows: DataFrame, column: str) -> StructType:
    """The fields of all JSON objects of a text column together, in types that hold all their values.

    The schema merges within each input task first; one line comes back. A field that is of several kinds, or
    always null, is text. Rows that hold no JSON object have no part in it.
    """
    body = F.try_parse_json(column)
    objects = rows.select(body.alias("body")).where(F.schema_of_variant("body").startswith("OBJECT"))
    said = objects.agg(F.schema_of_variant_agg("body")).first()[0]
    if not said or not said.startswith("OBJECT<"):
        return StructType([])
    found = StructType.fromDDL("x " + re.sub(r"\bOBJECT<", "STRUCT<", said))["x"].dataType
    for field in found:
        if isinstance(field.dataType, (NullType, VariantType)):
            field.dataType = StringType()
    return found


def with_variant_fields(rows: DataFrame, column: str, schema: StructType | None = None) -> DataFrame:
    """``rows`` and a column for each field of the JSON objects in ``column``, those known by name already
    as ``column_field``. Where a field is absent, or the text is no object, it is null."""
    schema = variant_schema(rows, column) if schema is None else schema
    taken = set(rows.columns)
    # By a map rather than by paths: a path cannot hold every name.
    held = F.try_variant_get(F.try_parse_json(column), "$", "map<string, variant>")
    fields = {
        f"{column}_{f.name}" if f.name in taken else f.name:
        F.try_variant_get(F.try_element_at(held, F.lit(f.name)), "$", f.dataType.simpleString())
        for f in schema
    }
    return rows.withColumns(fields) if fields else rows
