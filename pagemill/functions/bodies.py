"""Message bodies: which keys a body names, and the bodies sent onwards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill import constants as C


def receive_count(attributes: Column) -> Column:
    """Delivery count from message attributes, 1 when absent, NULL when it is not a number."""
    value = attributes[C.RECEIVE_COUNT_ATTRIBUTE]
    return F.coalesce(value, F.lit(C.DEFAULT_RECEIVE_COUNT)).try_cast("int")


def body_kind(body: Column) -> Column:
    """OBJECT, OTHER for any other JSON, TEXT for what is not JSON."""
    return (
        F.when(F.json_object_keys(body).isNotNull(), "OBJECT")
        .when(F.try_parse_json(body).isNotNull(), "OTHER")
        .otherwise("TEXT")
    )


def parsed_fields(body: Column) -> Column:
    """The key fields of a body as a struct of variants, all from one parse."""
    return F.from_json(body, ", ".join(f"{name} variant" for name in C.MESSAGE_KEY_FIELDS))


def key_fields(parsed: Column) -> Column:
    """:func:`parsed_fields` in order of preference, as ``array<struct<kind, value>>``.

    The text alone cannot tell the number 0 from the string "0", so the JSON type is
    kept beside it.
    """
    return F.array(
        *[
            F.struct(
                F.schema_of_variant(parsed[name]).alias("kind"),
                F.try_variant_get(parsed[name], "$", "string").alias("value"),
            )
            for name in C.MESSAGE_KEY_FIELDS
        ]
    )


def is_named(field: Column) -> Column:
    """A field that is there and not null, ``""``, ``0``, ``false``, ``[]`` or ``{}``."""
    kind, value = field["kind"], field["value"]
    empty = (
        F.when(kind == "STRING", value == "")
        .when(kind == "VOID", F.lit(True))
        .when(kind == "BOOLEAN", value == "false")
        .when(kind.startswith("ARRAY"), value == "[]")
        .when(kind.startswith("OBJECT"), value == "{}")
        .otherwise(value.try_cast("double") == 0)
    )
    return kind.isNotNull() & ~empty


def named_work(body: Column, kind: Column, fields: Column) -> Column:
    """``struct(kind, value)`` of the work a message body names.

    A body that is not JSON is itself the key, and so is an object without any of the
    key fields. JSON that is not an object names nothing, and neither does a number or
    an object in a key field: their kind is neither STRING nor ARRAY.
    """
    whole = F.struct(F.lit("STRING").alias("kind"), body.alias("value"))
    nothing = F.struct(F.lit("OTHER").alias("kind"), body.alias("value"))
    first = F.get(F.filter(fields, is_named), F.lit(0))
    return F.when(kind == "TEXT", whole).when(kind == "OTHER", nothing).otherwise(F.coalesce(first, whole))


def work_keys(work: Column) -> Column:
    """Keys named by :func:`named_work`; a list gives all of its items."""
    return F.when(work["kind"] == "STRING", F.array(work["value"])).when(
        work["kind"].startswith("ARRAY"), F.from_json(work["value"], "array<string>")
    )


def announcement(s3_key: Column) -> Column:
    """Body that announces an object downstream."""
    return F.to_json(F.struct(s3_key.alias("s3_key")))


def failed_keys_letter(keys: Column) -> Column:
    return F.to_json(F.struct(keys.alias("failed_keys"), F.lit(C.REASON_WORKER).alias("reason")))


def failed_pages_letter(s3_key: Column) -> Column:
    return F.to_json(F.struct(s3_key.alias("failed_pages"), F.lit(C.REASON_OCR).alias("reason")))


def last_error(message: Column) -> Column:
    return F.substring(message, 1, C.LAST_ERROR_CHARS)
