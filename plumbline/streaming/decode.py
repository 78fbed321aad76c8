"""Message text to typed records, on batch tables and streams alike.

Bad messages are marked, not dropped, so a sink can keep them aside:
``status`` is ``ok``, ``malformed`` (no JSON object) or ``invalid`` (a required
field is null or no number).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.spec import CHURN_FIELDS, CHURN_REQUIRED

OBJECT = "map<string,variant>"


def _once(df: DataFrame, value: Column, output: str) -> DataFrame:
    """Add a column that is computed once per row.

    Filters above a plain projection copy its expressions into themselves, so a
    parsed message would be parsed again for every field. A generated column is
    never copied.
    """
    return df.select("*", F.explode(F.array(value)).alias(output))


def decode_json(df: DataFrame, value: str = "value", output: str = "message") -> DataFrame:
    """Parse text as a JSON object; null when it is not one."""
    parsed = F.try_parse_json(F.col(f"`{value}`").cast("string"))
    return _once(df, F.try_variant_get(parsed, "$", OBJECT), output)


def unwrap_envelope(df: DataFrame, message: str = "message", output: str = "payload") -> DataFrame:
    """The object under ``data`` when the message has that key, else the message itself."""
    m = F.col(f"`{message}`")
    inner = F.try_variant_get(F.element_at(m, "data"), "$", OBJECT)
    return _once(df, F.when(F.map_contains_key(m, "data"), inner).otherwise(m), output)


def field_value(payload: Column, name: str, type: str, default: object) -> Column:
    """Field of a payload: the default when the key is absent, null when it (or the payload) is null."""
    found = F.try_variant_get(F.element_at(payload, name), "$", type)
    present = F.map_contains_key(payload, name)
    return F.when(present, found).when(~present, F.lit(default).cast(type))


def extract_fields(
    df: DataFrame,
    fields: Mapping[str, tuple[str, object]] = CHURN_FIELDS,
    required: Sequence[str] = CHURN_REQUIRED,
    payload: str = "payload",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns for the fields, ``status``, and the columns to keep."""
    p = F.col(f"`{payload}`")
    record = F.struct(
        p.isNull().alias("_malformed"), *[field_value(p, n, t, d).alias(n) for n, (t, d) in fields.items()]
    )
    typed = df.select(*keep, F.inline(F.array(record)))
    invalid: Column = F.lit(False)
    for name in required:
        invalid = invalid | F.col(f"`{name}`").isNull()
    status = F.when(F.col("_malformed"), "malformed").when(invalid, "invalid").otherwise("ok")
    return typed.withColumn("status", status).drop("_malformed")


def decode_records(
    df: DataFrame,
    fields: Mapping[str, tuple[str, object]] = CHURN_FIELDS,
    required: Sequence[str] = CHURN_REQUIRED,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode, unwrap and extract in one go."""
    message = unwrap_envelope(decode_json(df, value))
    return extract_fields(message, fields, required, keep=keep)


def with_envelope_time(df: DataFrame, message: str = "message") -> DataFrame:
    """The envelope's own timestamp as text."""
    stamp = F.try_variant_get(F.element_at(F.col(f"`{message}`"), "timestamp"), "$", "string")
    return df.withColumn("_envelope_timestamp", stamp)
