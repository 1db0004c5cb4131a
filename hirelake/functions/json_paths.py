"""PostgreSQL JSONB accessors over a VARIANT payload.

The payload column holds three different shapes in one column (an object ``company``
in one source, a string in another), so it is a VARIANT, never one inferred struct.
Every accessor is a ``try_`` form: a value of an unexpected type gives NULL instead
of failing the whole job (PostgreSQL would fail the statement).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(raw: Column | str, path: str) -> Column:
    """``raw->>'k'`` / ``raw->'a'->>'b'``: text of the value at ``path`` or NULL.

    ``path`` is a JSONPath such as ``$.company.display_name``; a scalar parent gives
    NULL. Objects and arrays come back as their JSON text.
    """
    return F.try_variant_get(raw, path, "string")


def json_array(raw: Column | str, path: str) -> Column:
    return F.try_variant_get(raw, path, "array<string>")


def json_first(raw: Column | str, path: str) -> Column:
    """``->>0`` of the array at ``path``."""
    return F.try_variant_get(raw, f"{path}[0]", "string")


def json_last(raw: Column | str, path: str) -> Column:
    """``->>-1`` of the array at ``path``."""
    return F.try_element_at(json_array(raw, path), F.lit(-1))


def json_decimal(raw: Column | str, path: str, dtype: str = "decimal(38,4)") -> Column:
    """``(raw->>'k')::NUMERIC``; text that is not a number gives NULL."""
    return json_text(raw, path).try_cast(dtype)


def json_bool(raw: Column | str, path: str) -> Column:
    """``(raw->>'k')::BOOLEAN``."""
    return json_text(raw, path).try_cast("boolean")


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text ``::TIMESTAMPTZ``; zone-less values are read in the session zone."""
    return text.try_cast("timestamp")


def epoch_timestamp(text: Column) -> Column:
    """``to_timestamp(text::DOUBLE PRECISION)``."""
    secs = text.try_cast("double")
    return F.when(secs.isNotNull(), F.timestamp_seconds(secs))


def per_source(source: Column, branches: dict[str, Column], default: Column) -> Column:
    """CASE on the source name: each source reads its own path, others the default."""
    out = None
    for name, value in branches.items():
        out = F.when(source == name, value) if out is None else out.when(source == name, value)
    return default if out is None else out.otherwise(default)


def payload_to_text(raw: Column | str) -> Column:
    """Serialise a payload for text storage."""
    return F.to_json(raw)
