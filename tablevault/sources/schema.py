"""Schemas from field definitions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import types as T

# The type names that need no DDL parser, and so no running session.
BASIC_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def create_schema(
    fields: Iterable[Mapping[str, Any]], on_unknown: str = "string"
) -> T.StructType:
    """Build a schema from `{"name", "type", "nullable"}` definitions.

    `type` is any Spark DDL type in either case (`string`, `BIGINT`, `decimal(10,2)`,
    `array<int>`); `nullable` defaults to true. A type Spark does not know becomes a
    string, or raises `ValueError` with `on_unknown="error"`. A missing name or type is a
    `KeyError`.
    """
    if on_unknown not in ("string", "error"):
        raise ValueError(f"on_unknown must be 'string' or 'error', not {on_unknown!r}")
    return T.StructType(
        [
            T.StructField(f["name"], _data_type(f["type"], on_unknown), f.get("nullable", True))
            for f in fields
        ]
    )


def _data_type(name: Any, on_unknown: str) -> T.DataType:
    if isinstance(name, T.DataType):
        return name
    if str(name).lower() in BASIC_TYPES:
        return BASIC_TYPES[str(name).lower()]
    try:
        return T.DataType.fromDDL(str(name))
    except ParseException:
        if on_unknown == "error":
            raise ValueError(f"unknown column type: {name!r}") from None
        return T.StringType()
