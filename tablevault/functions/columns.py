"""Column helpers: quoting, comparable forms of complex values, and row hashes.

Everything here builds JVM-side column expressions; no row reaches Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY = "UTF8_BINARY"
_LIMBS = 4
_LIMB_BITS = 16
_LIMB_MASK = (1 << _LIMB_BITS) - 1
_FLAGS = 62


def quoted(name: str) -> str:
    """Backtick-quote one identifier, so dots and spaces in names are safe."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def columns(df: DataFrame) -> list[Column]:
    return [column(name) for name in df.columns]


def comparable(value: Column, dtype: T.DataType) -> Column:
    """A form of `value` that hashes and sorts by content.

    Maps have no order, so they become entry arrays sorted by key, variants become JSON
    text, and text with a collation, for which 'A' may equal 'a', becomes plain text. This
    is done at every nesting level and leaves other types alone.
    """
    if not (holds(dtype, T.MapType, T.VariantType) or collated(dtype)):
        return value
    if isinstance(dtype, T.StringType):
        return F.collate(value, BINARY)
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                comparable(e["key"], dtype.keyType).alias("key"),
                comparable(e["value"], dtype.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: comparable(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [comparable(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.to_json(value)  # VariantType


def collated(dtype: T.DataType) -> bool:
    """Whether a type is, or contains at any depth, text that is not compared byte by byte."""
    if isinstance(dtype, T.StringType):
        return dtype.collation != BINARY
    if isinstance(dtype, T.ArrayType):
        return collated(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return collated(dtype.keyType) or collated(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(collated(f.dataType) for f in dtype.fields)
    return False


def free_name(name: str, taken: list[str]) -> str:
    """`name`, with underscores before it until no column is called so."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def holds(dtype: T.DataType, *kinds: type[T.DataType]) -> bool:
    """Whether a type is, or contains at any depth, one of `kinds`."""
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.ArrayType):
        return holds(dtype.elementType, *kinds)
    if isinstance(dtype, T.MapType):
        return holds(dtype.keyType, *kinds) or holds(dtype.valueType, *kinds)
    if isinstance(dtype, T.StructType):
        return any(holds(f.dataType, *kinds) for f in dtype.fields)
    return False


def null_layout(value: Column, dtype: T.DataType) -> Column:
    """Where `value` holds NULLs, and how long its arrays are, at every level.

    Spark's hashes skip NULLs and run nested arrays together, so `(NULL, 'a')` and
    `('a', NULL)` hash alike. Hashing this beside the value tells them apart. Field
    nullability is ignored on purpose: a copy read from Parquet is nullable throughout.
    """
    if isinstance(dtype, T.MapType):
        by_key = F.array_sort(
            F.transform(
                F.map_entries(value),
                lambda e: F.struct(
                    comparable(e["key"], dtype.keyType).alias("key"),
                    null_layout(e["value"], dtype.valueType).alias("nulls"),
                ),
            )
        )
        return F.struct(
            F.coalesce(F.size(value), F.lit(-1)), F.transform(by_key, lambda e: e["nulls"])
        )
    if isinstance(dtype, T.ArrayType):
        return F.struct(
            F.coalesce(F.size(value), F.lit(-1)),
            F.transform(value, lambda x: null_layout(x, dtype.elementType)),
        )
    if isinstance(dtype, T.StructType):
        return F.struct(
            value.isNull(), *[null_layout(value[f.name], f.dataType) for f in dtype.fields]
        )
    return value.isNull()


def row_hash(schema: T.StructType) -> Column:
    """A 64-bit hash of the whole row, sensitive to NULL positions.

    The NULL flags of plain columns are packed into bigints, `_FLAGS` to each.
    """
    values = [comparable(column(f.name), f.dataType) for f in schema.fields]
    nested = [
        f for f in schema.fields if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
    ]
    layouts = [null_layout(column(f.name), f.dataType) for f in nested]
    plain = [column(f.name) for f in schema.fields if f not in nested]
    packed = [
        reduce(
            Column.bitwiseOR,
            [
                F.when(value.isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                for i, value in enumerate(plain[start : start + _FLAGS])
            ],
        )
        for start in range(0, len(plain), _FLAGS)
    ]
    return F.xxhash64(*values, *layouts, *packed)


def limb_sums(value: Column, prefix: str) -> list[Column]:
    """Aggregates that together hold the exact sum of a bigint.

    The value is summed as four 16-bit limbs, the top one signed. Each limb sum is a plain
    bigint, which stays inside generated code and cannot overflow below 1.4e14 rows; a
    decimal sum is several times slower.
    """
    top = _LIMBS - 1
    limbs = [
        F.shiftright(value, _LIMB_BITS * i).bitwiseAND(F.lit(_LIMB_MASK)) for i in range(top)
    ] + [F.shiftright(value, _LIMB_BITS * top)]
    return [F.sum(limb).alias(f"{prefix}_{i}") for i, limb in enumerate(limbs)]


def limb_total(prefix: str) -> Column:
    """The sum out of its limbs, as decimal(38,0); NULL if nothing was summed."""
    total = F.lit(0).cast("decimal(38,0)")
    for i in range(_LIMBS):
        weight = F.lit(str(1 << (_LIMB_BITS * i))).cast("decimal(15,0)")
        total = (total + F.col(f"{prefix}_{i}").cast("decimal(19,0)") * weight).cast(
            "decimal(38,0)"
        )
    return total


def limb_total_of(metrics: dict[str, int | None], prefix: str) -> int:
    """`limb_total` of limbs that were observed during a write; 0 if nothing was summed."""
    return sum((metrics[f"{prefix}_{i}"] or 0) << (_LIMB_BITS * i) for i in range(_LIMBS))
