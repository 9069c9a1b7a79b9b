"""Order-free, duplicate-aware fingerprints of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A 64-bit hash is summed in 16-bit pieces: BIGINT sums then hold 2**47 rows per
# partition and stay in fixed-width aggregation buffers.
_PIECES = 4
_WIDTH = 16


def hashable(col: Column, dtype: T.DataType) -> Column:
    """The value with every map, however deep, as its sorted entry list."""
    if isinstance(dtype, T.MapType):
        entries = F.map_entries(col)
        if _has_map(dtype.keyType) or _has_map(dtype.valueType):
            entries = F.transform(
                entries,
                lambda e: F.struct(
                    hashable(e["key"], dtype.keyType).alias("key"),
                    hashable(e["value"], dtype.valueType).alias("value"),
                ),
            )
        return F.array_sort(entries)
    if isinstance(dtype, T.ArrayType) and _has_map(dtype.elementType):
        return F.transform(col, lambda x: hashable(x, dtype.elementType))
    if isinstance(dtype, T.StructType) and _has_map(dtype):
        rebuilt = F.struct(*[hashable(col[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(col.isNotNull(), rebuilt)
    return col


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return False


def _tagged(col: Column, dtype: T.DataType) -> list[Column]:
    """Column(s) to feed to the hash so that a null is seen wherever it sits.

    The hash skips nulls, so a flag goes next to each nullable value; inside
    arrays and structs the JSON text keeps nulls apart from absent values.
    """
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        text = F.to_json(F.struct(hashable(col, dtype).alias("v")), {"ignoreNullFields": "false"})
        return [text]
    return [col, col.isNull()]


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """64-bit hash of the named columns (all by default)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fed: list[Column] = []
    for name in columns or df.columns:
        fed.extend(_tagged(F.col(f"`{name}`"), types[name]))
    return F.xxhash64(*fed)


def hash_pieces(value: Column) -> list[Column]:
    mask = F.lit((1 << _WIDTH) - 1).cast("bigint")
    return [F.shiftrightunsigned(value, _WIDTH * i).bitwiseAND(mask) for i in range(_PIECES)]


PIECE_NAMES = [f"__h{i}" for i in range(_PIECES)]
