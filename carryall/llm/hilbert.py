"""Shards along a Hilbert curve through the metadata of documents.

Several columns are quantised to a grid by their quantiles, rows are put in the order
of their place on the curve through that grid, and the order is cut into runs. Rows
of a run are near in every column, so that files of a shard have narrow ranges of
each, and a filter on any of them skips files.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from carryall.sources.tables import pin

DIMENSIONS = ("source", "lang", "n_chars")
BITS = 5
SHARDS = 16


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of grid cells (by Skilling's transpose form)."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        below = q - one
        for i in range(dims):
            up = (x[i] & q) != 0
            turn = (x[0] ^ x[i]) & below
            x[0] = np.where(up, x[0] ^ below, x[0] ^ turn)
            if i:
                x[i] = np.where(up, x[i], x[i] ^ turn)
        q >>= one
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - one), turn)
        q >>= one
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out.astype(np.int64)


def _ordinal(df: DataFrame, name: str) -> Column | None:
    """A column that is a number or a time as a number; None for any other."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(f"`{name}`").cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(f"`{name}`").cast("timestamp")).cast("double")
    return None


def _text(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def value_cells(df: DataFrame, name: str, bits: int) -> DataFrame:
    """(value, cell) of the distinct whole values of a column, as text and in its order.

    The cell of a value is the share of all rows that have it or a lower one, so that
    values with a common beginning, however long, are told apart. Values are counted,
    dealt to ranges, and numbered behind the rows of all earlier ranges; to the driver
    comes a sum a range.
    """
    counts = df.filter(_text(name).isNotNull()).groupBy(_text(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = pin(counts.repartitionByRange("value").withColumn("range", F.spark_partition_id()), "values")
    before, total = [], 0
    for row in ranged.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():
        before.append((row["range"], total))
        total += row["n"]
    offsets = df.sparkSession.createDataFrame(before, "range int, before long")
    upto = F.sum("n").over(Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    cell = F.expr(f"cast((before + upto - 1) * {1 << bits} div {max(1, total)} as int)")
    return pin(ranged.withColumn("upto", upto).join(F.broadcast(offsets), "range").select("value", cell.alias("cell")), "cells")


def _with_cells(df: DataFrame, rows: DataFrame, names: list[str], bits: int) -> DataFrame:
    """Adds `cells` to rows that still have the columns: the cell of a row in each of them. Null is cell 0.

    Numbers and times have as cell how many of the column's quantiles lie below.
    """
    numbers = {n: _ordinal(df, n) for n in names}
    asked = [n for n in names if numbers[n] is not None]
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(numbers[n], steps, 10_000).alias(str(k)) for k, n in enumerate(asked)]).first() if asked else []
    cuts = {n: sorted(set(found[k] or [])) for k, n in enumerate(asked)}
    cells = []
    for k, name in enumerate(names):
        value = numbers[name]
        if value is None:
            of_value = value_cells(df, name, bits).select(F.col("value").alias(f"__value{k}"), F.col("cell").alias(f"__cell{k}"))
            # Small enough to be broadcast, or too big for it: the planner knows the size of a written table.
            rows = rows.join(of_value, _text(name) == F.col(f"__value{k}"), "left")
            cells.append(F.coalesce(f"__cell{k}", F.lit(0)))
        elif cuts[name]:
            below = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts[name]]), lambda c: c <= value))
            cells.append(F.coalesce(F.when(value.isNotNull(), below), F.lit(0)).cast("int"))
        else:
            cells.append(F.lit(0))
    return rows.withColumn("__cells", F.array(*cells) if cells else F.array(F.lit(0)))


def placed(docs: DataFrame, dimensions=DIMENSIONS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, the grid cells and the place on the curve (`curve`) of every row."""
    names = [d for d in dimensions if d in docs.columns]
    text = F.col("text").cast("string")
    base = _with_cells(docs, docs, names, bits).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.col("__cells").alias("cells"),
    )

    @F.pandas_udf("long")
    def curve(cells: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack(cells.to_numpy()), bits) if len(cells) else [], dtype="int64")

    return base.withColumn("curve", curve("cells"))


def shards(docs: DataFrame, n_shards: int = SHARDS, dimensions=DIMENSIONS, bits: int = BITS) -> DataFrame:
    """The shard of every document and its slot there; counts of shards differ by one at most.

    Gives doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null),
    curve. The order is that of the curve; ties go by text, then doc_id. The rows are
    dealt to ranges of that order, and a row's rank is its place in its range behind
    all earlier ranges; so no task sees more than a range, and a third of all rows in
    one cell are spread over many.

    A null text has size 1. Nulls in a dimension are in its first cell, a dimension
    that is missing is left out. Rows without doc_id are placed like others; repeated
    rows get a slot each. An empty table gives no rows.
    """
    order = ["curve", "text_crc32", "doc_id"]
    # Repeated rows are told apart by a number that is written down, so that they fill many ranges.
    rows = pin(placed(docs, dimensions, bits).drop("cells").withColumn("row", F.monotonically_increasing_id()), "placed")
    order = [*order, "row"]
    ranged = pin(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranged")
    sizes = {r["range"]: r["n"] for r in ranged.groupBy("range").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for k in sorted(sizes):
        before.append((k, total))
        total += sizes[k]
    spark = docs.sparkSession
    offsets = spark.createDataFrame(before, "range int, before long")
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    rank = F.col("before") + F.col("place")
    exact = F.expr(f"cast((rank * {n_shards}L) div {max(1, total)}L as int)")
    first = F.expr(f"(shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return (
        ranged.withColumn("place", place)
        .join(F.broadcast(offsets), "range")
        .withColumn("rank", rank)
        .withColumn("shard", exact)
        .withColumn("slot", F.col("rank") - first)
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "curve",
        )
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, dimensions=DIMENSIONS, bits: int = BITS) -> None:
    """Writes the documents to one folder per shard, each file in the order of the curve."""
    placed_rows = shards(docs, n_shards, dimensions, bits).select(F.col("doc_id").alias("_id"), "text_crc32", "shard", "slot").distinct()
    text = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))) & (text == F.col("text_crc32"))
    once = placed_rows.groupBy("_id", "text_crc32").agg(F.min_by("shard", "slot").alias("shard"), F.min("slot").alias("slot"))
    out = docs.join(once, same).drop("_id", "text_crc32")
    (
        out.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .drop("slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
