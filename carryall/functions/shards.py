"""Stable assignment of rows to shards and to numbered positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_TWO_32 = 4294967296


def shard_of(value: Column, shards: int) -> Column:
    """1 + (md5 of the decimal text, read as a 128-bit number) mod ``shards``.

    2**128 fits no Spark number, so the remainder is carried over four 32-bit
    pieces; every step stays inside BIGINT while ``shards`` < 2**31.
    """
    digest = F.md5(value.cast("string").cast("binary"))
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        piece = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(_TWO_32) + piece) % F.lit(shards)
    return (rest + 1).cast("int")


def number_rows(
    df: DataFrame,
    within: list[str],
    by: list[str],
    out: str,
    total: str | None = None,
    hex_digits: int = 3,
) -> DataFrame:
    """Consecutive numbers 1..n in every ``within`` group, with no task holding a group.

    Rows fall into 16**hex_digits buckets by the md5 of ``by``; a row's number is
    the count of rows in lower buckets plus its rank inside its own bucket. A
    group's rows are thus sorted by many tasks even when it is the whole input,
    and only the bucket counts (at most 16**hex_digits per group) are summed up
    in one place. ``by`` must be unique and not null inside a group. ``total``
    names a further column for n.
    """
    text = F.concat_ws("\u0001", *[F.col(c).cast("string") for c in by])
    bucketed = df.withColumn("__bucket", F.substring(F.md5(text.cast("binary")), 1, hex_digits))
    counts = bucketed.groupBy(*within, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1))
    before = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *within,
        "__bucket",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        *([F.sum("__n").over(group).alias(total)] if total else []),
    )
    inside = Window.partitionBy(*within, "__bucket").orderBy(*by)
    ranked = bucketed.withColumn("__rank", F.row_number().over(inside))
    return (
        ranked.join(offsets, [*within, "__bucket"])
        .withColumn(out, (F.col("__before") + F.col("__rank")).cast("bigint"))
        .drop("__bucket", "__rank", "__before")
    )
