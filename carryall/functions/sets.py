"""Arrays used as sets: sorted, distinct, without nulls."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def empty_set() -> Column:
    return F.array().cast("array<string>")


def as_set(arr: Column) -> Column:
    """Normal form of an array column; null becomes the empty set."""
    return F.array_sort(F.array_distinct(F.array_compact(F.coalesce(arr, empty_set()))))


def literal_set(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(set(values))]).cast("array<string>")


def is_blank(arr: Column) -> Column:
    """True for a null or empty set."""
    return F.coalesce(F.size(arr) < 1, F.lit(True))
