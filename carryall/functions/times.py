"""Day arithmetic on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def moment(as_of) -> Column:
    """An explicit point in time as a zone-free timestamp column."""
    col = as_of if isinstance(as_of, Column) else F.lit(str(as_of))
    return col.cast("timestamp_ntz")


def days(n) -> Column:
    return F.make_dt_interval(F.col(n) if isinstance(n, str) else n)
