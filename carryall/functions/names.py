"""Qualified table names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def qualified(sep: str = "/", catalog="catalog_name", db="db_name", tbl="tbl_name") -> Column:
    """catalog<sep>db<sep>tbl; null if any part is null."""
    return F.concat(F.col(catalog), F.lit(sep), F.col(db), F.lit(sep), F.col(tbl))
