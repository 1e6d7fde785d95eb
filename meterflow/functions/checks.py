"""Eager schema checks: they look at column names only and start no job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str], error: type[Exception] = KeyError) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise error(f"Missing columns: {missing}")


def missing_to_null(column: str | Column) -> Column:
    """NaN and NULL both mean a missing reading; keep only NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.nanvl(c, F.lit(None).cast("double"))
