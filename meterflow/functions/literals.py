"""Literal arrays as one SQL expression instead of one driver call per element."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(values: Iterable[float | None]) -> str:
    return ", ".join("CAST(NULL AS DOUBLE)" if v is None else f"{float(v)!r}D" for v in values)


def doubles(values: Iterable[float | None]) -> Column:
    """``ARRAY<DOUBLE>`` literal; None becomes NULL."""
    return F.expr(f"array({_text(values)})")


def double_rows(rows: Sequence[Sequence[float]]) -> Column:
    """``ARRAY<ARRAY<DOUBLE>>`` literal."""
    return F.expr("array(" + ", ".join(f"array({_text(r)})" for r in rows) + ")")
