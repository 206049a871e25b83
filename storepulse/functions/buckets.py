"""Bucket labels for ages, expiry bands, fiscal years and store names."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    AGE_BUCKET_EDGES,
    EXPIRY_BAND_LAST,
    EXPIRY_BANDS,
    FISCAL_YEAR_FIRST,
    FISCAL_YEAR_LAST,
    FISCAL_YEAR_NONE,
)


def bucket_seq(days: Column, edges: Sequence[float] = AGE_BUCKET_EDGES, open_low: bool = False) -> Column:
    """1-based bucket of right-closed bins ``(e0, e1], (e1, e2], ..., (e_last, inf)``.

    ``open_low=True`` makes the first bin ``(-inf, e1]``. Values at or below
    ``e0`` (when the low end is closed) and nulls get no bucket (null).
    """
    expr = F.lit(len(edges))
    for i in range(len(edges) - 1, 0, -1):
        expr = F.when(days <= F.lit(edges[i]), F.lit(i)).otherwise(expr)
    if not open_low:
        expr = F.when(days > F.lit(edges[0]), expr)
    return F.when(days.isNotNull(), expr)


def expiry_band_seq(clock: Column) -> Column:
    """0 for expired (clock <= 0) up to 6 for more than 180 days; null stays null."""
    expr = F.lit(len(EXPIRY_BANDS))
    for i in range(len(EXPIRY_BANDS) - 1, -1, -1):
        expr = F.when(clock <= F.lit(EXPIRY_BANDS[i][0]), F.lit(i)).otherwise(expr)
    return F.when(clock.isNotNull(), expr)


def expiry_band_label(seq: Column) -> Column:
    labels = [label for _, label in EXPIRY_BANDS] + [EXPIRY_BAND_LAST]
    expr = F.lit(None).cast("string")
    for i in range(len(labels) - 1, -1, -1):
        expr = F.when(seq == F.lit(i), F.lit(labels[i])).otherwise(expr)
    return expr


def fiscal_year_label(ts: Column, first: int = FISCAL_YEAR_FIRST, last: int = FISCAL_YEAR_LAST) -> Column:
    """``FYyy-yy`` for April-March years that start from ``first`` to ``last``, else "None"."""
    fy = F.year(F.add_months(F.to_date(ts), -3))
    labels = F.array(*[F.lit(f"FY{y % 100:02d}-{(y + 1) % 100:02d}") for y in range(first, last + 1)]).cast("array<string>")
    return F.coalesce(F.get(labels, fy - F.lit(first)), F.lit(FISCAL_YEAR_NONE))


def before_last_space(text: Column) -> Column:
    """Text before the last space; text without a space is kept whole."""
    last = F.substring_index(text, " ", -1)
    return F.when(F.contains(text, F.lit(" ")), text.substr(F.lit(1), F.length(text) - F.length(last) - 1)).otherwise(text)
