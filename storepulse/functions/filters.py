"""Row predicates shared by the reports."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_excluded(col: Column | str, names: Iterable[str]) -> Column:
    """``col NOT IN names`` that keeps null values (a missing territory stays)."""
    col = F.col(col) if isinstance(col, str) else col
    names = list(names)
    if not names:
        return F.lit(True)
    return col.isNull() | ~col.isin(names)


def all_not_null(cols: Iterable[str]) -> Column:
    cond = F.lit(True)
    for name in cols:
        cond = cond & F.col(name).isNotNull()
    return cond
