"""Totals of one or more measures per reporting window, optionally per key.

One scan and one aggregation serve every window: the rows are first
restricted to the span of all windows (a range filter the planner pushes to
the parquet scan), then each window contributes a conditional sum
``sum(CASE WHEN ts in window THEN value END)`` and a matching row count to
the same ``groupBy``. Rows are never replicated per window and no join with
a window table is planned. The aggregation is partial (map side) and final,
so a key holding a third of all rows sends one small row per map task to
the shuffle. Sums are exact (:mod:`..functions.exact`), so no result
depends on the partitioning of a run.

Semantics follow the original per-window frames:

* a keyed report has a row for a key and window only when the window holds
  at least one row of that key (after exclusion; null keys are dropped);
* a present group whose values are all null totals 0;
* the ungrouped total has a row for every window, 0 when empty;
* the running form adds earlier windows' group totals, and a key appears
  from the first window in which it has rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import LAKH_DIGITS
from ..functions.dates import ReportWindow, window_span
from ..functions.economics import to_lakh
from ..functions.exact import exact_sum, exact_total, exact_value
from ..functions.filters import all_not_null, not_excluded


@dataclass(frozen=True)
class Exclusion:
    """Leave out rows whose ``column`` is in ``names`` (null values stay)."""

    column: str
    names: tuple[str, ...]


def _sum_col(measure: str, seq: int) -> str:
    return f"{measure}__w{seq}"


def _count_col(seq: int) -> str:
    return f"rows__w{seq}"


def window_sums(
    df: DataFrame,
    ts: str,
    measures: Mapping[str, Column],
    windows: Sequence[ReportWindow],
    keys: Sequence[str] = (),
    exclude: Exclusion | None = None,
) -> DataFrame:
    """Wide aggregate: keys, then per window a row count and each measure's sum.

    Sums are left null for an all-null group here; the long form turns them
    into 0 where the group exists. ``df`` may be a ``window_cube`` of the rows:
    its counts and sums are then added up.
    """
    if _count_col(windows[0].seq) in df.columns:
        rows = df if exclude is None else df.filter(not_excluded(exclude.column, exclude.names))
        rows = rows.filter(all_not_null(keys)) if keys else rows
        parts = [_count_col(w.seq) for w in windows] + [_sum_col(m, w.seq) for w in windows for m in measures]
        sums = [(F.coalesce(F.sum(c), F.lit(0)) if c.startswith("rows__") else exact_value(F.sum(c))).alias(c) for c in parts]
        return (rows.groupBy(*keys) if keys else rows.groupBy()).agg(*sums)
    lo, hi = window_span(windows)
    rows = df.filter(F.col(ts).between(F.lit(lo), F.lit(hi)))
    if exclude is not None:
        rows = rows.filter(not_excluded(exclude.column, exclude.names))
    if keys:
        rows = rows.filter(all_not_null(keys))
    # Each measure is computed once per row; the per-window sums reference it.
    values = {name: f"__m_{i}" for i, name in enumerate(measures)}
    rows = rows.select(*keys, F.col(ts).alias("__ts"), *[v.alias(values[n]) for n, v in measures.items()])
    aggs: list[Column] = []
    for w in windows:
        inside = w.contains(F.col("__ts"))
        aggs.append(F.count(F.when(inside, F.lit(1))).alias(_count_col(w.seq)))
        for name in measures:
            aggs.append(exact_sum(F.when(inside, F.col(values[name]))).alias(_sum_col(name, w.seq)))
    grouped = rows.groupBy(*keys) if keys else rows.groupBy()
    return grouped.agg(*aggs)


def window_cube(
    df: DataFrame, ts: str, measures: Mapping[str, Column], windows: Sequence[ReportWindow], keys: Sequence[str]
) -> DataFrame:
    """Counts and sums of every window at the grain of ``keys`` (null keys kept): one scan that serves every report over them."""
    lo, hi = window_span(windows)
    rows = df.filter(F.col(ts).between(F.lit(lo), F.lit(hi)))
    rows = rows.select(*keys, F.col(ts).alias("__ts"), *[v.alias(f"__m_{n}") for n, v in measures.items()])
    aggs = []
    for w in windows:
        inside = w.contains(F.col("__ts"))
        aggs.append(F.count(F.when(inside, F.lit(1))).alias(_count_col(w.seq)))
        aggs += [exact_total(F.when(inside, F.col(f"__m_{n}"))).alias(_sum_col(n, w.seq)) for n in measures]
    return rows.groupBy(*keys).agg(*aggs)


def _running(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def long_form(
    wide: DataFrame,
    measures: Sequence[str],
    windows: Sequence[ReportWindow],
    keys: Sequence[str] = (),
    running: bool = False,
    digits: int | None = LAKH_DIGITS,
    suffix: str = "_lakh",
) -> DataFrame:
    """One row per key and window: ``keys, window_seq, window_name, <measure><suffix>...``."""
    entries = []
    ordered = sorted(windows, key=lambda w: w.seq)
    for i, w in enumerate(ordered):
        upto = ordered[: i + 1] if running else [w]
        count = _running([F.col(_count_col(u.seq)) for u in upto])
        fields = [
            F.lit(w.seq).alias("window_seq"),
            F.lit(w.name).alias("window_name"),
            count.alias("rows"),
        ]
        for m in measures:
            total = _running([F.coalesce(F.col(_sum_col(m, u.seq)), F.lit(0.0)) for u in upto])
            fields.append(to_lakh(total, digits).alias(f"{m}{suffix}") if suffix else total.alias(m))
        entries.append(F.struct(*fields))
    out = wide.select(*keys, F.inline(F.array(*entries)))
    if keys:
        out = out.filter(F.col("rows") > 0)
    return out.drop("rows")


def windowed_totals(
    df: DataFrame,
    ts: str,
    measures: Mapping[str, Column],
    windows: Sequence[ReportWindow],
    keys: Sequence[str] = (),
    exclude: Exclusion | None = None,
    running: bool = False,
    digits: int | None = LAKH_DIGITS,
    suffix: str = "_lakh",
) -> DataFrame:
    """Long per-window totals (see module doc); values scaled to lakh."""
    wide = window_sums(df, ts, measures, windows, keys, exclude)
    return long_form(wide, list(measures), windows, keys, running, digits, suffix)


def wide_form(
    wide: DataFrame,
    measures: Sequence[str],
    windows: Sequence[ReportWindow],
    keys: Sequence[str],
    running: Sequence[str] = (),
    digits: int | None = LAKH_DIGITS,
    only: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per key, a ``<measure>_<window>`` column per measure and window.

    A cell is null where the key has no rows in that window (no cell was
    published for it); measures named in ``running`` are cumulative;
    ``only`` restricts a measure to the named windows.
    """
    ordered = sorted(windows, key=lambda w: w.seq)
    cols = []
    for m in measures:
        for i, w in enumerate(ordered):
            if only and m in only and w.name not in only[m]:
                continue
            upto = ordered[: i + 1] if m in running else [w]
            present = _running([F.col(_count_col(u.seq)) for u in upto]) > 0
            total = _running([F.coalesce(F.col(_sum_col(m, u.seq)), F.lit(0.0)) for u in upto])
            cols.append(F.when(present, to_lakh(total, digits)).alias(f"{m}_{w.name}"))
    return wide.select(*keys, *cols)


def window_activity(per_invoice: DataFrame, windows: Sequence[ReportWindow], ts: str = "invoicedate") -> DataFrame:
    """Per window: its bounds, the invoices with lines in it, and the lines.

    ``per_invoice`` has one row per invoice with its number of ``lines``; one
    conditional aggregation counts both per window.
    """
    lo, hi = window_span(windows)
    rows = per_invoice.filter(F.col(ts).between(F.lit(lo), F.lit(hi)))
    aggs = []
    for w in windows:
        inside = w.contains(F.col(ts))
        aggs += [
            F.count(F.when(inside, F.lit(1))).alias(f"i{w.seq}"),
            F.coalesce(F.sum(F.when(inside, F.col("lines"))), F.lit(0)).alias(f"l{w.seq}"),
        ]
    entries = [
        F.struct(
            F.lit(w.seq).alias("window_seq"),
            F.lit(w.name).alias("window_name"),
            F.lit(w.start).alias("window_start"),
            F.lit(w.end).alias("window_end"),
            F.col(f"i{w.seq}").alias("invoices"),
            F.col(f"l{w.seq}").alias("lines"),
        )
        for w in windows
    ]
    return rows.agg(*aggs).select(F.inline(F.array(*entries)))
