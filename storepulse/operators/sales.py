"""Sales, margin, purchase and target reports over the reporting windows.

Every report is one call of :func:`windowed.windowed_totals` over the flat
sale-line frame (``schemas.LINE_COLUMNS``) or the flat target frame
(``schemas.TARGETS``). Which reports drop the excluded territories is part
of their contract and mirrors the original job:

=====================  ==========  =====================================
report                 exclusion   measure
=====================  ==========  =====================================
totals (summary)       none        sale value, target, margin, purchase
by category            territory   margin (per window and running),
                                   sale value; target excludes on ``TM``
by store               territory   sale value, margin (fy window only);
                                   target: none
by territory           territory   sale value, margin; target: none
=====================  ==========  =====================================
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import economics as econ
from ..functions.constants import EXCLUDED_TERRITORIES, LAKH_DIGITS
from ..functions.dates import ReportWindow
from .day_cube import Clocks, clock_span, day_cube, range_totals
from .windowed import Exclusion, window_cube, windowed_totals, window_sums, wide_form

SALE_TS = "invoicedate"
TARGET_TS = "Date"

# Columns each measure reads from the line frame (lets sources prune joins).
MEASURE_COLUMNS = {
    "achieved": ("soldqty", "sellingprice", "servicecharge", "gst"),
    "purchase": ("soldqty", "rate"),
    "margin": (
        "soldqty",
        "sellingprice",
        "servicecharge",
        "gst",
        "rate",
        "discount",
        "cn_stock",
        "subqty",
        "transport_charges",
        "other_charges",
    ),
}

TARGET_KEYS = {"category": "Category", "store": "Store", "territory": "TM"}


def line_columns(measures: Sequence[str], key: str | None = None, exclude: bool = False) -> list[str]:
    """Line columns a report needs, for ``tables.sale_lines(columns=...)``."""
    cols = {SALE_TS}
    for m in measures:
        cols.update(MEASURE_COLUMNS[m])
    if key:
        cols.add(key)
    if exclude:
        cols.add("territory")
    return sorted(cols)


def _measures(*names: str):
    exprs = {"achieved": econ.sale_value(), "purchase": econ.purchase_gross(), "margin": econ.margin()}
    return {n: exprs[n] for n in names}


def _exclusion(column: str, names: Sequence[str] | None) -> Exclusion | None:
    if names is None:
        return None
    return Exclusion(column, tuple(names))


def line_cube(lines: DataFrame, windows: Sequence[ReportWindow]) -> DataFrame:
    """Every line measure by category, store, territory and window; the reports below take it in place of the lines."""
    return window_cube(lines, SALE_TS, _measures("achieved", "margin", "purchase"), windows, ["category", "store", "territory"])


def target_cube(targets: DataFrame, windows: Sequence[ReportWindow]) -> DataFrame:
    """Targets by category, store, territory and window, in place of the targets."""
    return window_cube(targets, TARGET_TS, {"target": F.col("Daily_Target")}, windows, ["Category", "Store", "TM"])


# --- whole-business totals ------------------------------------------------------

def achieved_revenue(lines: DataFrame, windows: Sequence[ReportWindow], digits: int | None = LAKH_DIGITS) -> DataFrame:
    """Sale value per window, no exclusion: ``window_seq, window_name, achieved_lakh``."""
    return windowed_totals(lines, SALE_TS, _measures("achieved"), windows, digits=digits)


def achieved_purchase(lines: DataFrame, windows: Sequence[ReportWindow], digits: int | None = LAKH_DIGITS) -> DataFrame:
    """Gross purchase value (``soldqty * rate``) per window: ``purchase_lakh``."""
    return windowed_totals(lines, SALE_TS, _measures("purchase"), windows, digits=digits)


def actual_margin(lines: DataFrame, windows: Sequence[ReportWindow], digits: int = LAKH_DIGITS) -> DataFrame:
    """Margin per window: numeric ``margin_lakh`` and the published text ``margin_text``."""
    out = windowed_totals(lines, SALE_TS, _measures("margin"), windows, digits=digits)
    return out.withColumn("margin_text", econ.as_percent_text(F.col("margin_lakh"), digits))


def target_revenue(targets: DataFrame, windows: Sequence[ReportWindow], digits: int | None = LAKH_DIGITS) -> DataFrame:
    """Daily targets summed per window, no exclusion: ``target_lakh``."""
    return windowed_totals(targets, TARGET_TS, {"target": F.col("Daily_Target")}, windows, digits=digits)


def sales_summary(lines: DataFrame, targets: DataFrame, windows: Sequence[ReportWindow]) -> DataFrame:
    """Target, achieved, margin and purchase per window side by side.

    One aggregation over the lines for the three line measures, one over
    the targets; the two three-row results are combined by window without
    a join (union, then a grouped ``first``).
    """
    sales = windowed_totals(lines, SALE_TS, _measures("achieved", "margin", "purchase"), windows)
    tgt = target_revenue(targets, windows)
    both = sales.unionByName(tgt, allowMissingColumns=True)
    return both.groupBy("window_seq", "window_name").agg(
        F.first("target_lakh", ignorenulls=True).alias("target_lakh"),
        F.first("achieved_lakh", ignorenulls=True).alias("achieved_lakh"),
        F.first("margin_lakh", ignorenulls=True).alias("margin_lakh"),
        econ.as_percent_text(F.first("margin_lakh", ignorenulls=True)).alias("margin_text"),
        F.first("purchase_lakh", ignorenulls=True).alias("purchase_lakh"),
    )


# --- keyed reports -----------------------------------------------------------

def achieved_by(
    lines: DataFrame,
    windows: Sequence[ReportWindow],
    key: str,
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    digits: int | None = LAKH_DIGITS,
) -> DataFrame:
    """Sale value per ``key`` (category, store or territory) and window."""
    return windowed_totals(
        lines, SALE_TS, _measures("achieved"), windows, keys=[key], exclude=_exclusion("territory", excluded), digits=digits
    )


def margin_by(
    lines: DataFrame,
    windows: Sequence[ReportWindow],
    key: str,
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    running: bool = False,
    digits: int | None = LAKH_DIGITS,
) -> DataFrame:
    """Margin per ``key`` and window; ``running=True`` accumulates over windows."""
    return windowed_totals(
        lines,
        SALE_TS,
        _measures("margin"),
        windows,
        keys=[key],
        exclude=_exclusion("territory", excluded),
        running=running,
        digits=digits,
    )


def store_margin_fy(
    lines: DataFrame,
    windows: Sequence[ReportWindow],
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    digits: int | None = LAKH_DIGITS,
) -> DataFrame:
    """Margin per store over the fiscal-year window only."""
    fy = [w for w in windows if w.name == "fy"] or [max(windows, key=lambda w: w.seq)]
    return margin_by(lines, fy, "store", excluded, digits=digits)


def target_by(
    targets: DataFrame,
    windows: Sequence[ReportWindow],
    key: str,
    excluded: Sequence[str] | None = None,
    digits: int | None = LAKH_DIGITS,
) -> DataFrame:
    """Daily targets per ``key`` and window; the category report excludes on ``TM``."""
    col = TARGET_KEYS[key]
    out = windowed_totals(
        targets,
        TARGET_TS,
        {"target": F.col("Daily_Target")},
        windows,
        keys=[col],
        exclude=_exclusion("TM", excluded),
        digits=digits,
    )
    return out.withColumnRenamed(col, key)


# --- several report clocks -------------------------------------------------------

def history(
    lines: DataFrame,
    clocks: Clocks,
    measures: Sequence[str],
    key: str | None = None,
    excluded: Sequence[str] | None = None,
    running: bool = False,
    digits: int | None = LAKH_DIGITS,
) -> DataFrame:
    """Line measures of every window of several reports (``as_of``), by ``key`` if given, from one day cube."""
    keys = [key] if key else []
    cube = day_cube(lines, SALE_TS, _measures(*measures), keys, clock_span(clocks), _exclusion("territory", excluded))
    return range_totals(cube, clocks, list(measures), keys, running, digits)


def target_history(
    targets: DataFrame, clocks: Clocks, key: str, excluded: Sequence[str] | None = None, digits: int | None = LAKH_DIGITS
) -> DataFrame:
    """Targets by ``key`` of every window of several reports, from one day cube."""
    col = TARGET_KEYS[key]
    cube = day_cube(targets, TARGET_TS, {"target": F.col("Daily_Target")}, [col], clock_span(clocks), _exclusion("TM", excluded))
    return range_totals(cube, clocks, ["target"], [col], digits=digits).withColumnRenamed(col, key)


# --- wide scorecards ------------------------------------------------------------

def _merge_wide(frames: Sequence[DataFrame], key: str) -> DataFrame:
    merged = frames[0]
    for f in frames[1:]:
        merged = merged.unionByName(f, allowMissingColumns=True)
    value_cols = [c for c in merged.columns if c != key]
    return merged.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in value_cols])


def scorecard(
    lines: DataFrame,
    targets: DataFrame,
    windows: Sequence[ReportWindow],
    key: str,
    excluded: Sequence[str] = EXCLUDED_TERRITORIES,
) -> DataFrame:
    """Target, achieved and margin side by side per key, one column per window.

    Layouts follow the published sheets: the category card shows the
    running margin and targets without the excluded territories; the store
    card shows the fiscal-year margin only; the territory card shows margin
    per window. Achieved and margin always exclude the listed territories.
    Both line measures come from one aggregation; the target aggregate is
    merged by key without a join.
    """
    exclude = Exclusion("territory", tuple(excluded))
    running = ["margin"] if key == "category" else []
    only = {"margin": ["fy"]} if key == "store" else None
    sales_wide = window_sums(lines, SALE_TS, _measures("achieved", "margin"), windows, [key], exclude)
    parts = [wide_form(sales_wide, ["achieved", "margin"], windows, [key], running=running, only=only)]
    tcol = TARGET_KEYS[key]
    t_exclude = Exclusion("TM", tuple(excluded)) if key == "category" else None
    tgt_wide = window_sums(targets, TARGET_TS, {"target": F.col("Daily_Target")}, windows, [tcol], t_exclude)
    tgt = wide_form(tgt_wide, ["target"], windows, [tcol]).withColumnRenamed(tcol, key)
    merged = _merge_wide([tgt, *parts], key)
    order = [f"{m}_{w.name}" for w in sorted(windows, key=lambda w: w.seq) for m in ("target", "achieved", "margin")]
    cols = [c for c in order if c in merged.columns]
    return merged.select(key, *cols)
