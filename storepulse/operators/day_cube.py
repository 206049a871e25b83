"""Totals by day and key, from which any window of any report clock is a difference of two cells.

One scan and one aggregation give exact totals (:mod:`..functions.exact`) for every
key and day. Running them up over the days of a key turns a range sum into the
running total at the range's end less that before its start. So the reports of
many weeks need one pass over the rows, each row is added up once however many
windows hold it, and, totals being exact, a difference equals the sum over
the window's rows bit for bit.

A day has two cells, up to 23:59:59 and the second after that, because report
windows end at 23:59:59. Windows must begin at midnight UTC and end at that second.
Cells per key are bounded by the calendar, so a key holding a third of all
rows is a few hundred cells after the first, map-side aggregation.
"""

from __future__ import annotations

import datetime as dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import LAKH_DIGITS
from ..functions.dates import MICROS_PER_DAY, ReportWindow, window_span
from ..functions.economics import to_lakh
from ..functions.exact import TOTAL_TYPE, exact_total, exact_value
from ..functions.filters import all_not_null, not_excluded
from .windowed import Exclusion

_LAST_SECOND = MICROS_PER_DAY - 1_000_000
_EPOCH = dt.date(1970, 1, 1)

#: Report clocks: the instant of each report and its windows.
Clocks = Sequence[tuple[dt.datetime, Sequence[ReportWindow]]]


def _cell(ts: str) -> Column:
    """Number of the cell that holds an instant: two for each UTC day."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    day = F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")
    late = (micros - day * F.lit(MICROS_PER_DAY)) > F.lit(_LAST_SECOND)
    return day * 2 + late.cast("long")


def cell_range(window: ReportWindow) -> tuple[int, int]:
    """(last cell before the window, last cell of it)."""
    start, end = window.start, window.end
    if start.time() != dt.time(0) or end.time() != dt.time(23, 59, 59):
        raise ValueError(f"window {window.name} must run from midnight to 23:59:59, not {start} to {end}")
    return 2 * (start.date() - _EPOCH).days - 1, 2 * (end.date() - _EPOCH).days


def clock_span(clocks: Clocks) -> tuple[dt.datetime, dt.datetime]:
    return window_span([w for _, windows in clocks for w in windows])


def day_cube(
    df: DataFrame,
    ts: str,
    measures: Mapping[str, Column],
    keys: Sequence[str],
    span: tuple[dt.datetime, dt.datetime],
    exclude: Exclusion | None = None,
) -> DataFrame:
    """(keys, cell, rows, one exact total a measure); the span is a range filter that reaches the scan."""
    rows = df.filter(F.col(ts).between(F.lit(span[0]), F.lit(span[1])))
    if exclude is not None:
        rows = rows.filter(not_excluded(exclude.column, exclude.names))
    if keys:
        rows = rows.filter(all_not_null(keys))
    rows = rows.select(*keys, _cell(ts).alias("cell"), *[v.alias(f"__m_{m}") for m, v in measures.items()])
    totals = [exact_total(F.col(f"__m_{m}")).alias(m) for m in measures]
    return rows.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("rows"), *totals)


def range_totals(
    cube: DataFrame,
    clocks: Clocks,
    measures: Sequence[str],
    keys: Sequence[str] = (),
    running: bool = False,
    digits: int | None = LAKH_DIGITS,
    suffix: str = "_lakh",
) -> DataFrame:
    """(keys, as_of, window_seq, window_name, <measure><suffix>) of every clock and window.

    A keyed row is there if its window holds rows of the key; without keys every window
    has its row. ``running`` adds up each clock's windows in their order (exact totals, rounded once).
    """
    uses: dict[int, list[tuple]] = {}
    for as_of, windows in clocks:
        ordered = sorted(windows, key=lambda w: w.seq)
        for i, w in enumerate(ordered):
            before, last = cell_range(w)
            for shown in ordered[i:] if running else [w]:
                uses.setdefault(before, []).append((as_of, shown.seq, shown.name, -1))
                uses.setdefault(last, []).append((as_of, shown.seq, shown.name, 1))
    use = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(cell).cast("long").alias("cell"),
                    F.array(*[F.struct(F.lit(a).alias("as_of"), F.lit(s).alias("seq"), F.lit(n).alias("name"), F.lit(x).alias("sign")) for a, s, n, x in of]).alias("of"),
                )
                for cell, of in sorted(uses.items())
            ]
        )
    )
    spark = cube.sparkSession
    every = cube.select(*keys).distinct() if keys else spark.range(1).select()
    edges = every.select(*keys, use.alias("use")).select(*keys, "use.cell", "use.of")
    zero = {"rows": F.lit(0).cast("long"), **{m: F.lit(0).cast(TOTAL_TYPE) for m in measures}}
    edges = edges.select(*keys, "cell", "of", *[z.alias(c) for c, z in zero.items()])
    none = F.lit(None).cast(edges.schema["of"].dataType)
    cells = cube.select(*keys, "cell", none.alias("of"), "rows", *[F.coalesce(m, zero[m]).alias(m) for m in measures])
    # Up to and with all of its cell, so an edge sees the cell it names whatever the order of ties.
    upto = Window.partitionBy(*keys).orderBy("cell").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = cells.unionByName(edges).select(*keys, "of", *[F.sum(c).over(upto).alias(c) for c in zero])
    at = run.filter(F.col("of").isNotNull()).select(*keys, F.explode("of").alias("use"), *zero)
    sums = [F.sum(F.when(F.col("use.sign") > 0, F.col(c)).otherwise(-F.col(c))).alias(c) for c in zero]
    out = at.groupBy(*keys, F.col("use.as_of").alias("as_of"), F.col("use.seq").alias("window_seq"), F.col("use.name").alias("window_name")).agg(*sums)
    if keys:
        out = out.filter(F.col("rows") > 0)

    def shown(m: str) -> Column:
        total = exact_value(F.col(m))
        return to_lakh(total, digits).alias(f"{m}{suffix}") if suffix else total.alias(m)

    return out.select(*keys, "as_of", "window_seq", "window_name", *[shown(m) for m in measures])
