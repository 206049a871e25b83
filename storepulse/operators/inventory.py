"""Inventory reports over the flat narrow lot frame (``schemas.LOT_COLUMNS``).

Stock value is ``quantity * rate`` with the report scripts' quantity rule
(a credit-note lot adds its size back). Ages and expiry clocks are whole
elapsed days against the ``as_of`` instant, floored.

Grids are dense: every key (after exclusion, null keys dropped) gets all
four bucket labels, 0 where nothing falls in a bucket, even when none of the
key's lots has a bucket. They are built with one conditional aggregation per
bucket inside a single ``groupBy`` (no cross join with the label list, no
second pass), then unpivoted with ``inline`` for the long form.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import bucket_seq
from ..functions.constants import (
    AGE_BUCKET_EDGES,
    AGE_BUCKET_LABELS,
    EXCLUDED_TERRITORIES,
    LAKH_DIGITS,
    STATUS_CREDITNOTE_SCRIPT,
)
from ..functions.dates import elapsed_days, timestamp_lit
from ..functions.economics import to_lakh
from ..functions.exact import exact_sum, exact_total, exact_value
from ..functions.filters import not_excluded

#: Columns of a lot that its stock value needs.
VALUE_COLUMNS = ("status", "subqty", "soldqty", "rate")


def returned_qty(status: Column, subqty: Column, credit_note: str = STATUS_CREDITNOTE_SCRIPT) -> Column:
    """``subqty`` for a credit-note lot, else 0 (a null status is not a credit note)."""
    return F.when(status == F.lit(credit_note), subqty).otherwise(F.lit(0))


def script_quantity(status: Column, subqty: Column, soldqty: Column) -> Column:
    """Report-script rule: ``subqty - (soldqty - returned)``; a return adds stock."""
    return subqty - (soldqty - returned_qty(status, subqty, STATUS_CREDITNOTE_SCRIPT))


def with_lot_values(lots: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Add those of ``returned_qty``, ``quantity``, ``value``, ``age_days`` and ``expiry_days`` that the columns allow.

    A report asks its source for the columns it needs, so the joins behind
    the others are never planned.
    """
    now = timestamp_lit(as_of)
    st, sub, sold = F.col("status"), F.col("subqty"), F.col("soldqty")
    derived = [
        ("returned_qty", lambda: returned_qty(st, sub), {"status", "subqty"}),
        ("quantity", lambda: script_quantity(st, sub, sold), {"status", "subqty", "soldqty"}),
        ("value", lambda: script_quantity(st, sub, sold) * F.col("rate"), {"status", "subqty", "soldqty", "rate"}),
        ("age_days", lambda: elapsed_days(now, F.col("invoicedate")), {"invoicedate"}),
        ("expiry_days", lambda: elapsed_days(F.col("expirydate"), now), {"expirydate"}),
    ]
    have = set(lots.columns)
    return lots.select("*", *[make().alias(n) for n, make, needs in derived if needs <= have])


def lot_values(lots: DataFrame, as_of: dt.datetime, excluded: Sequence[str] | None = EXCLUDED_TERRITORIES) -> DataFrame:
    """Per-lot quantity and stock value after the territory exclusion."""
    kept = lots if excluded is None else lots.filter(not_excluded("territory", excluded))
    return with_lot_values(kept, as_of)


def lot_cube(lots: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Stock value by age and by expiry bucket, and of expired lots, at the grain of category, store and territory.

    One scan of the lots that serves every grid and both expired reports,
    which take it in place of the lots.
    """
    valued = with_lot_values(lots, as_of)
    sums = []
    for name, days, open_low in (("age_days", "age_days", False), ("expiry_days", "expiry_days", True)):
        seq = bucket_seq(F.col(days), AGE_BUCKET_EDGES, open_low=open_low)
        sums += [exact_total(F.when(seq == F.lit(i + 1), F.col("value"))).alias(f"{name}__b{i + 1}") for i in range(len(AGE_BUCKET_LABELS))]
    expired = F.col("expiry_days") <= F.lit(0)
    sums += [exact_total(F.when(expired, F.col("value"))).alias("expired__value"), F.count(F.when(expired, F.lit(1))).alias("expired__rows")]
    return valued.groupBy("category", "store", "territory").agg(*sums)


def _grid_wide(lots: DataFrame, as_of: dt.datetime, key: str, days: str, open_low: bool, edges, labels) -> DataFrame:
    if f"{days}__b1" in lots.columns:  # a lot_cube
        parts = [exact_value(F.sum(f"{days}__b{i + 1}")) for i in range(len(labels))]
    else:
        lots = with_lot_values(lots, as_of)
        seq = bucket_seq(F.col(days), edges, open_low=open_low)
        parts = [exact_sum(F.when(seq == F.lit(i + 1), F.col("value"))) for i in range(len(labels))]
    aggs = [F.coalesce(p, F.lit(0.0)).alias(f"b{i + 1}") for i, p in enumerate(parts)]
    return lots.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def _grid_long(wide: DataFrame, key: str, labels: Sequence[str], digits, name: str) -> DataFrame:
    entries = [
        F.struct(
            F.lit(i + 1).alias("bucket_seq"),
            F.lit(label).alias("bucket"),
            to_lakh(F.col(f"b{i + 1}"), digits).alias(name),
        )
        for i, label in enumerate(labels)
    ]
    return wide.select(key, F.inline(F.array(*entries)))


def _value_grid(
    lots: DataFrame,
    as_of: dt.datetime,
    key: str,
    days_col: str,
    open_low: bool,
    excluded: Sequence[str] | None,
    labels: Sequence[str],
    edges: Sequence[float],
    digits,
    wide: bool,
) -> DataFrame:
    kept = lots if excluded is None else lots.filter(not_excluded("territory", excluded))
    grid = _grid_wide(kept, as_of, key, days_col, open_low, edges, labels)
    if wide:
        names = [_label_column(l) for l in labels]
        return grid.select(key, *[to_lakh(F.col(f"b{i + 1}"), digits).alias(n) for i, n in enumerate(names)])
    return _grid_long(grid, key, labels, digits, "value_lakh")


def _label_column(label: str) -> str:
    text = label.replace(" days", "").replace("+", "_plus").replace("-", "_")
    return f"days_{text}"


def inventory_age_grid(
    lots: DataFrame,
    as_of: dt.datetime,
    key: str = "category",
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    labels: Sequence[str] = AGE_BUCKET_LABELS,
    edges: Sequence[float] = AGE_BUCKET_EDGES,
    digits: int | None = LAKH_DIGITS,
    wide: bool = False,
) -> DataFrame:
    """Stock value by key and age bucket (age since invoice, bins ``(1,45]...``).

    Long: ``key, bucket_seq, bucket, value_lakh``; ``wide=True`` gives one
    column per bucket. A lot aged 1 day or less (or undated) has no bucket.
    """
    return _value_grid(lots, as_of, key, "age_days", False, excluded, labels, edges, digits, wide)


def expiry_grid(
    lots: DataFrame,
    as_of: dt.datetime,
    key: str = "category",
    excluded: Sequence[str] | None = None,
    labels: Sequence[str] = AGE_BUCKET_LABELS,
    edges: Sequence[float] = AGE_BUCKET_EDGES,
    digits: int | None = LAKH_DIGITS,
    wide: bool = False,
) -> DataFrame:
    """Stock value by key and days-to-expiry bucket; the first bin is open below,
    so expired stock falls in it. No exclusion by default."""
    return _value_grid(lots, as_of, key, "expiry_days", True, excluded, labels, edges, digits, wide)


def expired_value(
    lots: DataFrame,
    as_of: dt.datetime,
    key: str = "category",
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    digits: int | None = LAKH_DIGITS,
) -> DataFrame:
    """Value of expired stock (expiry clock <= 0 whole days) per key.

    A lot expiring within the next 24 hours counts as expired; a lot without
    an expiry date does not. Keys with no expired lot have no row.
    """
    kept = lots if excluded is None else lots.filter(not_excluded("territory", excluded))
    if "expired__rows" in kept.columns:  # a lot_cube
        expired = kept.filter(F.col("expired__rows") > 0)
        total = exact_value(F.sum("expired__value"))
    else:
        expired = with_lot_values(kept, as_of).filter(F.col("expiry_days") <= F.lit(0))
        total = exact_sum(F.col("value"))
    total = F.coalesce(total, F.lit(0.0))
    return expired.filter(F.col(key).isNotNull()).groupBy(key).agg(to_lakh(total, digits).alias("expired_lakh"))
