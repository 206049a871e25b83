"""Distinct-customer counts over the invoice frame.

Counts are exact (``count(DISTINCT name)``). Spark plans the grouped form as
a dedup on ``(territory, name)`` followed by a count per territory, so the
first shuffle is spread by customer name and a territory holding a third of
all invoices does not land in one task. The grand total is not the sum of
the territory counts: invoices without a territory count there, and a
customer seen in two territories counts once.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import EXCLUDED_TERRITORIES
from ..functions.filters import not_excluded


def _kept(invoices: DataFrame, excluded: Sequence[str] | None) -> DataFrame:
    return invoices if excluded is None else invoices.filter(not_excluded("territory", excluded))


def customers_by_territory(
    invoices: DataFrame,
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    name_col: str = "customer",
    approximate: bool = False,
) -> DataFrame:
    """``territory, customers`` for every non-null territory left after exclusion."""
    kept = _kept(invoices, excluded).filter(F.col("territory").isNotNull())
    count = F.approx_count_distinct(name_col) if approximate else F.countDistinct(name_col)
    return kept.groupBy("territory").agg(count.alias("customers"))


def customers_total(
    invoices: DataFrame,
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    name_col: str = "customer",
    approximate: bool = False,
) -> DataFrame:
    """One row, ``customers``: distinct names over all kept invoices."""
    count = F.approx_count_distinct(name_col) if approximate else F.countDistinct(name_col)
    return _kept(invoices, excluded).agg(count.alias("customers"))


def customers_summary(
    invoices: DataFrame,
    excluded: Sequence[str] | None = EXCLUDED_TERRITORIES,
    name_col: str = "customer",
) -> DataFrame:
    """``territory, is_total, customers``: every territory's distinct names and the grand total, from one scan.

    One shuffle, by name, leaves each name once with its set of territories; a
    set holds at most the territories there are, and is built map side first. What
    follows adds up ones, a row per territory and task.
    """
    named = _kept(invoices, excluded).filter(F.col(name_col).isNotNull())
    names = named.groupBy(name_col).agg(F.collect_set("territory").alias("territories"))
    # A set holds no nulls, so the null that stands for the total is its own.
    places = F.explode(F.concat(F.transform("territories", lambda t: F.struct(t.alias("territory"), F.lit(False).alias("is_total"))),
                                F.array(F.struct(F.lit(None).cast("string").alias("territory"), F.lit(True).alias("is_total")))))
    counted = names.select(places.alias("p")).groupBy("p.territory", "p.is_total").agg(F.count(F.lit(1)).alias("customers"))
    return counted.select("territory", "is_total", "customers")
