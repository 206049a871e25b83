"""Enriched inventory lot table (the BI model) and its roll-ups.

Input is the flat wide lot frame (``schemas.LOT_WIDE_COLUMNS``). Every
derived column is a built-in expression evaluated per row inside one
projection, except the value-weighted age, which divides by the total stock
value of the whole table. That total is a scalar subquery (``.scalar()``):
Spark runs it as one small aggregate job and inlines the single number, so
no join, no window over the whole table and nothing moves to one task.

Model rules differ from the report scripts on purpose: a credit note is
spelled ``CreditNote`` and removes stock, ages are calendar-day differences,
and the expiry clock only runs for lots whose status mentions ``Stock``
(other lots read 0, so they count as "Expired").
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import before_last_space, expiry_band_label, expiry_band_seq, fiscal_year_label
from ..functions.constants import FISCAL_YEAR_FIRST, FISCAL_YEAR_LAST, STATUS_CREDITNOTE_MODEL, STATUS_STOCK_MARKER
from ..functions.dates import as_utc
from ..functions.economics import clean_double
from ..functions.exact import exact_sum

# The published column names, in their order.
MODEL_COLUMNS = (
    "_id",
    "id",
    "createddate",
    "receiveddate",
    "dateofmanufacturing",
    "expirydate",
    "gst_pct",
    "purchasingprice_unit_xgst",
    "sellingprice_unit_igst",
    "sellingprice_unit_xgst",
    "subqty",
    "soldqty",
    "status",
    "cnStockproduct",
    "transportCharges",
    "otherCharges",
    "store_ref",
    "invoiceno",
    "invoicedate",
    "po_ref",
    "invoice_amount",
    "invoice_amount_xgst",
    "product_name",
    "category_name",
    "sub_category_name",
    "manufacturer_name",
    "supplier_id",
    "supplier_name",
    "supplier_gstnumber",
    "fiscal_year",
    "returned_qty",
    "available_qty",
    "current_inventory_value",
    "sold_inventory_value",
    "returned_inventory",
    "inventory_age_days",
    "inventory_age_weeks",
    "inventory_age_months",
    "store",
    "vertical",
    "landingrate",
    "expiry_clock",
    "expiry_clock_stock",
    "expiry_filter",
    "exp_seq",
    "first_store_name",
    "average_inventory_age",
    "cndiff",
    "current_inventory_selling_price",
    "invoicedate_relationship",
)


# First and last starting year of a labelled fiscal year.
FISCAL_YEARS = (FISCAL_YEAR_FIRST, FISCAL_YEAR_LAST)


def _today(as_of: dt.datetime | dt.date):
    return F.lit(as_utc(as_of).date())


def _derived(as_of: dt.datetime | dt.date, fiscal_years: tuple[int, int]):
    """Derived model columns in two steps: (name, expression, columns it reads)."""
    today = _today(as_of)
    price = clean_double(F.col("purchasingprice_unit_xgst"))
    st, sub, sold = F.col("status"), F.col("subqty"), F.col("soldqty")
    returned = _returned(st, sub)
    clock = F.datediff(F.to_date("expirydate"), today).cast("long")
    is_stock = F.coalesce(st.contains(STATUS_STOCK_MARKER), F.lit(False))
    band = expiry_band_seq(F.col("expiry_clock_stock"))
    first = [
        ("sellingprice_unit_xgst",
         F.col("sellingprice_unit_igst") / (F.lit(1.0) + F.col("gst_pct") / F.lit(100.0)),
         {"sellingprice_unit_igst", "gst_pct"}),
        ("fiscal_year", fiscal_year_label(F.col("invoicedate"), *fiscal_years), {"invoicedate"}),
        ("returned_qty", returned.cast("double"), {"status", "subqty"}),
        ("available_qty", _available(st, sub, sold), {"status", "subqty", "soldqty"}),
        ("inventory_age_days", F.datediff(today, F.to_date("invoicedate")).cast("long"), {"invoicedate"}),
        ("expiry_clock", clock, {"expirydate"}),
        ("expiry_clock_stock", F.when(is_stock, clock).otherwise(F.lit(0).cast("long")), {"status", "expirydate"}),
    ]
    second = [
        ("current_inventory_value", F.col("available_qty") * price, {"available_qty", "purchasingprice_unit_xgst"}),
        ("sold_inventory_value", F.col("soldqty") * price, {"soldqty", "purchasingprice_unit_xgst"}),
        ("returned_inventory", F.col("returned_qty") * price, {"returned_qty", "purchasingprice_unit_xgst"}),
        ("inventory_age_weeks", F.col("inventory_age_days") / F.lit(7.0), {"inventory_age_days"}),
        ("inventory_age_months", F.col("inventory_age_days") / F.lit(30.0), {"inventory_age_days"}),
        ("expiry_filter", expiry_band_label(band), {"expiry_clock_stock"}),
        ("exp_seq", band, {"expiry_clock_stock"}),
        ("first_store_name", before_last_space(F.col("store")), {"store"}),
        ("cndiff", price * F.col("subqty") - F.col("cnStockproduct"),
         {"purchasingprice_unit_xgst", "subqty", "cnStockproduct"}),
        ("current_inventory_selling_price", F.col("available_qty") * F.col("sellingprice_unit_xgst"),
         {"available_qty", "sellingprice_unit_xgst"}),
        ("invoicedate_relationship", F.to_date("invoicedate"), {"invoicedate"}),
    ]
    return first, second


def lot_model_rows(lots: DataFrame, as_of: dt.datetime | dt.date, fiscal_years: tuple[int, int] = FISCAL_YEARS) -> DataFrame:
    """Every per-row column of the model (all but the weighted age).

    Given only some of the wide lot columns, it derives just the columns
    those inputs allow, so a roll-up can ask its source for a few columns
    and skip the joins the rest would need.
    """
    first, second = _derived(as_of, fiscal_years)
    have = set(lots.columns)
    step1 = lots.select("*", *[e.alias(n) for n, e, needs in first if needs <= have])
    have = set(step1.columns)
    return step1.select("*", *[e.alias(n) for n, e, needs in second if needs <= have])


# Wide lot columns each roll-up reads.
BAND_INPUTS = ("purchasingprice_unit_xgst", "status", "subqty", "soldqty", "expirydate")
FISCAL_YEAR_INPUTS = ("purchasingprice_unit_xgst", "status", "subqty", "soldqty", "invoicedate")
WEIGHTED_AGE_INPUTS = ("purchasingprice_unit_xgst", "status", "subqty", "soldqty", "invoicedate", "category_name")


# Columns the stock-value total needs (a source may build just these).
TOTAL_COLUMNS = ("purchasingprice_unit_xgst", "subqty", "soldqty", "status")


def _returned(status, subqty):
    return F.when(status == F.lit(STATUS_CREDITNOTE_MODEL), subqty).otherwise(F.lit(0))


def _available(status, subqty, soldqty):
    """BI-model rule: a return removes stock."""
    return (subqty - (soldqty + _returned(status, subqty))).cast("long")


# Exact type for the whole-table total: a decimal sum does not depend on the
# order rows are added in, so the weighted ages do not change with the
# partitioning (or AQE's coalescing) of a run.
TOTAL_TYPE = "decimal(38,6)"


def stock_value_total(lots: DataFrame):
    """Scalar subquery: total current stock value of all lots (model rules), as a double."""
    value = _available(F.col("status"), F.col("subqty"), F.col("soldqty")) * clean_double(
        F.col("purchasingprice_unit_xgst")
    )
    return lots.select(F.sum(value.cast(TOTAL_TYPE)).cast("double")).scalar()


def lot_model(
    lots: DataFrame,
    as_of: dt.datetime | dt.date,
    total_from: DataFrame | None = None,
    fiscal_years: tuple[int, int] = FISCAL_YEARS,
) -> DataFrame:
    """The enriched lot table, ``MODEL_COLUMNS`` in order (those ``lots`` allows).

    ``total_from`` may give the same lots with only ``TOTAL_COLUMNS`` (so
    the total's pass skips joins the total does not need); by default the
    total is taken over ``lots``.
    """
    rows = lot_model_rows(lots, as_of, fiscal_years)
    total = stock_value_total(total_from if total_from is not None else lots)
    return with_weighted_age(rows, total)


def with_weighted_age(rows: DataFrame, total) -> DataFrame:
    """Add ``average_inventory_age`` (value-weighted age share) to model rows."""
    weighted = F.try_divide(
        F.col("purchasingprice_unit_xgst") * F.col("inventory_age_days") * F.col("available_qty"), total
    )
    out = rows.withColumn("average_inventory_age", weighted)
    return out.select(*[c for c in MODEL_COLUMNS if c in out.columns])


def expiry_bands(model: DataFrame) -> DataFrame:
    """Lots, units and stock value per expiry band (``exp_seq``, ``expiry_filter``)."""
    return model.groupBy("exp_seq", "expiry_filter").agg(
        F.count(F.lit(1)).alias("lots"),
        F.sum("available_qty").alias("available_qty"),
        F.round(exact_sum(F.col("current_inventory_value")), 2).alias("current_inventory_value"),
    )


def fiscal_year_summary(model: DataFrame) -> DataFrame:
    """Lots and stock value per fiscal-year label of the invoice date."""
    return model.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("lots"),
        F.round(exact_sum(F.col("current_inventory_value")), 2).alias("current_inventory_value"),
        F.round(exact_sum(F.col("sold_inventory_value")), 2).alias("sold_inventory_value"),
    )


def weighted_age(model: DataFrame, key: str = "category_name") -> DataFrame:
    """Value-weighted inventory age (days) contributed by each key.

    Summing ``average_inventory_age`` over all lots gives the portfolio's
    value-weighted age; per key it is that key's share of it.
    """
    return model.groupBy(key).agg(
        F.round(exact_sum(F.col("average_inventory_age")), 6).alias("weighted_age_days"),
        F.round(exact_sum(F.col("current_inventory_value")), 2).alias("current_inventory_value"),
    )
