"""Registered report queries over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns the report frame for the
fixture clock and exclusion list below (``FIXTURES.md`` section 3). The
frames are lazy; nothing is collected here.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import economics as econ
from ..functions.dates import UTC, ReportWindow, reporting_windows
from ..functions.exact import exact_sum
from ..operators import customers, inventory, lot_model, sales, windowed
from ..sources import readers, rejects, schemas, tables

# --- fixed values of the fixture run -------------------------------------------
FIXTURE_AS_OF = dt.datetime(2001, 8, 1, 12, 0, 0, tzinfo=UTC)
FIXTURE_END_POLICY = "main"
FIXTURE_FISCAL_YEARS = (1996, 2000)
FIXTURE_EXCLUDED = ("NATION_0", "NATION_6", "NATION_12", "NATION_18", "NATION_24")


def fixture_windows() -> list[ReportWindow]:
    return reporting_windows(FIXTURE_AS_OF, FIXTURE_END_POLICY)


def present(df: DataFrame) -> DataFrame:
    """Output timestamps as zone-less wall-clock UTC (same as the source tables)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _lines(spark, sf, measures, key=None, exclude=False):
    return tables.sale_lines(spark, sf, sales.line_columns(measures, key, exclude))


# --- B02 / B03 -----------------------------------------------------------------

def report_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Per window: its bounds, invoices with lines in it, and lines."""
    return present(windowed.window_activity(tables.order_line_counts(spark, sf), fixture_windows()))


def sale_line_economics(spark: SparkSession, sf: str) -> DataFrame:
    """Every sale line with its economics."""
    lines = tables.sale_lines(spark, sf)
    return lines.select(
        "invoice_id",
        "store",
        "territory",
        "category",
        "soldqty",
        econ.sale_value().alias("sale_value"),
        econ.sale_value_line_rate().alias("sale_value_line_rate"),
        econ.purchase_net().alias("purchase_net"),
        econ.purchase_gross().alias("purchase_gross"),
        econ.margin().alias("margin"),
    )


# --- B01: extracts, built from the tables in the plan and read by the extract frames ---

def extract_sale_lines(spark, sf):
    """Nested sales documents, exploded into lines."""
    lines = readers.sale_lines_frame(tables.invoices(spark, sf), "invoiceno")
    return present(lines.withColumn("invoice_id", F.col("invoice_id").cast("long")))


def extract_invoices(spark, sf):
    """Invoice attributes from the headers of the sales documents, one row per invoice."""
    docs = readers.complete(tables.invoices(spark, sf, lines=False), readers.IDENTITY["sales"], "sales")
    rows = readers.invoice_frame(docs.withColumn("_id", F.col("invoiceno")))
    return present(rows.withColumn("invoice_id", F.col("invoice_id").cast("long")))


def extract_documents(spark, sf):
    """Per invoice: its documents, their lines and its most lines in one, and the lines after they are put together again."""
    docs = tables.invoices(spark, sf)
    whole = readers.reassembled(docs).select(F.col("invoiceno").alias("no"), F.size("product").alias("reassembled_lines"))
    parts = docs.groupBy("invoiceno").agg(
        F.countDistinct("_id").alias("documents"), F.sum(F.size("product")).alias("lines"), F.max(F.size("product")).alias("most_lines")
    )
    return parts.join(whole, F.col("invoiceno") == F.col("no")).select("invoiceno", "documents", "lines", "most_lines", "reassembled_lines")


def extract_rejects(spark, sf):
    """Records of extracts with planted faults by reason (null: accepted); a null rate is no fault."""
    sales_docs = readers.identified(tables.faulty_invoices(spark, sf), readers.IDENTITY["sales"], "sales")
    found = [
        rejects.counts(df, readers.reject_rules(name)).select(F.lit(name).alias("extract"), rejects.REASON, "records")
        for name, df in (("sales", sales_docs), ("lots", tables.faulty_lots(spark, sf)))
    ]
    return found[0].unionByName(found[1])


def extract_accepted_value(spark, sf):
    """Stock value by category of the accepted lots of an extract with planted faults; null rates are skipped."""
    lots = rejects.accepted(tables.faulty_lots(spark, sf), readers.reject_rules("lots"))
    frame = inventory.with_lot_values(readers.lots_frame(lots, strict=False), FIXTURE_AS_OF)
    return frame.groupBy("category").agg(
        F.count(F.lit(1)).alias("lots"), F.count("value").alias("valued"), econ.to_lakh(exact_sum(F.col("value"))).alias("value_lakh")
    )


def extract_targets(spark, sf):
    """Targets from response envelopes held as text."""
    texts = tables.target_envelopes(spark, sf, "targets")
    rows = readers.targets_frame(readers.parse_responses(texts, schemas.TARGETS, "targets"))
    return present(rows.withColumn("Daily_Target", F.round("Daily_Target", 4)))


def extract_lots(spark, sf):
    """Nested narrow lots with invoice dates in mixed text layouts."""
    return present(readers.lots_frame(tables.lot_documents(spark, sf)))


def extract_lots_wide(spark, sf):
    """Nested BI lots with fractional quantities, expanded and converted."""
    return present(readers.lots_wide_frame(tables.lot_documents_wide(spark, sf)))


def totals_unrounded(spark, sf):
    """Achieved sale value per window in lakh, as computed, and as percent text at a large scale."""
    lines = _lines(spark, sf, ["achieved"])
    out = sales.achieved_revenue(lines, fixture_windows(), digits=None)
    big = econ.as_percent_text(F.round(F.col("achieved_lakh")) * F.lit(1e6) + F.lit(0.25))
    return out.select("window_seq", "window_name", F.round("achieved_lakh", 4).alias("achieved_lakh_4"), big.alias("scaled_text"))


# --- B04-B07: totals -------------------------------------------------------------

def achieved_revenue_by_window(spark, sf):
    return sales.achieved_revenue(_lines(spark, sf, ["achieved"]), fixture_windows())


def target_revenue_by_window(spark, sf):
    return sales.target_revenue(tables.targets(spark, sf), fixture_windows())


def actual_margin_by_window(spark, sf):
    return sales.actual_margin(_lines(spark, sf, ["margin"]), fixture_windows())


def achieved_purchase_by_window(spark, sf):
    return sales.achieved_purchase(_lines(spark, sf, ["purchase"]), fixture_windows())


def sales_summary(spark, sf):
    lines = _lines(spark, sf, ["achieved", "margin", "purchase"])
    return sales.sales_summary(lines, tables.targets(spark, sf), fixture_windows())


# --- B08-B11: keyed ------------------------------------------------------------

def category_margin(spark, sf):
    lines = _lines(spark, sf, ["margin"], "category", True)
    return sales.margin_by(lines, fixture_windows(), "category", FIXTURE_EXCLUDED)


def category_margin_running(spark, sf):
    lines = _lines(spark, sf, ["margin"], "category", True)
    return sales.margin_by(lines, fixture_windows(), "category", FIXTURE_EXCLUDED, running=True)


def category_achieved(spark, sf):
    lines = _lines(spark, sf, ["achieved"], "category", True)
    return sales.achieved_by(lines, fixture_windows(), "category", FIXTURE_EXCLUDED)


def category_target(spark, sf):
    return sales.target_by(tables.targets(spark, sf), fixture_windows(), "category", FIXTURE_EXCLUDED)


def store_achieved(spark, sf):
    lines = _lines(spark, sf, ["achieved"], "store", True)
    return sales.achieved_by(lines, fixture_windows(), "store", FIXTURE_EXCLUDED)


def store_margin_fy(spark, sf):
    lines = _lines(spark, sf, ["margin"], "store", True)
    return sales.store_margin_fy(lines, fixture_windows(), FIXTURE_EXCLUDED)


def store_target(spark, sf):
    return sales.target_by(tables.targets(spark, sf), fixture_windows(), "store")


def territory_margin(spark, sf):
    lines = _lines(spark, sf, ["margin"], "territory", True)
    return sales.margin_by(lines, fixture_windows(), "territory", FIXTURE_EXCLUDED)


def territory_achieved(spark, sf):
    lines = _lines(spark, sf, ["achieved"], "territory", True)
    return sales.achieved_by(lines, fixture_windows(), "territory", FIXTURE_EXCLUDED)


def territory_target(spark, sf):
    return sales.target_by(tables.targets(spark, sf), fixture_windows(), "territory")


# --- several report clocks in one pass ---------------------------------------------------

#: Weekly reports that the history queries give, the fixture's clock the last.
HISTORY_WEEKS = 8


def history_clocks(weeks: int = HISTORY_WEEKS) -> list[tuple[dt.datetime, list[ReportWindow]]]:
    clocks = [FIXTURE_AS_OF - dt.timedelta(weeks=k) for k in reversed(range(weeks))]
    return [(c, reporting_windows(c, FIXTURE_END_POLICY)) for c in clocks]


def sales_history(spark, sf):
    """Achieved, margin and purchase of the windows of several weekly reports, from one scan."""
    lines, clocks = _lines(spark, sf, ["achieved", "margin", "purchase"]), history_clocks()
    return present(sales.history(lines, clocks, ["achieved", "margin", "purchase"]))


def category_history(spark, sf):
    """Achieved by category for several weekly reports, from one scan."""
    lines = _lines(spark, sf, ["achieved"], "category", True)
    return present(sales.history(lines, history_clocks(), ["achieved"], "category", FIXTURE_EXCLUDED))


def category_margin_history(spark, sf):
    """Running margin by category for several weekly reports, from one scan."""
    lines = _lines(spark, sf, ["margin"], "category", True)
    return present(sales.history(lines, history_clocks(), ["margin"], "category", FIXTURE_EXCLUDED, running=True))


def store_target_history(spark, sf):
    """Targets by store for several weekly reports, from one scan."""
    return present(sales.target_history(tables.targets(spark, sf), history_clocks(), "store"))


# --- B14-B17: inventory --------------------------------------------------------------

def lot_values(spark, sf):
    out = inventory.lot_values(tables.lots(spark, sf), FIXTURE_AS_OF, FIXTURE_EXCLUDED)
    return out.select(
        "store",
        "territory",
        "category",
        "status",
        "returned_qty",
        "quantity",
        "value",
        "age_days",
        "expiry_days",
    )


def _lots(spark, sf, *columns):
    return tables.lots(spark, sf, [*inventory.VALUE_COLUMNS, *columns])


def inventory_age_by_category(spark, sf):
    lots = _lots(spark, sf, "category", "territory", "invoicedate")
    return inventory.inventory_age_grid(lots, FIXTURE_AS_OF, "category", FIXTURE_EXCLUDED)


def inventory_age_by_territory(spark, sf):
    lots = _lots(spark, sf, "territory", "invoicedate")
    return inventory.inventory_age_grid(lots, FIXTURE_AS_OF, "territory", FIXTURE_EXCLUDED)


def expired_by_category(spark, sf):
    lots = _lots(spark, sf, "category", "territory", "expirydate")
    return inventory.expired_value(lots, FIXTURE_AS_OF, "category", FIXTURE_EXCLUDED)


def expired_by_store(spark, sf):
    lots = _lots(spark, sf, "store", "territory", "expirydate")
    return inventory.expired_value(lots, FIXTURE_AS_OF, "store", FIXTURE_EXCLUDED)


def expiry_grid_by_category(spark, sf):
    return inventory.expiry_grid(_lots(spark, sf, "category", "expirydate"), FIXTURE_AS_OF, "category")


# --- B18: customers ----------------------------------------------------------------

def customers_by_territory(spark, sf):
    return customers.customers_by_territory(tables.invoice_rows(spark, sf), FIXTURE_EXCLUDED)


def customers_total(spark, sf):
    return customers.customers_total(tables.invoice_rows(spark, sf), FIXTURE_EXCLUDED)


def customers_summary(spark, sf):
    return customers.customers_summary(tables.invoice_rows(spark, sf), FIXTURE_EXCLUDED)


# --- B20: BI lot model -------------------------------------------------------------

def _model(spark, sf, columns=schemas.LOT_WIDE_COLUMNS):
    totals = tables.lots_wide(spark, sf, lot_model.TOTAL_COLUMNS)
    return lot_model.lot_model(tables.lots_wide(spark, sf, columns), FIXTURE_AS_OF, totals, FIXTURE_FISCAL_YEARS)


def _model_rows(spark, sf, columns):
    return lot_model.lot_model_rows(tables.lots_wide(spark, sf, columns), FIXTURE_AS_OF, FIXTURE_FISCAL_YEARS)


def lot_model_table(spark, sf):
    return present(_model(spark, sf))


def lot_expiry_bands(spark, sf):
    return lot_model.expiry_bands(_model_rows(spark, sf, lot_model.BAND_INPUTS))


def lot_weighted_age(spark, sf):
    return lot_model.weighted_age(_model(spark, sf, lot_model.WEIGHTED_AGE_INPUTS))


def lot_fiscal_year(spark, sf):
    return lot_model.fiscal_year_summary(_model_rows(spark, sf, lot_model.FISCAL_YEAR_INPUTS))


# --- B19: wide layouts --------------------------------------------------------------

def scorecard_category(spark, sf):
    lines = _lines(spark, sf, ["achieved", "margin"], "category", True)
    return sales.scorecard(lines, tables.targets(spark, sf), fixture_windows(), "category", FIXTURE_EXCLUDED)


def scorecard_store(spark, sf):
    lines = _lines(spark, sf, ["achieved", "margin"], "store", True)
    return sales.scorecard(lines, tables.targets(spark, sf), fixture_windows(), "store", FIXTURE_EXCLUDED)


def scorecard_territory(spark, sf):
    lines = _lines(spark, sf, ["achieved", "margin"], "territory", True)
    return sales.scorecard(lines, tables.targets(spark, sf), fixture_windows(), "territory", FIXTURE_EXCLUDED)


def inventory_age_grid_wide(spark, sf):
    lots = _lots(spark, sf, "category", "territory", "invoicedate")
    return inventory.inventory_age_grid(lots, FIXTURE_AS_OF, "category", FIXTURE_EXCLUDED, wide=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "report_windows": report_windows,
    "sale_line_economics": sale_line_economics,
    "extract_sale_lines": extract_sale_lines,
    "extract_invoices": extract_invoices,
    "extract_documents": extract_documents,
    "extract_rejects": extract_rejects,
    "extract_accepted_value": extract_accepted_value,
    "extract_targets": extract_targets,
    "extract_lots": extract_lots,
    "extract_lots_wide": extract_lots_wide,
    "totals_unrounded": totals_unrounded,
    "achieved_revenue_by_window": achieved_revenue_by_window,
    "target_revenue_by_window": target_revenue_by_window,
    "actual_margin_by_window": actual_margin_by_window,
    "achieved_purchase_by_window": achieved_purchase_by_window,
    "sales_summary": sales_summary,
    "category_margin": category_margin,
    "category_margin_running": category_margin_running,
    "category_achieved": category_achieved,
    "category_target": category_target,
    "store_achieved": store_achieved,
    "store_margin_fy": store_margin_fy,
    "store_target": store_target,
    "territory_margin": territory_margin,
    "territory_achieved": territory_achieved,
    "territory_target": territory_target,
    "sales_history": sales_history,
    "category_history": category_history,
    "category_margin_history": category_margin_history,
    "store_target_history": store_target_history,
    "lot_values": lot_values,
    "inventory_age_by_category": inventory_age_by_category,
    "inventory_age_by_territory": inventory_age_by_territory,
    "expired_by_category": expired_by_category,
    "expired_by_store": expired_by_store,
    "expiry_grid_by_category": expiry_grid_by_category,
    "customers_by_territory": customers_by_territory,
    "customers_total": customers_total,
    "customers_summary": customers_summary,
    "lot_model": lot_model_table,
    "lot_expiry_bands": lot_expiry_bands,
    "lot_weighted_age": lot_weighted_age,
    "lot_fiscal_year": lot_fiscal_year,
    "scorecard_category": scorecard_category,
    "scorecard_store": scorecard_store,
    "scorecard_territory": scorecard_territory,
    "inventory_age_grid_wide": inventory_age_grid_wide,
}
