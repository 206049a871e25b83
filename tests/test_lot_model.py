"""BI lot model: labels, bands, store names, weighted age."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import ts
from storepulse.functions.buckets import before_last_space, expiry_band_label, expiry_band_seq, fiscal_year_label
from storepulse.operators import lot_model
from storepulse.sources import schemas

AS_OF = ts(2001, 8, 1, 12)


def test_fiscal_year_labels(spark):
    dates = [None, ts(2020, 3, 31, 23), ts(2020, 4, 1), ts(2021, 3, 31), ts(2021, 4, 1), ts(2024, 12, 1),
             ts(2025, 3, 31, 23, 59), ts(2025, 4, 1), ts(1999, 6, 1)]
    df = spark.createDataFrame([(d,) for d in dates], "d timestamp")
    got = [r[0] for r in df.select(fiscal_year_label(F.col("d"))).collect()]
    assert got == ["None", "None", "FY20-21", "FY20-21", "FY21-22", "FY24-25", "FY24-25", "None", "None"]


def test_store_name_before_last_space(spark):
    df = spark.createDataFrame([("Solo",), ("Two Words",), ("Three Word Name",), (None,)], "s string")
    got = [r[0] for r in df.select(before_last_space(F.col("s"))).collect()]
    assert got == ["Solo", "Two", "Three Word", None]


def test_expiry_bands(spark):
    clocks = [-5, 0, 1, 7, 8, 15, 16, 30, 31, 90, 91, 180, 181, None]
    df = spark.createDataFrame([(c,) for c in clocks], "c long")
    seq = expiry_band_seq(F.col("c"))
    got = [(r.s, r.l) for r in df.select(seq.alias("s"), expiry_band_label(seq).alias("l")).collect()]
    assert got == [(0, "Expired"), (0, "Expired"), (1, "< 1wk"), (1, "< 1wk"), (2, "1wk-2wk"), (2, "1wk-2wk"),
                   (3, "2wk-1m"), (3, "2wk-1m"), (4, "1m-3m"), (4, "1m-3m"), (5, "3m-6m"), (5, "3m-6m"),
                   (6, "> 6m"), (None, None)]


def _wide(spark, rows):
    cols = ", ".join(f"{c} {t}" for c, t in [
        ("_id", "string"), ("id", "string"), ("createddate", "timestamp"), ("receiveddate", "timestamp"),
        ("dateofmanufacturing", "timestamp"), ("expirydate", "timestamp"), ("gst_pct", "double"),
        ("purchasingprice_unit_xgst", "double"), ("sellingprice_unit_igst", "double"), ("subqty", "long"),
        ("soldqty", "long"), ("status", "string"), ("cnStockproduct", "double"), ("transportCharges", "double"),
        ("otherCharges", "double"), ("store_ref", "string"), ("invoiceno", "string"), ("invoicedate", "timestamp"),
        ("po_ref", "string"), ("invoice_amount", "double"), ("invoice_amount_xgst", "double"),
        ("product_name", "string"), ("category_name", "string"), ("sub_category_name", "string"),
        ("manufacturer_name", "string"), ("supplier_id", "string"), ("supplier_name", "string"),
        ("supplier_gstnumber", "string"), ("store", "string"), ("vertical", "string"), ("landingrate", "double")])
    df = spark.createDataFrame(rows, cols)
    assert tuple(df.columns) == schemas.LOT_WIDE_COLUMNS
    return df


def _row(status, subqty, soldqty, price, invoicedate, expirydate, store="Main Street Store", sp=118.0, gst=18.0,
         cn=0.0, category="A"):
    return ("x", "x", None, None, None, expirydate, gst, price, sp, subqty, soldqty, status, cn, 0.0, 0.0, "r",
            "i", invoicedate, "p", 0.0, 0.0, "prod", category, "sub", "man", "s", "sup", "g", store, "v", price)


def test_model_rows(spark):
    df = _wide(spark, [
        _row("InStock", 10, 4, 2.0, ts(2001, 7, 1, 23), ts(2001, 8, 10, 1)),
        _row("CreditNote", 10, 4, 3.0, ts(2001, 7, 22), ts(2001, 9, 1), store="Solo"),
        _row("Sold", 10, 10, 5.0, ts(2001, 6, 1), ts(2003, 1, 1)),
        _row(None, 6, 1, 1.0, None, None),
    ])
    out = {r.purchasingprice_unit_xgst: r for r in lot_model.lot_model(df, AS_OF).collect()}
    a, b, c, d = out[2.0], out[3.0], out[5.0], out[1.0]
    assert a.available_qty == 6 and a.returned_qty == 0.0 and a.current_inventory_value == 12.0
    assert a.inventory_age_days == 31 and a.inventory_age_weeks == pytest.approx(31 / 7)
    assert a.expiry_clock == 9 and a.expiry_clock_stock == 9 and a.expiry_filter == "1wk-2wk" and a.exp_seq == 2
    assert a.sellingprice_unit_xgst == pytest.approx(100.0) and a.current_inventory_selling_price == pytest.approx(600.0)
    assert a.first_store_name == "Main Street" and b.first_store_name == "Solo"
    assert b.available_qty == -4 and b.returned_qty == 10.0 and b.returned_inventory == 30.0
    assert b.expiry_clock_stock == 0 and b.expiry_filter == "Expired"      # not a stock lot
    assert c.expiry_filter == "Expired" and c.sold_inventory_value == 50.0
    assert d.inventory_age_days is None and d.fiscal_year == "None" and d.expiry_filter == "Expired"
    assert a.invoicedate_relationship == dt.date(2001, 7, 1)
    total = 12.0 + (-4 * 3.0) + 0.0 + 5 * 1.0
    assert a.average_inventory_age == pytest.approx(2.0 * 31 * 6 / total)
    assert d.average_inventory_age is None
    assert list(lot_model.lot_model(df, AS_OF).columns) == list(lot_model.MODEL_COLUMNS)


def test_weighted_age_sums_to_portfolio_age(spark):
    df = _wide(spark, [_row("InStock", 10, 0, 1.0, ts(2001, 7, 22), None, category="A"),
                       _row("InStock", 10, 0, 1.0, ts(2001, 6, 1), None, category="B")])
    model = lot_model.lot_model(df, AS_OF)
    got = {r.category_name: r.weighted_age_days for r in lot_model.weighted_age(model).collect()}
    # equal values, ages 10 and 61 days: portfolio age 35.5
    assert sum(got.values()) == pytest.approx(35.5)


def test_labels_and_names_cost_no_formatter_or_regex(spark):
    from storepulse.plans.session import explain_text

    df = spark.createDataFrame([(dt.datetime(1999, 3, 31), "a b c"), (dt.datetime(1999, 4, 1), " x"), (dt.datetime(2009, 5, 1), "ends "), (None, None), (dt.datetime(1995, 1, 1), "one")], "d timestamp, s string")
    out = df.select(fiscal_year_label(F.col("d"), 1996, 2000), before_last_space(F.col("s")))
    assert [tuple(r) for r in out.collect()] == [("FY98-99", "a b"), ("FY99-00", ""), ("None", "ends"), ("None", None), ("None", "one")]
    plan = explain_text(out)
    assert "format_string" not in plan and "regexp_replace" not in plan


def test_queries_keep_generated_methods_compilable(spark):
    import __spark_entry__ as entry

    old = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        entry.queries()["lot_model"](spark, SF001)
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", old)
