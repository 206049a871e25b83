"""Windowed sales/margin/target semantics on hand-computed micro fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from helpers import line, lines_df, ts
from storepulse.functions import economics as econ
from storepulse.functions.dates import reporting_windows
from storepulse.operators import sales
from storepulse.operators.windowed import windowed_totals

AS_OF = ts(2001, 8, 1, 12)
WINDOWS = reporting_windows(AS_OF)  # week 07-23, month 07-01, fy 04-01, end 07-31 23:59:59
EXCL = ("BAD",)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_sale_value_and_margin_formulas(spark):
    df = lines_df(spark, [line(soldqty=2.0, sellingprice=118.0, servicecharge=11.8, gst=18.0, rate=60.0,
                               discount=5.0, cn_stock=20.0, subqty=10.0, transport=4.0, other=2.0)])
    r = df.select(econ.sale_value().alias("s"), econ.sale_value_line_rate().alias("l"),
                  econ.purchase_net().alias("p"), econ.purchase_gross().alias("g"), econ.margin().alias("m")).first()
    assert r.s == pytest.approx(2 * (100.0 + 10.0))
    assert r.l == pytest.approx(2 * (100.0 + 10.0))
    assert r.p == pytest.approx(110.0)
    assert r.g == pytest.approx(120.0)
    # margin = sale - (purchase - 2*20/10 + 2*4/10 + 2*2/10)
    assert r.m == pytest.approx(220.0 - (110.0 - 4.0 + 0.8 + 0.4))


def test_service_tax_variants_differ(spark):
    df = lines_df(spark, [line(soldqty=1.0, sellingprice=0.0, servicecharge=105.0, gst=5.0)])
    r = df.select(econ.sale_value().alias("s"), econ.sale_value_line_rate().alias("l")).first()
    assert r.s == pytest.approx(105.0 / 1.18)
    assert r.l == pytest.approx(100.0)


def test_zero_subqty_and_null_discount_give_null_margin(spark):
    df = lines_df(spark, [line(subqty=0.0, cn_stock=0.0), line(subqty=0.0, transport=3.0), line(discount=None)])
    got = [r[0] for r in df.select(econ.margin()).collect()]
    assert got == [None, None, None]


def test_total_windows_and_inclusive_bounds(spark):
    df = lines_df(spark, [
        line(when=ts(2001, 7, 23, 0, 0, 0), sellingprice=100.0),        # week start: in all windows
        line(when=ts(2001, 7, 31, 23, 59, 59), sellingprice=200.0),     # end, inclusive
        line(when=ts(2001, 8, 1, 0, 0, 0), sellingprice=400.0),         # after end
        line(when=ts(2001, 7, 10), sellingprice=800.0),                 # month + fy
        line(when=ts(2001, 4, 1), sellingprice=1600.0),                 # fy start
        line(when=ts(2001, 3, 31, 23, 59, 59), sellingprice=3200.0),    # before fy
    ])
    out = sales.achieved_revenue(df, WINDOWS, digits=None)
    got = {r.window_name: r.achieved_lakh * 1e5 for r in out.collect()}
    assert got["week"] == pytest.approx(300.0)
    assert got["month"] == pytest.approx(1100.0)
    assert got["fy"] == pytest.approx(2700.0)


def test_fractional_second_after_end_is_excluded(spark):
    df = spark.createDataFrame([(1, "2001-07-31 23:59:59.5")], "id int, t string").select(
        F.col("t").cast("timestamp").alias("invoicedate"), F.lit(1.0).alias("v"))
    out = windowed_totals(df, "invoicedate", {"v": F.col("v")}, WINDOWS, digits=None, suffix="")
    assert all(r.v == 0.0 for r in out.collect())


def test_empty_total_is_zero_row_per_window(spark):
    df = lines_df(spark, [line(when=ts(1999, 1, 1))])
    out = sales.achieved_revenue(df, WINDOWS)
    assert rows(out, "window_seq", "achieved_lakh") == [(1, 0.0), (2, 0.0), (3, 0.0)]


def test_exclusion_keeps_null_territory_but_grouping_drops_null_key(spark):
    df = lines_df(spark, [
        line(territory=None, category="A", sellingprice=100.0),
        line(territory="BAD", category="A", sellingprice=1000.0),
        line(territory="T1", category=None, sellingprice=10000.0),
    ])
    cat = sales.achieved_by(df, WINDOWS, "category", EXCL, digits=None)
    assert rows(cat, "category", "window_name", "achieved_lakh") == [
        ("A", "fy", 0.001), ("A", "month", 0.001), ("A", "week", 0.001)]
    ter = sales.achieved_by(df, WINDOWS, "territory", EXCL, digits=None)
    assert rows(ter, "territory", "window_name") == [("T1", "fy"), ("T1", "month"), ("T1", "week")]


def test_key_absent_from_window_has_no_row(spark):
    df = lines_df(spark, [line(category="A", when=ts(2001, 7, 25)), line(category="B", when=ts(2001, 5, 1))])
    out = sales.achieved_by(df, WINDOWS, "category", EXCL)
    assert rows(out, "category", "window_name") == [("A", "fy"), ("A", "month"), ("A", "week"), ("B", "fy")]


def test_all_null_group_totals_zero(spark):
    df = lines_df(spark, [line(category="A", subqty=0.0, transport=1.0)])
    out = sales.margin_by(df, WINDOWS, "category", EXCL)
    assert rows(out, "window_name", "margin_lakh") == [("fy", 0.0), ("month", 0.0), ("week", 0.0)]


def test_running_margin_accumulates_and_appears_when_first_seen(spark):
    df = lines_df(spark, [
        line(category="A", when=ts(2001, 7, 25), sellingprice=150.0, rate=50.0),   # margin 100, all windows
        line(category="B", when=ts(2001, 7, 5), sellingprice=250.0, rate=50.0),    # margin 200, month + fy
        line(category="C", when=ts(2001, 5, 5), sellingprice=450.0, rate=50.0),    # margin 400, fy only
    ])
    out = sales.margin_by(df, WINDOWS, "category", EXCL, running=True, digits=None)
    got = {(r.category, r.window_name): r.margin_lakh * 1e5 for r in out.collect()}
    assert set(got) == {("A", "week"), ("A", "month"), ("A", "fy"), ("B", "month"), ("B", "fy"), ("C", "fy")}
    assert got[("A", "week")] == pytest.approx(100.0)
    assert got[("A", "month")] == pytest.approx(200.0)
    assert got[("A", "fy")] == pytest.approx(300.0)
    assert got[("B", "month")] == pytest.approx(200.0)
    assert got[("B", "fy")] == pytest.approx(400.0)
    assert got[("C", "fy")] == pytest.approx(400.0)


def test_two_line_invoice_lines_keep_their_own_category(spark):
    df = lines_df(spark, [
        line(invoice_id=7, store="S1", category="A", sellingprice=100.0),
        line(invoice_id=7, store="S1", category="B", sellingprice=300.0),
    ])
    out = sales.achieved_by(df, WINDOWS, "category", EXCL, digits=None)
    got = {(r.category, r.window_name): r.achieved_lakh for r in out.collect()}
    assert got[("A", "week")] == pytest.approx(0.001) and got[("B", "week")] == pytest.approx(0.003)


def test_target_report_exclusion_only_for_category(spark):
    t = spark.createDataFrame(
        [("S1", "BAD", "A", ts(2001, 7, 25), 100.0), ("S2", "T1", "A", ts(2001, 7, 25), 200.0)],
        "Store string, TM string, Category string, Date timestamp, Daily_Target double")
    cat = sales.target_by(t, WINDOWS, "category", EXCL, digits=None)
    assert {r.window_name: round(r.target_lakh * 1e5, 6) for r in cat.collect()}["week"] == 200.0
    ter = sales.target_by(t, WINDOWS, "territory", digits=None)
    assert rows(ter, "territory", "window_name")[0] == ("BAD", "fy")


def test_margin_text_rendering(spark):
    df = lines_df(spark, [line(sellingprice=1230050.0, rate=0.0)])
    out = sales.actual_margin(df, WINDOWS)
    r = [x for x in out.collect() if x.window_name == "week"][0]
    assert r.margin_lakh == 12.3 and r.margin_text == "12.3%"


def test_store_margin_is_fiscal_year_only(spark):
    df = lines_df(spark, [line(store="S1")])
    out = sales.store_margin_fy(df, WINDOWS, EXCL)
    assert [r.window_name for r in out.collect()] == ["fy"]


def test_scorecard_layout(spark):
    df = lines_df(spark, [line(category="A", store="S1", territory="T1"),
                          line(category="B", store="S2", territory="BAD", when=ts(2001, 5, 5))])
    t = spark.createDataFrame([("S9", "T9", "Z", ts(2001, 7, 25), 5.0)],
                              "Store string, TM string, Category string, Date timestamp, Daily_Target double")
    card = sales.scorecard(df, t, WINDOWS, "store", EXCL)
    assert card.columns == ["store", "target_week", "achieved_week", "target_month", "achieved_month",
                            "target_fy", "achieved_fy", "margin_fy"]
    got = {r.store: r for r in card.collect()}
    assert set(got) == {"S1", "S9"}          # S2 only has excluded-territory sales
    assert got["S9"].achieved_week is None and got["S9"].target_week == 0.0
    assert got["S1"].target_week is None and got["S1"].achieved_week is not None
    cat = sales.scorecard(df, t, WINDOWS, "category", EXCL)
    assert cat.columns == ["category"] + [f"{m}_{w}" for w in ("week", "month", "fy")
                                          for m in ("target", "achieved", "margin")]


def test_invariants_on_driver_tables(spark):
    from storepulse.plans.registry import fixture_windows
    from storepulse.sources import tables
    from conftest import SF01

    wins = fixture_windows()
    lines = tables.sale_lines(spark, SF01)
    totals = {r.window_name: r.achieved_lakh for r in sales.achieved_revenue(lines, wins, digits=None).collect()}
    for key in ("category", "store", "territory"):
        per = sales.achieved_by(lines, wins, key, excluded=None, digits=None)
        sums = {r[0]: r[1] for r in per.groupBy("window_name").agg(F.sum("achieved_lakh")).collect()}
        for w, v in totals.items():
            assert math.isclose(sums[w], v, rel_tol=1e-9)
    run = sales.margin_by(lines, wins, "category", excluded=None, running=True, digits=None)
    per = sales.margin_by(lines, wins, "category", excluded=None, digits=None)
    run_fy = sum(r.margin_lakh for r in run.collect() if r.window_name == "fy")
    assert math.isclose(run_fy, sum(r.margin_lakh for r in per.collect()), rel_tol=1e-9)
