"""Inventory quantity, age buckets, dense grids and expired stock."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import lot, lots_df, ts
from storepulse.functions.buckets import bucket_seq
from storepulse.operators import inventory, lot_model

AS_OF = ts(2001, 8, 1, 12)
EXCL = ("BAD",)


def days_ago(n, hours=0):
    return AS_OF - dt.timedelta(days=n, hours=hours)


def test_age_bucket_edges(spark):
    ages = [0, 1, 2, 45, 46, 90, 91, 135, 136, None]
    df = spark.createDataFrame([(a,) for a in ages], "d long")
    seq = bucket_seq(F.col("d"))
    got = [(r.d, r.s) for r in df.select("d", seq.alias("s")).collect()]
    assert got == [(0, None), (1, None), (2, 1), (45, 1), (46, 2), (90, 2), (91, 3), (135, 3), (136, 4), (None, None)]


def test_open_low_bucket_takes_negative_days(spark):
    df = spark.createDataFrame([(-10,), (0,), (45,), (46,)], "d long")
    got = [r[0] for r in df.select(bucket_seq(F.col("d"), open_low=True)).collect()]
    assert got == [1, 1, 1, 2]


def test_quantity_variants(spark):
    df = lots_df(spark, [lot(status="creditnote", subqty=5.0, soldqty=2.0), lot(status="CreditNote", subqty=5.0, soldqty=2.0),
                         lot(status=None, subqty=5.0, soldqty=2.0)])
    st, sub, sold = F.col("status"), F.col("subqty"), F.col("soldqty")
    got = [(r.a, r.b) for r in df.select(inventory.script_quantity(st, sub, sold).alias("a"),
                                         lot_model._available(st, sub, sold).alias("b")).collect()]
    # script: a return adds the lot size back; model: it removes it; null status is neither
    assert got == [(8.0, 3), (3.0, -2), (3.0, 3)]


def test_dense_age_grid(spark):
    df = lots_df(spark, [
        lot(category="A", invoicedate=days_ago(10), rate=10.0, subqty=5.0, soldqty=1.0),   # 1-45: 40
        lot(category="A", invoicedate=days_ago(200), rate=1.0, subqty=3.0, soldqty=0.0),   # 135+: 3
        lot(category="B", invoicedate=days_ago(1), rate=1.0),                                # no bucket
        lot(category="C", territory="BAD", invoicedate=days_ago(10)),                        # excluded
        lot(category=None, invoicedate=days_ago(10)),                                        # null key
        lot(category="D", territory=None, invoicedate=days_ago(50), rate=1.0, subqty=1.0, soldqty=0.0),
    ])
    out = inventory.inventory_age_grid(df, AS_OF, "category", EXCL, digits=None)
    got = {(r.category, r.bucket_seq): round(r.value_lakh * 1e5, 6) for r in out.collect()}
    assert sorted({k for k, _ in got}) == ["A", "B", "D"]
    assert len(got) == 3 * 4
    assert got[("A", 1)] == 40.0 and got[("A", 4)] == 3.0 and got[("A", 2)] == 0.0
    assert all(got[("B", i)] == 0.0 for i in range(1, 5))
    assert got[("D", 2)] == 1.0
    wide = inventory.inventory_age_grid(df, AS_OF, "category", EXCL, digits=None, wide=True)
    assert wide.columns == ["category", "days_1_45", "days_46_90", "days_91_135", "days_135_plus"]


def test_age_one_day_boundary_in_hours(spark):
    df = lots_df(spark, [lot(invoicedate=days_ago(1, 23), rate=1.0, subqty=1.0, soldqty=0.0),   # 1 d 23 h -> 1
                         lot(invoicedate=days_ago(2), rate=2.0, subqty=1.0, soldqty=0.0)])      # 2 d -> bucket 1
    out = inventory.inventory_age_grid(df, AS_OF, "category", EXCL, digits=None)
    got = {r.bucket_seq: round(r.value_lakh * 1e5, 6) for r in out.collect()}
    assert got[1] == 2.0


def test_expired_value_clock(spark):
    df = lots_df(spark, [
        lot(category="A", expirydate=AS_OF - dt.timedelta(hours=1), rate=1.0, subqty=1.0, soldqty=0.0),   # -1 h: expired
        lot(category="A", expirydate=AS_OF + dt.timedelta(hours=1), rate=2.0, subqty=1.0, soldqty=0.0),   # +1 h: clock 0
        lot(category="A", expirydate=AS_OF + dt.timedelta(hours=25), rate=4.0, subqty=1.0, soldqty=0.0),  # +25 h: 1 day
        lot(category="A", expirydate=None, rate=8.0, subqty=1.0, soldqty=0.0),                              # never
        lot(category="B", expirydate=AS_OF + dt.timedelta(days=30)),
    ])
    out = inventory.expired_value(df, AS_OF, "category", EXCL, digits=None)
    got = {r.category: round(r.expired_lakh * 1e5, 6) for r in out.collect()}
    assert got == {"A": 3.0}


def test_expiry_grid_puts_expired_stock_in_first_bucket(spark):
    df = lots_df(spark, [lot(category="A", expirydate=AS_OF - dt.timedelta(days=400), rate=1.0, subqty=1.0, soldqty=0.0),
                         lot(category="A", expirydate=AS_OF + dt.timedelta(days=100), rate=2.0, subqty=1.0, soldqty=0.0),
                         lot(category="A", territory="BAD", expirydate=AS_OF, rate=4.0, subqty=1.0, soldqty=0.0)])
    out = inventory.expiry_grid(df, AS_OF, "category", digits=None)
    got = {r.bucket_seq: round(r.value_lakh * 1e5, 6) for r in out.collect()}
    assert got == {1: 5.0, 2: 0.0, 3: 2.0, 4: 0.0}


def test_grid_totals_match_table_on_driver_tables(spark):
    from conftest import SF01
    from storepulse.plans.registry import FIXTURE_AS_OF, FIXTURE_EXCLUDED
    from storepulse.sources import tables

    lots = tables.lots(spark, SF01)
    grid = inventory.inventory_age_grid(lots, FIXTURE_AS_OF, "category", FIXTURE_EXCLUDED, digits=None)
    assert grid.count() == 6 * 4
    vals = inventory.lot_values(lots, FIXTURE_AS_OF, FIXTURE_EXCLUDED)
    bucketed = vals.filter(F.col("age_days") > 1).agg(F.sum("value")).first()[0]
    assert grid.agg(F.sum("value_lakh")).first()[0] * 1e5 == pytest.approx(bucketed, rel=1e-9)
    by_age = {r.bucket: r.v for r in grid.groupBy("bucket").agg(F.round(F.sum("value_lakh"), 2).alias("v")).collect()}
    assert by_age == {"1-45 days": 139.55, "46-90 days": 138.81, "91-135 days": 124.27, "135+ days": 7221.86}  # by SQL


def test_cube_gives_the_same_reports(spark):
    from conftest import SF01
    from storepulse.plans.registry import FIXTURE_AS_OF, FIXTURE_EXCLUDED
    from storepulse.sources import tables

    lots = tables.lots(spark, SF01)
    cube = inventory.lot_cube(lots, FIXTURE_AS_OF)
    for make in (
        lambda x: inventory.inventory_age_grid(x, FIXTURE_AS_OF, "territory", FIXTURE_EXCLUDED),
        lambda x: inventory.inventory_age_grid(x, FIXTURE_AS_OF, "category", FIXTURE_EXCLUDED, wide=True),
        lambda x: inventory.expiry_grid(x, FIXTURE_AS_OF, "category"),
        lambda x: inventory.expired_value(x, FIXTURE_AS_OF, "store", FIXTURE_EXCLUDED),
    ):
        a, b = make(lots), make(cube)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
