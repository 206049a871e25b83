"""Sums and range sums that do not depend on the order of rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import UTC
from storepulse.functions.dates import ReportWindow
from storepulse.functions.exact import TOTAL_TYPE, exact_sum, exact_total, exact_value
from storepulse.operators import sales
from storepulse.operators.day_cube import cell_range, day_cube, range_totals
from storepulse.plans import registry
from storepulse.sources import tables


def values(n=4000, seed=3):
    rng = random.Random(seed)
    return [rng.choice([1, -1]) * rng.random() * 10 ** rng.randint(-2, 11) for _ in range(n)]


def bits(df):
    return sorted(tuple(x.hex() if isinstance(x, float) else str(x) for x in r) for r in df.collect())


def test_exact_sum_is_the_rounded_true_sum(spark):
    v = values()
    got = spark.createDataFrame([(x,) for x in v], "v double").agg(exact_sum(F.col("v"))).first()[0]
    assert got == math.fsum(v)


def test_same_bits_under_any_partitioning(spark):
    rows = [(i % 7, x) for i, x in enumerate(values())]
    found = set()
    for parts, order in ((1, None), (3, 1), (64, 2)):
        mine = rows if order is None else random.Random(order).sample(rows, len(rows))
        df = spark.createDataFrame(mine, "k int, v double").repartition(parts)
        found.add(tuple(bits(df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")))))
    assert len(found) == 1


def test_nulls_empty_groups_and_totals_of_totals(spark):
    df = spark.createDataFrame([(1, 0.1), (1, None), (2, None), (3, -0.75), (3, 2.0**52), (3, -1e-3)], "k int, v double")
    assert [r[1] for r in df.groupBy("k").agg(exact_sum(F.col("v"))).orderBy("k").collect()] == [0.1, None, math.fsum([-0.75, 2.0**52, -1e-3])]
    parts = df.groupBy("k").agg(exact_total(F.col("v")).alias("t"))
    assert dict(parts.dtypes)["t"] == TOTAL_TYPE
    assert parts.agg(exact_value(F.sum("t"))).first()[0] == math.fsum([0.1, -0.75, 2.0**52, -1e-3])
    assert df.filter("k > 9").agg(exact_sum(F.col("v"))).first()[0] is None


@pytest.mark.parametrize("name", ["totals_unrounded", "category_margin_running", "inventory_age_by_category", "lot_weighted_age", "store_target_history"])
def test_reports_equal_bit_for_bit_under_1_and_200_partitions(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(bits(registry.QUERIES[name](spark, SF001)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1]


def test_unrounded_sums_equal_bit_for_bit_however_lines_lie(spark):
    lines = tables.sale_lines(spark, SF001).cache()
    windows = registry.fixture_windows()
    a = sales.margin_by(lines.repartition(1), windows, "category", (), digits=None)
    b = sales.margin_by(lines.repartition(50, "subqty").sortWithinPartitions(F.desc("gst")), windows, "category", (), digits=None)
    assert bits(a) == bits(b)


# --- day cube --------------------------------------------------------------------


@pytest.mark.parametrize("key,running", [(None, False), ("category", False), ("category", True), ("store", False)])
def test_history_equals_the_single_runs_bit_for_bit(spark, key, running):
    lines, clocks = tables.sale_lines(spark, SF001), registry.history_clocks(5)
    excluded = registry.FIXTURE_EXCLUDED if key else None
    # A single run's running totals add its windows' rounded totals, the history adds exact ones: equal as published.
    digits = 2 if running else None
    many = sales.history(lines, clocks, ["margin"], key, excluded, running, digits=digits)
    assert many.count() > 0
    for as_of, windows in clocks:
        one = sales.margin_by(lines, windows, key, excluded, running, digits=digits) if key else sales.actual_margin(lines, windows, digits=2)
        mine = many.filter(F.col("as_of") == F.lit(as_of)).drop("as_of")
        if not key:
            one, mine = one.drop("margin_text"), mine.withColumn("margin_lakh", F.round("margin_lakh", 2))
        assert bits(mine.select(one.columns)) == bits(one)


def test_last_second_of_a_day_and_empty_windows(spark):
    day = dt.datetime(2001, 7, 30, tzinfo=UTC)
    rows = [(day + dt.timedelta(hours=23, minutes=59, seconds=59), 1.0), (day + dt.timedelta(hours=23, minutes=59, seconds=59, microseconds=1), 2.0),
            (day + dt.timedelta(days=1), 4.0), (day - dt.timedelta(microseconds=1), 8.0), (day, None)]
    df = spark.createDataFrame(rows, "t timestamp, v double")
    end = lambda d: d + dt.timedelta(hours=23, minutes=59, seconds=59)
    windows = [ReportWindow(1, "day", day, end(day)), ReportWindow(2, "two", day, end(day + dt.timedelta(days=1))),
               ReportWindow(3, "later", day + dt.timedelta(days=9), end(day + dt.timedelta(days=9)))]
    span = (windows[0].start, windows[2].end)
    cube = day_cube(df, "t", {"v": F.col("v")}, [], span)
    got = {r.window_name: r.v for r in range_totals(cube, [(day, windows)], ["v"], suffix="").collect()}
    assert got == {"day": 1.0, "two": 7.0, "later": 0.0}
    empty = day_cube(df.filter("v > 99"), "t", {"v": F.col("v")}, [], span)
    assert {r.v for r in range_totals(empty, [(day, windows)], ["v"], suffix="").collect()} == {0.0}


def test_windows_must_be_whole_days():
    day = dt.datetime(2001, 7, 30, tzinfo=UTC)
    with pytest.raises(ValueError, match="midnight"):
        cell_range(ReportWindow(1, "w", day + dt.timedelta(hours=1), day + dt.timedelta(hours=23, minutes=59, seconds=59)))


def test_history_reads_the_lines_once_and_filters_the_orders(spark):
    import re

    from storepulse.plans.session import explain_text

    plan = explain_text(registry.category_history(spark, SF001))
    scans = re.findall(r"Location: InMemoryFileIndex \[.*?(\w+)\.parquet\]", plan)
    assert scans.count("lineitem") <= 2 and "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
