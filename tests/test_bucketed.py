"""Landings bucketed by invoice: joins and groups by it need no exchange."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from storepulse.plans.session import explain_text
from storepulse.sinks.landing import attach_bucketed, land_bucketed
from storepulse.sources import tables


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(df):
    return len(re.findall(r"^\(\d+\) Exchange", explain_text(df), re.M))


def landed(spark, tmp_out, tag):
    heads = tables.invoice_rows(spark, SF001)
    lines = tables.sale_lines(spark, SF001).select("invoice_id", "category", "soldqty", "rate")
    one = land_bucketed(heads, f"{tmp_out}/heads", f"heads_{tag}", "invoice_id", 6)
    two = land_bucketed(lines, f"{tmp_out}/lines", f"lines_{tag}", "invoice_id", 6)
    return heads, lines, one, two


def test_joins_and_groups_by_invoice_need_no_exchange(no_broadcast, tmp_out):
    heads, lines, one, two = landed(no_broadcast, tmp_out, "a")
    joined = two.join(one, "invoice_id")
    assert exchanges(joined) == 0 and exchanges(two.groupBy("invoice_id").agg(F.sum("soldqty"))) == 0
    assert exchanges(lines.join(heads, "invoice_id")) > 0
    plain = lines.join(heads, "invoice_id").select(joined.columns)
    assert joined.count() == plain.count() and joined.exceptAll(plain).count() == 0
    per = joined.groupBy("invoice_id").agg(F.count(F.lit(1)).alias("n"), F.max("customer").alias("customer"))
    assert exchanges(per) == 0


def test_another_session_attaches_the_landing(no_broadcast, tmp_out):
    _, lines, one, two = landed(no_broadcast, tmp_out, "b")
    again = attach_bucketed(no_broadcast, f"{tmp_out}/lines", two.schema, "lines_again", "invoice_id", 6)
    assert again.count() == lines.count() and exchanges(again.join(one, "invoice_id")) == 0


def test_a_hot_invoice_is_kept_whole_and_findable(no_broadcast, tmp_out):
    rows = no_broadcast.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("invoice_id"), F.col("id").alias("v"))
    got = land_bucketed(rows, f"{tmp_out}/hot", "hot_lines", "invoice_id", 4)
    assert got.count() == 30_000 and got.filter("invoice_id = 7").count() == rows.filter("invoice_id = 7").count()
    assert land_bucketed(rows.limit(10), f"{tmp_out}/hot", "hot_lines", "invoice_id", 4).count() == 10
