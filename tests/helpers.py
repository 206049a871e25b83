"""Builders for hand-written micro fixtures."""

from __future__ import annotations

import datetime as dt

from storepulse.sources import schemas

UTC = dt.timezone.utc


def ts(*args) -> dt.datetime:
    return dt.datetime(*args, tzinfo=UTC)


LINE_SCHEMA = (
    "invoice_id long, invoicedate timestamp, store string, territory string, customer string, "
    "category string, soldqty double, sellingprice double, servicecharge double, gst double, rate double, "
    "discount double, cn_stock double, subqty double, transport_charges double, other_charges double"
)

LOT_SCHEMA = (
    "store string, territory string, category string, status string, rate double, subqty double, "
    "soldqty double, expirydate timestamp, invoicedate timestamp"
)


def line(invoice_id=1, when=None, store="S1", territory="T1", customer="C1", category="A", soldqty=1.0,
         sellingprice=100.0, servicecharge=0.0, gst=0.0, rate=50.0, discount=0.0, cn_stock=0.0, subqty=10.0,
         transport=0.0, other=0.0):
    return (invoice_id, when or ts(2001, 7, 25, 10), store, territory, customer, category, soldqty, sellingprice,
            servicecharge, gst, rate, discount, cn_stock, subqty, transport, other)


def lines_df(spark, rows):
    df = spark.createDataFrame(rows, LINE_SCHEMA)
    assert tuple(df.columns) == schemas.LINE_COLUMNS
    return df


def lot(store="S1", territory="T1", category="A", status="InStock", rate=10.0, subqty=5.0, soldqty=1.0,
        expirydate=None, invoicedate=None):
    return (store, territory, category, status, rate, subqty, soldqty, expirydate, invoicedate)


def lots_df(spark, rows):
    return spark.createDataFrame(rows, LOT_SCHEMA)
