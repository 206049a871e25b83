"""Inputs derived from the driver's star-schema tables.

The mapping (documented in ``FIXTURES.md`` section 3) turns orders into
invoices, lineitems into invoice lines and inventory lots, and daily line
totals into store targets. Every frame here is a lazy plan over the parquet
tables: filters a report applies later (invoice date, territory) are pushed
through these joins down to the ``orders`` scan by Catalyst.

Join strategy: every join is an equi-join on a key, and a frame joins only
the tables its requested columns need (an unused outer join is not removed
by the optimizer, and at scale each one is a shuffle of all lines). The
dimension tables ``nation`` and ``region`` are a few rows and get broadcast
by the planner's own size check (``spark.sql.autoBroadcastJoinThreshold``,
from file statistics); ``part``, ``supplier`` and ``customer`` grow with the
data, so no broadcast is forced: the planner picks a sort-merge join unless
AQE sees a small side at runtime. A hot part or supplier key on the
lineitem side is split by AQE's skew-join handling (left outer joins with
the skewed side on the left are supported).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exact import exact_sum
from . import schemas

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
)


# Declared schemas of the star-schema tables: reading with a schema skips
# the footer-reading job that schema discovery would run on every read.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _ts(name: str) -> Column:
    # Driver tables store TIMESTAMP_NTZ; reports work in UTC timestamps.
    # Comparisons on the cast column are unwrapped and still pushed down.
    return F.col(name).cast("timestamp")


def _nation(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias(f"{prefix}_n_key"),
        F.col("n_name").alias(f"{prefix}_n_name"),
        F.col("n_regionkey").alias(f"{prefix}_r_key"),
    )


def _region(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias(f"{prefix}_r_key"), F.col("r_name").alias(f"{prefix}_r_name")
    )


# --- sale lines -----------------------------------------------------------------

_LINE_EXPR = {
    "invoice_id": lambda: F.col("o_orderkey"),
    "invoicedate": lambda: _ts("o_orderdate"),
    "store": lambda: F.concat(F.lit("STORE "), F.col("c_n_name"), F.lit(" "), F.col("c_mktsegment")),
    "territory": lambda: F.col("c_n_name"),
    "customer": lambda: F.col("c_name"),
    "category": lambda: F.col("p_type"),
    "soldqty": lambda: F.col("l_quantity"),
    "sellingprice": lambda: F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
    "servicecharge": lambda: F.col("p_size") * F.lit(1.0),
    "gst": lambda: F.round(F.abs(F.col("l_tax")) * F.lit(100.0)),
    "rate": lambda: F.col("p_retailprice"),
    "discount": lambda: F.col("p_retailprice") * F.abs(F.col("l_discount")),
    "cn_stock": lambda: F.when(F.col("l_returnflag") == F.lit("R"), F.col("p_retailprice")).otherwise(F.lit(0.0)),
    "subqty": lambda: F.col("l_quantity") + F.col("p_size") - F.lit(2),
    "transport_charges": lambda: F.col("s_acctbal") / F.lit(100.0),
    "other_charges": lambda: F.col("p_size") * F.lit(1.0),
}

_NEEDS_CUSTOMER = {"store", "territory", "customer"}
_NEEDS_PART = {"category", "servicecharge", "rate", "discount", "cn_stock", "subqty", "other_charges"}
_NEEDS_SUPPLIER = {"transport_charges"}


def sale_lines(spark: SparkSession, sf_dir: str, columns: Iterable[str] = schemas.LINE_COLUMNS) -> DataFrame:
    """Flat sale lines (a subset of ``schemas.LINE_COLUMNS``) from the tables.

    Same rows as ``readers.sale_lines_frame(invoices(...))`` without building
    the documents. Joins: orders (+ customer
    + nation when store/territory/customer are asked for) with lineitem on
    the order key, then part and supplier only if a requested column needs
    them.
    """
    cols = [c for c in schemas.LINE_COLUMNS if c in set(columns)]
    want = set(cols)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    header = orders
    if want & _NEEDS_CUSTOMER:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        header = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
            _nation(spark, sf_dir, "c"), F.col("c_nationkey") == F.col("c_n_key"), "left"
        )
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    lines = li.join(header, li.l_orderkey == header.o_orderkey, "inner")
    if want & _NEEDS_PART:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
        lines = lines.join(part, lines.l_partkey == part.p_partkey, "left")
    if want & _NEEDS_SUPPLIER:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
        lines = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey, "left")
    return lines.select(*[_LINE_EXPR[c]().alias(c) for c in cols])


def invoice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice-level frame (``readers.invoice_frame`` columns); orders without lines included."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    header = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        _nation(spark, sf_dir, "c"), F.col("c_nationkey") == F.col("c_n_key"), "left"
    )
    return header.select(*[_LINE_EXPR[c]().alias(c) for c in ("invoice_id", "invoicedate", "store", "territory", "customer")])


def order_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(invoicedate, lines) of every order that has lines.

    Lines are counted per order key before the join, so an order with very
    many lines costs one row per map task; a date filter on the result
    reaches the orders scan.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", _ts("o_orderdate").alias("invoicedate"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("invoicedate", "lines")


#: Lines that one document of an invoice holds at most.
LINES_PER_DOCUMENT = 4
#: Lines of an order that are numbered together; an order of more is dealt to several groups.
LINES_PER_GROUP = 64


def _numbered_lines(li: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Lines with their order's number as text (``order_no``) and the group and the document (``run``) of it that they belong to.

    ``lines`` may give the lines with an id of each (``line_id``) and further columns, even
    several times; a line and its copies count as one. An order of any number of lines is dealt to groups of about
    ``LINES_PER_GROUP`` by a hash of the line, so that no window or array holds a whole order. The rows
    come dealt by ``order_no``, on which all that follows is grouped and joined without another exchange.
    """
    lines = li.withColumn("line_id", F.monotonically_increasing_id()) if lines is None else lines
    counted = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LINES_PER_GROUP)
    large = counted.select(F.col("l_orderkey").cast("string").alias("large_no"), F.ceil(F.col("n") / LINES_PER_GROUP).alias("groups"))
    by_order = lines.withColumn("order_no", F.col("l_orderkey").cast("string")).repartition("order_no")
    dealt = by_order.join(large, by_order.order_no == large.large_no, "left").drop("large_no")
    digest = F.xxhash64(*li.columns)
    dealt = dealt.withColumn("line_group", F.coalesce(F.pmod(digest, F.col("groups")), F.lit(0))).drop("groups")
    order = Window.partitionBy("order_no", "line_group").orderBy("l_linenumber", digest, "line_id")
    return dealt.withColumn("run", F.floor((F.dense_rank().over(order) - 1) / LINES_PER_DOCUMENT))


def invoices(spark: SparkSession, sf_dir: str, lines: bool = True) -> DataFrame:
    """Documents shaped like the sales extract (``schemas.SALES`` subset).

    A document holds ``LINES_PER_DOCUMENT`` lines of an order at most, by line number,
    so its ``product`` array is bounded however many lines the order has. Its ``_id`` is
    ``<order>-<group>-<run>``, unique; ``invoiceno`` is the order's. Orders without lines have one document with an empty array.
    ``lines=False`` gives the headers alone, a document for each order,
    from which invoices are read without a pass over the lines.
    """
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    element = F.struct(
        _LINE_EXPR["soldqty"]().alias("soldqty"),
        _LINE_EXPR["servicecharge"]().alias("servicecharge"),
        F.lit(None).cast("double").alias("extradiscount"),
        _LINE_EXPR["sellingprice"]().alias("sellingprice"),
        _LINE_EXPR["gst"]().alias("gst"),
        F.struct(
            F.col("p_name").alias("name"),
            F.struct(F.col("p_type").alias("name")).alias("category"),
            F.struct(F.col("p_brand").alias("name")).alias("manufacturer"),
            F.struct(F.col("p_name").alias("name")).alias("sub_category"),
        ).alias("purchaseProductDetails"),
        F.struct(
            _LINE_EXPR["discount"]().alias("discount"),
            _LINE_EXPR["rate"]().alias("rate"),
            _lot_id().alias("id"),
            _LINE_EXPR["sellingprice"]().alias("sellingprice"),
            F.lit(None)
            .cast("struct<supplier_ref:string,invoiceno:string,createddate:string,invoicedate:string>")
            .alias("invoice"),
            _LINE_EXPR["cn_stock"]().alias("cnStockproduct"),
            _LINE_EXPR["subqty"]().alias("subqty"),
            _LINE_EXPR["transport_charges"]().alias("transportCharges"),
            _LINE_EXPR["other_charges"]().alias("otherCharges"),
            F.col("p_retailprice").alias("landingrate"),
        ).alias("lotDetails"),
        F.struct(F.col("s_name").alias("name")).alias("supplierDetails"),
        F.lit(None).cast("double").alias("storeTargetPerProduct"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    header = (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(_nation(spark, sf_dir, "c"), F.col("c_nationkey") == F.col("c_n_key"), "left")
        .join(_region(spark, sf_dir, "c"), "c_r_key", "left")
        .withColumn("invoiceno", F.col("o_orderkey").cast("string"))
    )
    if lines:
        # Narrow rows meet the tables of keys first; the wide ones are exchanged once, by order.
        wide = (
            li.withColumn("line_id", F.monotonically_increasing_id())
            .join(supplier, li.l_suppkey == supplier.s_suppkey, "left")
            .join(part, li.l_partkey == part.p_partkey, "left")
        )
        parts = (
            _numbered_lines(li, wide)
            .select("order_no", "line_group", "run", F.struct("l_linenumber", element.alias("e")).alias("line"))
            .groupBy("order_no", "line_group", "run")
            .agg(F.sort_array(F.collect_list("line")).alias("some"))
            .select("order_no", "line_group", "run", F.col("some.e").alias("product"))
        )
        docs = header.join(parts, header.invoiceno == parts.order_no, "left")
    else:
        docs = header.select("*", F.lit(0).alias("line_group"), F.lit(0).alias("run"), F.lit(None).cast(f"array<{schemas.PRODUCT.simpleString()}>").alias("product"))
    empty = F.array().cast(f"array<{schemas.PRODUCT.simpleString()}>")
    return docs.select(
        F.concat_ws("-", *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in ("o_orderkey", "line_group", "run")]).alias("_id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.col("c_custkey").cast("string").alias("customer_uid"),
        ).alias("customerDetails"),
        F.struct(
            _LINE_EXPR["store"]().alias("name"),
            F.struct(
                F.col("c_n_name").alias("name"),
                F.struct(F.col("c_r_name").alias("name")).alias("zone"),
            ).alias("territory"),
        ).alias("storeDetails"),
        "invoiceno",
        _ts("o_orderdate").alias("invoicedate"),
        F.coalesce("product", empty).alias("product"),
        F.col("o_totalprice").alias("grosstotal"),
    )


# --- targets ---------------------------------------------------------------------

def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily store targets: 110 % of the day's extended price per store and category.

    Columns of ``schemas.TARGETS``. ``Target`` is the month total of
    ``Daily_Target`` for the same store, territory and category; it is only
    computed when selected (column pruning drops the window otherwise, and
    then a report's ``Date`` filter reaches the orders scan).
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    header = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        _nation(spark, sf_dir, "c"), F.col("c_nationkey") == F.col("c_n_key"), "left"
    )
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    lines = li.join(header, li.l_orderkey == header.o_orderkey, "inner").join(
        part, li.l_partkey == part.p_partkey, "left"
    )
    daily = lines.groupBy(
        _ts("o_orderdate").alias("Date"),
        _LINE_EXPR["store"]().alias("Store"),
        F.col("c_n_name").alias("TM"),
        F.col("p_type").alias("Category"),
    ).agg((exact_sum(F.col("l_extendedprice")) * F.lit(1.1)).alias("Daily_Target"))
    month = Window.partitionBy("Store", "TM", "Category", F.year("Date"), F.month("Date"))
    return daily.select(
        "Store",
        "TM",
        "Category",
        F.month("Date").cast("string").alias("Month"),
        F.year("Date").cast("string").alias("Year"),
        F.sum("Daily_Target").over(month).alias("Target"),
        "Date",
        "Daily_Target",
    )


# --- inventory lots --------------------------------------------------------------

def _status(credit_note: str) -> Column:
    flag = F.col("l_returnflag")
    return (
        F.when(flag == F.lit("R"), F.lit(credit_note))
        .when(flag == F.lit("A"), F.lit("InStock"))
        .when(flag == F.lit("N"), F.lit("Sold"))
    )


def _lot_status(credit_note: str) -> Column:
    # Seventh lines have no status.
    return F.when(F.col("l_linenumber") != 7, _status(credit_note))


def _lot_territory() -> Column:
    # Every seventh supplier has no territory.
    return F.when(F.col("s_suppkey") % 7 != 0, F.col("s_n_name"))


def _lot_expiry() -> Column:
    # Parts of size 10, 20, ... never expire.
    return F.when(F.col("p_size") % 10 != 0, _expiry())


def _expiry() -> Column:
    return F.timestamp_add("DAY", F.col("p_size") * F.lit(10), F.col("l_shipdate")).cast("timestamp")


def _lot_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


# column -> (expression, tables it needs beyond lineitem)
_LOT_EXPR = {
    "store": (lambda: F.col("s_name"), {"supplier"}),
    "territory": (_lot_territory, {"supplier", "nation"}),
    "category": (lambda: F.col("p_type"), {"part"}),
    "status": (lambda: _lot_status("creditnote"), set()),
    "rate": (lambda: F.col("p_retailprice"), {"part"}),
    "subqty": (lambda: F.col("l_quantity"), set()),
    "soldqty": (lambda: F.least(F.col("l_quantity"), F.col("p_size").cast("double")), {"part"}),
    "expirydate": (_lot_expiry, {"part"}),
    "invoicedate": (lambda: _ts("o_orderdate"), {"orders"}),
}

_LOT_WIDE_EXPR = {
    "_id": (_lot_id, set()),
    "id": (_lot_id, set()),
    "createddate": (lambda: _ts("o_orderdate"), {"orders"}),
    "receiveddate": (lambda: _ts("l_shipdate"), set()),
    "dateofmanufacturing": (lambda: _ts("o_orderdate"), {"orders"}),
    "expirydate": (_lot_expiry, {"part"}),
    "gst_pct": (lambda: _LINE_EXPR["gst"](), set()),
    "purchasingprice_unit_xgst": (lambda: F.col("p_retailprice"), {"part"}),
    "sellingprice_unit_igst": (lambda: _LINE_EXPR["sellingprice"](), set()),
    "subqty": (lambda: F.col("l_quantity").cast("long"), set()),
    "soldqty": (lambda: F.least(F.col("l_quantity"), F.col("p_size").cast("double")).cast("long"), {"part"}),
    "status": (lambda: _lot_status("CreditNote"), set()),
    "cnStockproduct": (lambda: _LINE_EXPR["cn_stock"](), {"part"}),
    "transportCharges": (lambda: _LINE_EXPR["transport_charges"](), {"supplier"}),
    "otherCharges": (lambda: _LINE_EXPR["other_charges"](), {"part"}),
    "store_ref": (lambda: F.col("s_suppkey").cast("string"), {"supplier"}),
    "invoiceno": (lambda: F.col("o_orderkey").cast("string"), {"orders"}),
    "invoicedate": (lambda: _ts("o_orderdate"), {"orders"}),
    "po_ref": (lambda: F.col("o_custkey").cast("string"), {"orders"}),
    "invoice_amount": (lambda: F.col("o_totalprice"), {"orders"}),
    "invoice_amount_xgst": (lambda: F.round(F.col("o_totalprice") / F.lit(1.18), 2), {"orders"}),
    "product_name": (lambda: F.col("p_name"), {"part"}),
    "category_name": (lambda: F.col("p_type"), {"part"}),
    "sub_category_name": (lambda: F.col("p_name"), {"part"}),
    "manufacturer_name": (lambda: F.col("p_brand"), {"part"}),
    "supplier_id": (lambda: F.col("s_suppkey").cast("string"), {"supplier"}),
    "supplier_name": (lambda: F.col("s_name"), {"supplier"}),
    "supplier_gstnumber": (lambda: F.concat(F.lit("GSTIN"), F.col("s_suppkey").cast("string")), {"supplier"}),
    "store": (lambda: F.concat(F.col("s_name"), F.lit(" STORE")), {"supplier"}),
    "vertical": (lambda: F.col("s_r_name"), {"supplier", "nation", "region"}),
    "landingrate": (lambda: F.col("p_retailprice"), {"part"}),
}


def _lot_frame(spark: SparkSession, sf_dir: str, exprs: dict, columns: Iterable[str]) -> DataFrame:
    """One row per lineitem; joins only the tables the requested columns need."""
    cols = [c for c in exprs if c in set(columns)]
    need: set[str] = set()
    for c in cols:
        need |= exprs[c][1]
    base = table(spark, sf_dir, "lineitem")
    if "orders" in need:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
        base = base.join(orders, base.l_orderkey == orders.o_orderkey, "left")
    if "part" in need:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
        base = base.join(part, base.l_partkey == part.p_partkey, "left")
    if "supplier" in need:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        base = base.join(supplier, base.l_suppkey == supplier.s_suppkey, "left")
    if "nation" in need:
        base = base.join(_nation(spark, sf_dir, "s"), F.col("s_nationkey") == F.col("s_n_key"), "left")
    if "region" in need:
        base = base.join(_region(spark, sf_dir, "s"), "s_r_key", "left")
    return base.select(*[exprs[c][0]().alias(c) for c in cols])


def lots(spark: SparkSession, sf_dir: str, columns: Iterable[str] = schemas.LOT_COLUMNS) -> DataFrame:
    """Flat narrow lots (a subset of ``schemas.LOT_COLUMNS``): one lot per lineitem."""
    return _lot_frame(spark, sf_dir, _LOT_EXPR, columns)


def lots_wide(spark: SparkSession, sf_dir: str, columns: Iterable[str] = schemas.LOT_WIDE_COLUMNS) -> DataFrame:
    """Flat BI lots (a subset of ``schemas.LOT_WIDE_COLUMNS``) from the tables."""
    return _lot_frame(spark, sf_dir, _LOT_WIDE_EXPR, columns)


# --- raw extract shapes of the same rows ---------------------------------------------

def _invoicedate_text() -> Column:
    """Invoice date as text in one of four layouts, by line number; two of them have no time."""
    at, n = F.col("invoicedate").cast("timestamp_ntz"), F.col("n")
    return (
        F.when(n == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(n == 1, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(n == 2, F.date_format(at, "MM/dd/yyyy"))
        .otherwise(F.date_format(at, "d MMM yyyy"))
    )


def lot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow lots shaped like their extract (``schemas.LOTS``), invoice dates as mixed text."""
    flat = _lot_frame(spark, sf_dir, _LOT_EXPR | {"n": (lambda: F.col("l_linenumber") % 4, set())}, [*_LOT_EXPR, "n"])
    return flat.select(
        F.struct(F.col("store").alias("name"), F.struct(F.col("territory").alias("name")).alias("territory")).alias("storeDetails"),
        F.col("subqty").alias("qty"),
        "expirydate",
        "status",
        "rate",
        "subqty",
        "soldqty",
        F.struct(F.struct(F.col("category").alias("name")).alias("category")).alias("productDetails"),
        F.struct(_invoicedate_text().alias("invoicedate"), F.lit(None).cast("string").alias("invoiceno")).alias("invoice"),
    )


def lot_documents_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BI lots shaped like their extract (``schemas.LOTS_WIDE``); quantities carry a half that the reader rounds."""
    flat = lots_wide(spark, sf_dir)
    named = lambda c: F.struct(F.col(c).alias("name"))
    return flat.select(
        "_id", "id", "createddate", "receiveddate", "dateofmanufacturing", "expirydate",
        F.col("gst_pct").alias("gst"), F.col("purchasingprice_unit_xgst").alias("rate"), "landingrate",
        F.col("sellingprice_unit_igst").alias("sellingprice"),
        (F.col("subqty") + F.lit(0.5)).alias("subqty"), (F.col("soldqty") + F.lit(0.5)).alias("soldqty"),
        "status", "cnStockproduct", "transportCharges", "otherCharges", "store_ref",
        F.struct(
            "invoiceno", "invoicedate", "po_ref", F.col("invoice_amount").alias("rate"), F.col("invoice_amount_xgst").alias("total")
        ).alias("invoice"),
        F.struct(
            F.col("product_name").alias("name"), named("category_name").alias("category"),
            named("sub_category_name").alias("sub_category"), named("manufacturer_name").alias("manufacturer"),
        ).alias("productDetails"),
        F.struct(
            F.col("supplier_id").alias("id"), F.col("supplier_name").alias("name"), F.col("supplier_gstnumber").alias("gstnumber")
        ).alias("supplier"),
        F.struct(F.col("store").alias("name"), "vertical").alias("storeDetails"),
    )


def target_envelopes(spark: SparkSession, sf_dir: str, result: str) -> DataFrame:
    """Targets as response text, one ``{"data": {result: [record, ...]}}`` for each store and month.

    A response is bounded by the month's days and the categories. Every thirteenth day's
    ``Daily_Target`` is null.
    """
    rows = targets(spark, sf_dir).select("Store", "TM", "Category", "Month", "Year", "Date", "Daily_Target")
    rows = rows.withColumn("Daily_Target", F.when(F.dayofmonth("Date") != 13, F.col("Daily_Target")))
    record = F.struct(*[F.col(c) for c in rows.columns])
    months = rows.groupBy("Store", "Year", "Month").agg(F.collect_list(record).alias(result))
    body = F.struct(F.struct(F.col(result)).alias("data"))
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "ignoreNullFields": "false"}
    return months.select(F.to_json(body, options).alias("value"))


# --- extracts with planted faults ----------------------------------------------

def faulty_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice headers, some without their ``_id`` (orders divisible by 101) or else their date (by 103)."""
    docs, key = invoices(spark, sf_dir, lines=False), F.col("invoiceno").cast("long")
    return docs.withColumns({"_id": F.when(key % 101 != 0, F.col("_id")), "invoicedate": F.when((key % 103 != 0) | (key % 101 == 0), F.col("invoicedate"))})


def faulty_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow lots, those of 7 or 11 pieces with a date that is none, those of 13 without a rate."""
    docs = lot_documents(spark, sf_dir)
    text = F.when(F.col("qty").isin(7.0, 11.0), F.lit("not known")).otherwise(F.col("invoice.invoicedate"))
    return docs.withColumns({
        "invoice": F.struct(text.alias("invoicedate"), F.col("invoice.invoiceno").alias("invoiceno")),
        "rate": F.when(F.col("qty") != 13.0, F.col("rate")),
    })
