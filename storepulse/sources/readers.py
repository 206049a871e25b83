"""Readers for landed extracts and their flat working frames.

Extracts are JSON documents (one record per line, or a JSON array), responses
that wrap the records as ``{"data": {result: [...]}}``, or parquet, read with
the explicit schemas of :mod:`schemas`. A failed extract stops the job that
reads it: ``FAILFAST`` rejects malformed text, an envelope without its result is
an error, and so is a record without the fields that identify it (an error
document, or an envelope read as bare records, has none of them). Parquet
extracts are also checked for the needed columns when they are opened.

A file that is one JSON document (``multiline``: an array of records, or one
envelope around it) is split by byte ranges (:mod:`json_split`), so a response of any size is
read by many tasks.

The ``*_frame`` functions turn the nested records into the flat frames the
operators work on. They select only the leaves the reports need, so parquet
nested-column pruning reads just those leaves.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_timestamp
from ..functions.economics import clean_double
from . import schemas
from .json_split import read_records
from .rejects import missing

FORMATS = ("json", "parquet")

#: Keys and dates by which a record is known. Measures are none of them: a null measure is skipped by the sums.
IDENTITY = {
    "sales": ("_id", "invoicedate"),
    "targets": ("Store", "Date"),
    "lots": ("storeDetails.name", "productDetails.category.name"),
    "lots_wide": ("_id",),
}


class ExtractError(ValueError):
    """The extract does not carry the fields a report needs."""


def _leaf_paths(schema: T.StructType, prefix: str = "") -> set[str]:
    out: set[str] = set()
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        out.add(path)
        dtype = field.dataType
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if isinstance(dtype, T.StructType):
            out |= _leaf_paths(dtype, path + ".")
    return out


def require_fields(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Fail early (on the driver) if the files' own schema lacks a path."""
    present = _leaf_paths(df.schema)
    missing = [p for p in paths if p not in present]
    if missing:
        raise ExtractError(f"extract lacks required fields: {missing}")
    return df


def complete(df: DataFrame, identity: Iterable[str], what: str) -> DataFrame:
    """``df``, whose reading fails at the first record without one of its ``identity`` fields."""
    paths = list(identity)
    there = F.lit(True)
    for p in paths:
        there = there & F.col(p).isNotNull()
    error = F.raise_error(F.lit(f"{what}: a record without {' or '.join(paths)}; the extract failed or is no such extract"))
    return df.filter(F.when(there, F.lit(True)).otherwise(error.cast("boolean")))


def identified(df: DataFrame, identity: Iterable[str], what: str) -> DataFrame:
    """``df``, whose reading fails at the first record that has none of its ``identity`` fields."""
    paths = list(identity)
    some = F.lit(False)
    for p in paths:
        some = some | F.col(p).isNotNull()
    error = F.raise_error(F.lit(f"{what}: a record without any of {', '.join(paths)}; the extract failed or is no such extract"))
    return df.filter(F.when(some, F.lit(True)).otherwise(error.cast("boolean")))


def _envelope(schema: T.StructType, result: str) -> T.StructType:
    records = T.StructField(result, T.ArrayType(schema, True), True)
    return T.StructType([T.StructField("data", T.StructType([records]), True)])


def unwrapped(responses: DataFrame, result: str) -> DataFrame:
    """Records of parsed responses (``data.<result>``); a response without the result is an error."""
    records = F.col(f"data.{result}")
    error = F.raise_error(F.lit(f"a response without data.{result}; the fetch failed"))
    kept = responses.filter(F.when(records.isNotNull(), F.lit(True)).otherwise(error.cast("boolean")))
    return kept.select(F.inline(records))


def parse_responses(texts: DataFrame, schema: T.StructType, result: str, column: str = "value") -> DataFrame:
    """Records of responses held as text in ``column``."""
    parsed = F.from_json(F.col(column), _envelope(schema, result), {"mode": "FAILFAST"})
    return unwrapped(texts.select(parsed["data"].alias("data")), result)


def read_extract(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    fmt: str = "json",
    multiline: bool = False,
    result: str | None = None,
    identity: Iterable[str] = (),
    whole: bool = True,
) -> DataFrame:
    """Read one landed extract with a declared schema.

    ``result`` names the list inside a response envelope; ``identity`` the
    fields that every record must have (``whole``), or at least one of (else: the reject channel sees to the others).
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    if fmt == "parquet":
        require_fields(spark.read.parquet(*([path] if isinstance(path, str) else path)), identity)
    if fmt == "json" and multiline:
        df = read_records(spark, path, schema, result)
    else:
        reader = spark.read.schema(_envelope(schema, result) if result else schema)
        df = reader.format(fmt).option("mode", "FAILFAST").load(path)
        df = unwrapped(df, result) if result else df
    if not identity:
        return df
    return complete(df, identity, str(path)) if whole else identified(df, identity, str(path))


def read_sales(
    spark: SparkSession, path, fmt: str = "json", multiline: bool = False, result: str | None = None, whole: bool = True
) -> DataFrame:
    return read_extract(spark, path, schemas.SALES, fmt, multiline, result, IDENTITY["sales"], whole)


def read_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    span: tuple | None = None,
    partition_col: str = "invoice_month",
) -> DataFrame:
    """Read a month-partitioned parquet landing (see ``sinks.landing``).

    With ``span=(start, end)`` only the months it touches are read: the
    filter is on the partition column, so the planner prunes the other
    folders (``PartitionFilters``). Row filters on the timestamp itself are
    still needed and are applied by the reports.
    """
    fields = list(schema.fields) + [T.StructField(partition_col, T.StringType(), True)]
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    if span is not None:
        lo, hi = span
        df = df.filter(F.col(partition_col).between(F.lit(lo.strftime("%Y-%m")), F.lit(hi.strftime("%Y-%m"))))
    return df


def read_targets(
    spark: SparkSession, path, fmt: str = "json", multiline: bool = False, result: str | None = None, whole: bool = True
) -> DataFrame:
    return read_extract(spark, path, schemas.TARGETS, fmt, multiline, result, IDENTITY["targets"], whole)


def read_lots(
    spark: SparkSession, path, fmt: str = "json", multiline: bool = False, result: str | None = None, whole: bool = True
) -> DataFrame:
    return read_extract(spark, path, schemas.LOTS, fmt, multiline, result, IDENTITY["lots"], whole)


def read_lots_wide(
    spark: SparkSession, path, fmt: str = "json", multiline: bool = False, result: str | None = None, whole: bool = True
) -> DataFrame:
    return read_extract(spark, path, schemas.LOTS_WIDE, fmt, multiline, result, IDENTITY["lots_wide"], whole)


def reject_rules(name: str) -> dict[str, Column]:
    """The rules by which records of an extract are rejected rather than fail the job."""
    rules = missing(*IDENTITY[name])
    if name == "lots":
        text = F.col("invoice.invoicedate")
        blank = F.coalesce(F.trim(text) == F.lit(""), F.lit(True))
        rules["unreadable invoice.invoicedate"] = ~blank & parse_timestamp(text, strict=False).isNull()
    return rules


# --- nested -> flat -----------------------------------------------------------

# (leaf path inside a product element, canonical line column)
_LINE_LEAVES = (
    ("purchaseProductDetails.category.name", "category"),
    ("soldqty", "soldqty"),
    ("sellingprice", "sellingprice"),
    ("servicecharge", "servicecharge"),
    ("gst", "gst"),
    ("lotDetails.rate", "rate"),
    ("lotDetails.discount", "discount"),
    ("lotDetails.cnStockproduct", "cn_stock"),
    ("lotDetails.subqty", "subqty"),
    ("lotDetails.transportCharges", "transport_charges"),
    ("lotDetails.otherCharges", "other_charges"),
)


def sale_lines_frame(invoices: DataFrame, id_field: str = "_id") -> DataFrame:
    """One row per invoice line, carrying its own invoice's attributes.

    ``id_field`` names the invoice: documents that hold a part of an invoice
    each share its ``invoiceno``.

    ``arrays_zip`` of just the needed leaves before ``explode`` keeps the
    parquet read schema to those leaves (exploding whole ``product``
    elements would read every field). An invoice with an empty or null
    ``product`` contributes no line.
    """
    zipped = F.arrays_zip(*[F.col(f"product.{p}").alias(a) for p, a in _LINE_LEAVES])
    exploded = invoices.select(
        F.col(id_field).alias("invoice_id"),
        F.col("invoicedate"),
        F.col("storeDetails.name").alias("store"),
        F.col("storeDetails.territory.name").alias("territory"),
        F.col("customerDetails.name").alias("customer"),
        F.explode(zipped).alias("p"),
    )
    numeric = {a for _, a in _LINE_LEAVES if a != "category"}
    return exploded.select(
        "invoice_id",
        "invoicedate",
        "store",
        "territory",
        "customer",
        *[
            (clean_double(F.col(f"p.{a}")) if a in numeric else F.col(f"p.{a}")).alias(a)
            for _, a in _LINE_LEAVES
        ],
    ).select(*schemas.LINE_COLUMNS)


def invoice_frame(invoices: DataFrame) -> DataFrame:
    """Invoice-level columns (customer counts use invoices, not lines)."""
    return invoices.select(
        F.col("_id").alias("invoice_id"),
        F.col("invoicedate"),
        F.col("storeDetails.name").alias("store"),
        F.col("storeDetails.territory.name").alias("territory"),
        F.col("customerDetails.name").alias("customer"),
    )


def reassembled(invoices: DataFrame) -> DataFrame:
    """One document for each ``invoiceno`` of documents that hold parts of invoices (``_id``: ``<invoiceno>-<group>-<run>``).

    Products keep their order. An invoice's parts meet in one row, so this is for
    what is bounded by an invoice; reports read the parts as they are.
    """
    part = F.transform(F.split(F.substring_index("_id", "-", -2), "-"), lambda n: n.cast("long"))
    same = [c for c in invoices.columns if c not in ("_id", "invoiceno", "product")]
    parts = F.sort_array(F.collect_list(F.struct(part.alias("part"), F.col("product"))))
    whole = invoices.groupBy("invoiceno").agg(*[F.first(c).alias(c) for c in same], parts.alias("parts"))
    return whole.select(F.col("invoiceno").alias("_id"), "invoiceno", *same, F.flatten("parts.product").alias("product"))


def targets_frame(targets: DataFrame) -> DataFrame:
    return targets.select(
        F.col("Store"),
        F.col("TM"),
        F.col("Category"),
        F.col("Date"),
        clean_double(F.col("Daily_Target")).alias("Daily_Target"),
    )


def lots_frame(lots: DataFrame, timestamp_formats=None, strict: bool = True) -> DataFrame:
    """Flat narrow lot frame; the invoice date text is parsed from mixed layouts.

    ``strict=False`` for accepted records of the same plan: the planner may parse a
    record's date before it drops the record, and a date that can't be read must not raise there.
    """
    inv = F.col("invoice.invoicedate")
    parsed = inv if isinstance(lots.schema["invoice"].dataType["invoicedate"].dataType, T.TimestampType) \
        else parse_timestamp(inv, timestamp_formats, strict=strict)
    return lots.select(
        F.col("storeDetails.name").alias("store"),
        F.col("storeDetails.territory.name").alias("territory"),
        F.col("productDetails.category.name").alias("category"),
        F.col("status"),
        clean_double(F.col("rate")).alias("rate"),
        clean_double(F.col("subqty")).alias("subqty"),
        clean_double(F.col("soldqty")).alias("soldqty"),
        F.col("expirydate"),
        parsed.alias("invoicedate"),
    )


def lots_wide_frame(lots: DataFrame) -> DataFrame:
    """Expand the nested BI lot record into named flat columns."""
    return lots.select(
        "_id",
        "id",
        "createddate",
        "receiveddate",
        "dateofmanufacturing",
        "expirydate",
        F.col("gst").alias("gst_pct"),
        F.col("rate").alias("purchasingprice_unit_xgst"),
        F.col("sellingprice").alias("sellingprice_unit_igst"),
        F.bround("subqty").cast("long").alias("subqty"),
        F.bround("soldqty").cast("long").alias("soldqty"),
        "status",
        "cnStockproduct",
        "transportCharges",
        "otherCharges",
        "store_ref",
        F.col("invoice.invoiceno").alias("invoiceno"),
        F.col("invoice.invoicedate").alias("invoicedate"),
        F.col("invoice.po_ref").alias("po_ref"),
        F.col("invoice.rate").alias("invoice_amount"),
        F.col("invoice.total").alias("invoice_amount_xgst"),
        F.col("productDetails.name").alias("product_name"),
        F.col("productDetails.category.name").alias("category_name"),
        F.col("productDetails.sub_category.name").alias("sub_category_name"),
        F.col("productDetails.manufacturer.name").alias("manufacturer_name"),
        F.col("supplier.id").alias("supplier_id"),
        F.col("supplier.name").alias("supplier_name"),
        F.col("supplier.gstnumber").alias("supplier_gstnumber"),
        F.col("storeDetails.name").alias("store"),
        F.col("storeDetails.vertical").alias("vertical"),
        F.col("landingrate").cast("double").alias("landingrate"),
    )
