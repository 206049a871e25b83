"""Explicit schemas for the landed extracts and the flat working frames.

Reading with a declared schema means no inference pass over 100 TB, missing
fields become null, and nested column pruning can reach individual leaves.
Field names are fixed values: they are those of the extracts.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


STR = T.StringType()
DBL = T.DoubleType()
TS = T.TimestampType()
LONG = T.LongType()


def _named() -> T.StructType:
    return _s(_f("name", STR))


# --- sales invoices: one row per invoice, lines nested in ``product`` -------
PRODUCT = _s(
    _f("soldqty", DBL),
    _f("servicecharge", DBL),
    _f("extradiscount", DBL),
    _f("sellingprice", DBL),
    _f("gst", DBL),
    _f(
        "purchaseProductDetails",
        _s(
            _f("name", STR),
            _f("category", _named()),
            _f("manufacturer", _named()),
            _f("sub_category", _named()),
        ),
    ),
    _f(
        "lotDetails",
        _s(
            _f("discount", DBL),
            _f("rate", DBL),
            _f("id", STR),
            _f("sellingprice", DBL),
            _f(
                "invoice",
                _s(
                    _f("supplier_ref", STR),
                    _f("invoiceno", STR),
                    _f("createddate", STR),
                    _f("invoicedate", STR),
                ),
            ),
            _f("cnStockproduct", DBL),
            _f("subqty", DBL),
            _f("transportCharges", DBL),
            _f("otherCharges", DBL),
            _f("landingrate", DBL),
        ),
    ),
    _f("supplierDetails", _named()),
    _f("storeTargetPerProduct", DBL),
)

SALES = _s(
    _f("_id", STR),
    _f(
        "customerDetails",
        _s(
            _f("name", STR),
            _f("onboarding_date", STR),
            _f("village", _named()),
            _f("pincode", _s(_f("code", STR))),
            _f("cust_type", STR),
            _f("GSTIN", STR),
            _f("iscouponapplicable", T.BooleanType()),
            _f("address", _s(_f("city", STR), _f("street", STR), _f("pincode", STR))),
            _f("phone", STR),
            _f("customer_uid", STR),
        ),
    ),
    _f(
        "storeDetails",
        _s(
            _f("name", STR),
            _f("address", _s(_f("pincode", STR))),
            _f("vertical", STR),
            _f("territory", _s(_f("name", STR), _f("zone", _named()))),
        ),
    ),
    _f("userDetails", _s(_f("name", STR), _f("address", _s(_f("pincode", STR))))),
    _f("invoiceno", STR),
    _f("invoicedate", TS),
    _f("product", T.ArrayType(PRODUCT, True)),
    _f("payment", _s(_f("card", DBL), _f("cash", DBL), _f("upi", DBL))),
    _f("grosstotal", DBL),
    _f("storeCost", DBL),
)

# --- daily store targets (flat) -------------------------------------------
TARGETS = _s(
    _f("Store", STR),
    _f("TM", STR),
    _f("Category", STR),
    _f("Month", STR),
    _f("Year", STR),
    _f("Target", DBL),
    _f("Date", TS),
    _f("Daily_Target", DBL),
)

# --- inventory lots, narrow (report scripts) --------------------------------
# ``invoice.invoicedate`` arrives in mixed text layouts, so it is text here
# and parsed by ``readers.lots_frame``.
LOTS = _s(
    _f("storeDetails", _s(_f("name", STR), _f("territory", _named()))),
    _f("qty", DBL),
    _f("expirydate", TS),
    _f("status", STR),
    _f("rate", DBL),
    _f("subqty", DBL),
    _f("soldqty", DBL),
    _f("productDetails", _s(_f("category", _named()))),
    _f("invoice", _s(_f("invoicedate", STR), _f("invoiceno", STR))),
)

# --- inventory lots, wide (BI model) ----------------------------------------
LOTS_WIDE = _s(
    _f("_id", STR),
    _f("id", STR),
    _f("createddate", TS),
    _f("receiveddate", TS),
    _f("dateofmanufacturing", TS),
    _f("expirydate", TS),
    _f("gst", DBL),
    _f("rate", DBL),
    _f("landingrate", DBL),
    _f("sellingprice", DBL),
    _f("subqty", DBL),
    _f("soldqty", DBL),
    _f("status", STR),
    _f("cnStockproduct", DBL),
    _f("transportCharges", DBL),
    _f("otherCharges", DBL),
    _f("store_ref", STR),
    _f(
        "invoice",
        _s(
            _f("invoiceno", STR),
            _f("invoicedate", TS),
            _f("po_ref", STR),
            _f("rate", DBL),
            _f("total", DBL),
        ),
    ),
    _f(
        "productDetails",
        _s(
            _f("name", STR),
            _f("category", _named()),
            _f("sub_category", _named()),
            _f("manufacturer", _named()),
        ),
    ),
    _f("supplier", _s(_f("id", STR), _f("name", STR), _f("gstnumber", STR))),
    _f("storeDetails", _s(_f("name", STR), _f("vertical", STR))),
)

# --- flat working frames ----------------------------------------------------
# One row per sale line; every sales report reads only these columns.
LINE_COLUMNS = (
    "invoice_id",
    "invoicedate",
    "store",
    "territory",
    "customer",
    "category",
    "soldqty",
    "sellingprice",
    "servicecharge",
    "gst",
    "rate",
    "discount",
    "cn_stock",
    "subqty",
    "transport_charges",
    "other_charges",
)

# One row per inventory lot (narrow).
LOT_COLUMNS = (
    "store",
    "territory",
    "category",
    "status",
    "rate",
    "subqty",
    "soldqty",
    "expirydate",
    "invoicedate",
)

# Flat BI lot table after expanding and renaming the nested record.
LOT_WIDE_COLUMNS = (
    "_id",
    "id",
    "createddate",
    "receiveddate",
    "dateofmanufacturing",
    "expirydate",
    "gst_pct",
    "purchasingprice_unit_xgst",
    "sellingprice_unit_igst",
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
    "store",
    "vertical",
    "landingrate",
)
