"""Reference SQL for every registered query, for DuckDB over the same tables.

Written independently of the Spark code: windows are a joined table of
three rows, dense grids a cross product of keys and labels, running totals
a non-equi join, fiscal-year labels a literal CASE chain. The driver tables
(``lineitem``, ``orders``, ...) are expected as views.
"""

from __future__ import annotations

from .registry import FIXTURE_AS_OF, FIXTURE_EXCLUDED, FIXTURE_FISCAL_YEARS


def _ts(value) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


def _excl_list() -> str:
    return ", ".join(f"'{n}'" for n in FIXTURE_EXCLUDED)


def _kept(col: str) -> str:
    return f"({col} IS NULL OR {col} NOT IN ({_excl_list()}))"


AS_OF = _ts(FIXTURE_AS_OF)
AS_OF_DATE = f"DATE '{FIXTURE_AS_OF.strftime('%Y-%m-%d')}'"

# The windows from DuckDB's own calendar: all end the day after the latest Monday; the
# week starts on the Monday before it, the month and the fiscal year contain that Monday.
WINDOWS = f"""mon AS (SELECT date_trunc('week', {AS_OF_DATE})::DATE AS latest),
bounds AS (
  SELECT latest - 7 AS week_start, date_trunc('month', latest - 7)::DATE AS month_start,
         make_date(year(latest - 7) - CASE WHEN month(latest - 7) < 4 THEN 1 ELSE 0 END, 4, 1) AS fy_start,
         latest + 1 + TIME '23:59:59' AS we
  FROM mon),
win AS (
  SELECT 1 AS window_seq, 'week' AS window_name, week_start::TIMESTAMP AS ws, we FROM bounds
  UNION ALL SELECT 2, 'month', month_start::TIMESTAMP, we FROM bounds
  UNION ALL SELECT 3, 'fy', fy_start::TIMESTAMP, we FROM bounds)"""

HDR = """hdr AS (
  SELECT o.o_orderkey AS invoice_id, o.o_orderdate AS invoicedate,
         'STORE ' || n.n_name || ' ' || c.c_mktsegment AS store,
         n.n_name AS territory, c.c_name AS customer
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

LINES = """lines AS (
  SELECT h.invoice_id, h.invoicedate, h.store, h.territory, h.customer,
         p.p_type AS category,
         l.l_quantity AS soldqty,
         l.l_extendedprice / l.l_quantity AS sellingprice,
         CAST(p.p_size AS DOUBLE) AS servicecharge,
         round(abs(l.l_tax) * 100.0) AS gst,
         p.p_retailprice AS rate,
         p.p_retailprice * abs(l.l_discount) AS discount,
         CASE WHEN l.l_returnflag = 'R' THEN p.p_retailprice ELSE CAST(0 AS DOUBLE) END AS cn_stock,
         l.l_quantity + p.p_size - 2 AS subqty,
         s.s_acctbal / 100.0 AS transport_charges,
         CAST(p.p_size AS DOUBLE) AS other_charges
  FROM lineitem l
  JOIN hdr h ON l.l_orderkey = h.invoice_id
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

ECON = """econ AS (
  SELECT *,
    soldqty * (sellingprice / (1.0 + gst / 100.0) + servicecharge / CAST(1.18 AS DOUBLE)) AS sale_value,
    soldqty * (sellingprice / (1.0 + gst / 100.0) + servicecharge / (1.0 + gst / 100.0)) AS sale_value_line_rate,
    soldqty * (rate - discount) AS purchase_net,
    soldqty * rate AS purchase_gross,
    soldqty * (sellingprice / (1.0 + gst / 100.0) + servicecharge / (1.0 + gst / 100.0))
      - (soldqty * (rate - discount)
         - soldqty * (cn_stock / nullif(subqty, 0))
         + soldqty * (transport_charges / nullif(subqty, 0))
         + soldqty * (other_charges / nullif(subqty, 0))) AS margin
  FROM lines)"""

TARGETS = """targets AS (
  SELECT h.invoicedate AS "Date", h.store AS "Store", h.territory AS "TM", p.p_type AS "Category",
         sum(l.l_extendedprice) * 1.1 AS "Daily_Target"
  FROM lineitem l
  JOIN hdr h ON l.l_orderkey = h.invoice_id
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2, 3, 4)"""

LOTS = f"""lots AS (
  SELECT s.s_name AS store, CASE WHEN s.s_suppkey % 7 <> 0 THEN sn.n_name END AS territory, p.p_type AS category,
         CASE WHEN l.l_linenumber <> 7 THEN
           CASE l.l_returnflag WHEN 'R' THEN 'creditnote' WHEN 'A' THEN 'InStock' WHEN 'N' THEN 'Sold' END END AS status,
         p.p_retailprice AS rate, l.l_quantity AS subqty,
         least(l.l_quantity, CAST(p.p_size AS DOUBLE)) AS soldqty,
         CASE WHEN p.p_size % 10 <> 0 THEN l.l_shipdate + to_days(p.p_size * 10) END AS expirydate,
         o.o_orderdate AS invoicedate
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey),
lot_vals AS (
  SELECT *,
    CASE WHEN status = 'creditnote' THEN subqty ELSE 0 END AS returned_qty,
    subqty - (soldqty - CASE WHEN status = 'creditnote' THEN subqty ELSE 0 END) AS quantity,
    (subqty - (soldqty - CASE WHEN status = 'creditnote' THEN subqty ELSE 0 END)) * rate AS value,
    CAST(floor((epoch_us({AS_OF}) - epoch_us(invoicedate)) / 86400000000.0) AS BIGINT) AS age_days,
    CAST(floor((epoch_us(expirydate) - epoch_us({AS_OF})) / 86400000000.0) AS BIGINT) AS expiry_days
  FROM lots)"""

# Two of the extract's four date layouts carry no time of day.
_DATED_BY_LAYOUT = (
    "CASE WHEN l.l_linenumber % 4 < 2 THEN date_trunc('second', o.o_orderdate) ELSE date_trunc('day', o.o_orderdate) END AS invoicedate"
)

LABELS = "labels(bucket_seq, bucket) AS (VALUES (1, '1-45 days'), (2, '46-90 days'), (3, '91-135 days'), (4, '135+ days'))"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _total(measure_sql: str, alias: str, source: str = "econ", ts: str = "invoicedate") -> str:
    return (
        f"SELECT w.window_seq, w.window_name, round(coalesce(sum({measure_sql}), 0) / 100000.0, 2) AS {alias}\n"
        f"FROM win w LEFT JOIN {source} e ON e.{ts} BETWEEN w.ws AND w.we\n"
        f"GROUP BY w.window_seq, w.window_name"
    )


def _keyed(key: str, out_key: str, measure: str, alias: str, exclude_col: str | None,
           source: str = "econ", ts: str = "invoicedate", only_window: str | None = None) -> str:
    cond = [f"e.{key} IS NOT NULL"]
    if exclude_col:
        cond.append(_kept(f"e.{exclude_col}"))
    if only_window:
        cond.append(f"w.window_name = '{only_window}'")
    return (
        f"SELECT e.{key} AS {out_key}, w.window_seq, w.window_name,\n"
        f"       round(coalesce(sum(e.{measure}), 0) / 100000.0, 2) AS {alias}\n"
        f"FROM win w JOIN {source} e ON e.{ts} BETWEEN w.ws AND w.we\n"
        f"WHERE {' AND '.join(cond)}\n"
        f"GROUP BY e.{key}, w.window_seq, w.window_name"
    )


# The windows of eight weekly reports: the fixture's clock and the same instant of the weeks before.
CLOCK_WINDOWS = f"""clk AS (SELECT {AS_OF} - to_days(CAST(7 * k AS INTEGER)) AS as_of FROM range(8) t(k)),
clk_mon AS (SELECT as_of, date_trunc('week', as_of)::DATE AS latest FROM clk),
clk_bounds AS (
  SELECT as_of, latest - 7 AS week_start, date_trunc('month', latest - 7)::DATE AS month_start,
         make_date(year(latest - 7) - CASE WHEN month(latest - 7) < 4 THEN 1 ELSE 0 END, 4, 1) AS fy_start,
         latest + 1 + TIME '23:59:59' AS we
  FROM clk_mon),
win AS (
  SELECT as_of, 1 AS window_seq, 'week' AS window_name, week_start::TIMESTAMP AS ws, we FROM clk_bounds
  UNION ALL SELECT as_of, 2, 'month', month_start::TIMESTAMP, we FROM clk_bounds
  UNION ALL SELECT as_of, 3, 'fy', fy_start::TIMESTAMP, we FROM clk_bounds)"""


def _history(key: str | None, out_key: str, measures: dict[str, str], excluded: bool, source: str = "econ", ts: str = "invoicedate") -> str:
    sums = ", ".join(f"round(coalesce(sum({m}), 0) / 100000.0, 2) AS {a}" for a, m in measures.items())
    if key is None:
        return (
            f"SELECT w.as_of, w.window_seq, w.window_name, {sums} FROM win w LEFT JOIN {source} e ON e.{ts} BETWEEN w.ws AND w.we\n"
            "GROUP BY ALL"
        )
    kept = f" AND {_kept('e.territory')}" if excluded else ""
    return (
        f"SELECT e.{key} AS {out_key}, w.as_of, w.window_seq, w.window_name, {sums}\n"
        f"FROM win w JOIN {source} e ON e.{ts} BETWEEN w.ws AND w.we WHERE e.{key} IS NOT NULL{kept} GROUP BY ALL"
    )


def _running_history() -> str:
    return (
        "per AS (SELECT e.category AS k, w.as_of, w.window_seq, sum(e.margin) AS s\n"
        f"  FROM win w JOIN econ e ON e.invoicedate BETWEEN w.ws AND w.we WHERE e.category IS NOT NULL AND {_kept('e.territory')} GROUP BY ALL)\n"
        "SELECT p.k AS category, w.as_of, w.window_seq, w.window_name, round(sum(coalesce(p.s, 0)) / 100000.0, 2) AS margin_lakh\n"
        "FROM win w JOIN per p ON p.as_of = w.as_of AND p.window_seq <= w.window_seq GROUP BY ALL"
    )


# Lots of 7 or 11 pieces carry a date that is none; those of 13 have no rate.
FAULTY_LOTS = """faulty AS (
  SELECT *, CASE WHEN store IS NULL THEN 'no storeDetails.name' WHEN category IS NULL THEN 'no productDetails.category.name'
                 WHEN subqty IN (7, 11) THEN 'unreadable invoice.invoicedate' END AS reject_reason,
         CASE WHEN subqty <> 13 THEN value END AS kept_value
  FROM lot_vals)"""


def _running_margin(key: str) -> str:
    return _with(WINDOWS, HDR, LINES, ECON) + ", " + (
        "per AS (\n"
        f"  SELECT e.{key} AS k, w.window_seq, sum(e.margin) AS s\n"
        "  FROM win w JOIN econ e ON e.invoicedate BETWEEN w.ws AND w.we\n"
        f"  WHERE e.{key} IS NOT NULL AND {_kept('e.territory')}\n"
        f"  GROUP BY e.{key}, w.window_seq)\n"
        f"SELECT p.k AS {key}, w.window_seq, w.window_name,\n"
        "       round(sum(coalesce(p.s, 0)) / 100000.0, 2) AS margin_lakh\n"
        "FROM win w JOIN per p ON p.window_seq <= w.window_seq\n"
        "GROUP BY p.k, w.window_seq, w.window_name"
    )


def _grid(key: str, days: str, open_low: bool, exclude: bool, wide: bool = False) -> str:
    low = "" if open_low else f"WHEN {days} <= 1 THEN NULL "
    seq = (
        f"CASE WHEN {days} IS NULL THEN NULL {low}WHEN {days} <= 45 THEN 1 "
        f"WHEN {days} <= 90 THEN 2 WHEN {days} <= 135 THEN 3 ELSE 4 END"
    )
    keep = f"{key} IS NOT NULL" + (f" AND {_kept('territory')}" if exclude else "")
    body = (
        f"keys AS (SELECT DISTINCT {key} AS k FROM lot_vals WHERE {keep}),\n"
        f"sums AS (SELECT {key} AS k, {seq} AS bseq, sum(value) AS s FROM lot_vals WHERE {keep} GROUP BY 1, 2),\n"
        "grid AS (\n"
        f"  SELECT k.k AS {key}, lb.bucket_seq, lb.bucket, round(coalesce(s.s, 0) / 100000.0, 2) AS value_lakh\n"
        "  FROM keys k CROSS JOIN labels lb LEFT JOIN sums s ON s.k = k.k AND s.bseq = lb.bucket_seq)\n"
    )
    if not wide:
        return body + "SELECT * FROM grid"
    names = ["days_1_45", "days_46_90", "days_91_135", "days_135_plus"]
    cols = ", ".join(f"max(CASE WHEN bucket_seq = {i + 1} THEN value_lakh END) AS {n}" for i, n in enumerate(names))
    return body + f"SELECT {key}, {cols} FROM grid GROUP BY {key}"


LOTS_WIDE = """lw AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS _id,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS id,
         o.o_orderdate AS createddate, l.l_shipdate AS receiveddate, o.o_orderdate AS dateofmanufacturing,
         CASE WHEN p.p_size % 10 <> 0 THEN l.l_shipdate + to_days(p.p_size * 10) END AS expirydate,
         round(abs(l.l_tax) * 100.0) AS gst_pct,
         p.p_retailprice AS purchasingprice_unit_xgst,
         l.l_extendedprice / l.l_quantity AS sellingprice_unit_igst,
         CAST(l.l_quantity AS BIGINT) AS subqty,
         CAST(least(l.l_quantity, CAST(p.p_size AS DOUBLE)) AS BIGINT) AS soldqty,
         CASE WHEN l.l_linenumber <> 7 THEN
           CASE l.l_returnflag WHEN 'R' THEN 'CreditNote' WHEN 'A' THEN 'InStock' WHEN 'N' THEN 'Sold' END END AS status,
         CASE WHEN l.l_returnflag = 'R' THEN p.p_retailprice ELSE CAST(0 AS DOUBLE) END AS cnStockproduct,
         s.s_acctbal / 100.0 AS transportCharges,
         CAST(p.p_size AS DOUBLE) AS otherCharges,
         CAST(s.s_suppkey AS VARCHAR) AS store_ref,
         CAST(o.o_orderkey AS VARCHAR) AS invoiceno,
         o.o_orderdate AS invoicedate,
         CAST(o.o_custkey AS VARCHAR) AS po_ref,
         o.o_totalprice AS invoice_amount,
         round(o.o_totalprice / CAST(1.18 AS DOUBLE), 2) AS invoice_amount_xgst,
         p.p_name AS product_name, p.p_type AS category_name, p.p_name AS sub_category_name,
         p.p_brand AS manufacturer_name,
         CAST(s.s_suppkey AS VARCHAR) AS supplier_id, s.s_name AS supplier_name,
         'GSTIN' || CAST(s.s_suppkey AS VARCHAR) AS supplier_gstnumber,
         s.s_name || ' STORE' AS store, sr.r_name AS vertical, p.p_retailprice AS landingrate
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey)"""


def _fy_case() -> str:
    parts = ["CASE WHEN invoicedate IS NULL THEN 'None'"]
    for y in range(FIXTURE_FISCAL_YEARS[0], FIXTURE_FISCAL_YEARS[1] + 1):
        parts.append(
            f"WHEN invoicedate >= TIMESTAMP '{y}-04-01 00:00:00' AND invoicedate < TIMESTAMP '{y + 1}-04-01 00:00:00' "
            f"THEN 'FY{y % 100:02d}-{(y + 1) % 100:02d}'"
        )
    parts.append("ELSE 'None' END")
    return " ".join(parts)


MODEL = f"""m1 AS (
  SELECT *,
    sellingprice_unit_igst / (1.0 + gst_pct / 100.0) AS sellingprice_unit_xgst,
    {_fy_case()} AS fiscal_year,
    CAST(CASE WHEN status = 'CreditNote' THEN subqty ELSE 0 END AS DOUBLE) AS returned_qty,
    CAST(subqty - (soldqty + CASE WHEN status = 'CreditNote' THEN subqty ELSE 0 END) AS BIGINT) AS available_qty,
    CAST(date_diff('day', CAST(invoicedate AS DATE), {AS_OF_DATE}) AS BIGINT) AS inventory_age_days,
    CAST(date_diff('day', {AS_OF_DATE}, CAST(expirydate AS DATE)) AS BIGINT) AS expiry_clock
  FROM lw),
m2 AS (
  SELECT *,
    CAST(CASE WHEN coalesce(contains(status, 'Stock'), false) THEN expiry_clock ELSE 0 END AS BIGINT) AS expiry_clock_stock
  FROM m1),
m3 AS (
  SELECT *,
    available_qty * purchasingprice_unit_xgst AS current_inventory_value,
    soldqty * purchasingprice_unit_xgst AS sold_inventory_value,
    returned_qty * purchasingprice_unit_xgst AS returned_inventory,
    inventory_age_days / CAST(7 AS DOUBLE) AS inventory_age_weeks,
    inventory_age_days / CAST(30 AS DOUBLE) AS inventory_age_months,
    CASE WHEN expiry_clock_stock IS NULL THEN NULL
         WHEN expiry_clock_stock <= 0 THEN 'Expired'
         WHEN expiry_clock_stock <= 7 THEN '< 1wk'
         WHEN expiry_clock_stock <= 15 THEN '1wk-2wk'
         WHEN expiry_clock_stock <= 30 THEN '2wk-1m'
         WHEN expiry_clock_stock <= 90 THEN '1m-3m'
         WHEN expiry_clock_stock <= 180 THEN '3m-6m'
         ELSE '> 6m' END AS expiry_filter,
    CASE WHEN expiry_clock_stock IS NULL THEN NULL
         WHEN expiry_clock_stock <= 0 THEN 0
         WHEN expiry_clock_stock <= 7 THEN 1
         WHEN expiry_clock_stock <= 15 THEN 2
         WHEN expiry_clock_stock <= 30 THEN 3
         WHEN expiry_clock_stock <= 90 THEN 4
         WHEN expiry_clock_stock <= 180 THEN 5
         ELSE 6 END AS exp_seq,
    CASE WHEN strpos(store, ' ') = 0 THEN store
         ELSE left(store, length(store) - strpos(reverse(store), ' ')) END AS first_store_name,
    purchasingprice_unit_xgst * subqty - cnStockproduct AS cndiff,
    available_qty * sellingprice_unit_xgst AS current_inventory_selling_price,
    CAST(invoicedate AS DATE) AS invoicedate_relationship
  FROM m2),
model AS (
  SELECT *,
    purchasingprice_unit_xgst * inventory_age_days * available_qty
      / (SELECT CAST(sum(CAST(current_inventory_value AS DECIMAL(38, 6))) AS DOUBLE) FROM m3) AS average_inventory_age
  FROM m3)"""

MODEL_COLUMNS = (
    "_id, id, createddate, receiveddate, dateofmanufacturing, expirydate, gst_pct, purchasingprice_unit_xgst, "
    "sellingprice_unit_igst, sellingprice_unit_xgst, subqty, soldqty, status, cnStockproduct, transportCharges, "
    "otherCharges, store_ref, invoiceno, invoicedate, po_ref, invoice_amount, invoice_amount_xgst, product_name, "
    "category_name, sub_category_name, manufacturer_name, supplier_id, supplier_name, supplier_gstnumber, "
    "fiscal_year, returned_qty, available_qty, current_inventory_value, sold_inventory_value, returned_inventory, "
    "inventory_age_days, inventory_age_weeks, inventory_age_months, store, vertical, landingrate, expiry_clock, "
    "expiry_clock_stock, expiry_filter, exp_seq, first_store_name, average_inventory_age, "
    "cndiff, current_inventory_selling_price, invoicedate_relationship"
)


def _scorecard(key: str, tkey: str, target_excluded: bool, margin_running: bool, margin_fy_only: bool) -> str:
    t_keep = f'e."{tkey}" IS NOT NULL' + (f' AND {_kept(chr(34) + "TM" + chr(34))}' if target_excluded else "")
    t = (
        f't AS (SELECT e."{tkey}" AS k, w.window_name, round(coalesce(sum(e."Daily_Target"), 0) / 100000.0, 2) AS v\n'
        f'  FROM win w JOIN targets e ON e."Date" BETWEEN w.ws AND w.we WHERE {t_keep} GROUP BY 1, 2)'
    )
    a = (
        f"a AS (SELECT e.{key} AS k, w.window_name, round(coalesce(sum(e.sale_value), 0) / 100000.0, 2) AS v\n"
        f"  FROM win w JOIN econ e ON e.invoicedate BETWEEN w.ws AND w.we\n"
        f"  WHERE e.{key} IS NOT NULL AND {_kept('e.territory')} GROUP BY 1, 2)"
    )
    per = (
        f"per AS (SELECT e.{key} AS k, w.window_seq, w.window_name, sum(e.margin) AS s\n"
        f"  FROM win w JOIN econ e ON e.invoicedate BETWEEN w.ws AND w.we\n"
        f"  WHERE e.{key} IS NOT NULL AND {_kept('e.territory')} GROUP BY 1, 2, 3)"
    )
    if margin_running:
        m = (
            "m AS (SELECT p.k, w.window_name, round(sum(coalesce(p.s, 0)) / 100000.0, 2) AS v\n"
            "  FROM win w JOIN per p ON p.window_seq <= w.window_seq GROUP BY 1, 2)"
        )
    else:
        m = "m AS (SELECT k, window_name, round(coalesce(s, 0) / 100000.0, 2) AS v FROM per)"
    u = (
        "u AS (SELECT k, 'target' AS metric, window_name, v FROM t\n"
        "  UNION ALL SELECT k, 'achieved', window_name, v FROM a\n"
        "  UNION ALL SELECT k, 'margin', window_name, v FROM m)"
    )
    cols = []
    for w in ("week", "month", "fy"):
        for metric in ("target", "achieved", "margin"):
            if metric == "margin" and margin_fy_only and w != "fy":
                continue
            cols.append(f"max(CASE WHEN metric = '{metric}' AND window_name = '{w}' THEN v END) AS {metric}_{w}")
    return _with(WINDOWS, HDR, LINES, ECON, TARGETS, t, a, per, m, u) + (
        f"SELECT k AS {key}, " + ", ".join(cols) + " FROM u GROUP BY k"
    )


def oracle_sql() -> dict[str, str]:
    sales = _with(WINDOWS, HDR, LINES, ECON)
    tgt = _with(WINDOWS, HDR, TARGETS)
    inv = _with(LOTS, LABELS)
    model = _with(LOTS_WIDE, MODEL)
    return {
        "report_windows": _with(WINDOWS, HDR, LINES)
        + "SELECT w.window_seq, w.window_name, w.ws AS window_start, w.we AS window_end,\n"
        "       count(DISTINCT l.invoice_id) AS invoices, count(l.invoice_id) AS lines\n"
        "FROM win w LEFT JOIN lines l ON l.invoicedate BETWEEN w.ws AND w.we\n"
        "GROUP BY w.window_seq, w.window_name, w.ws, w.we",
        "sale_line_economics": _with(HDR, LINES, ECON)
        + "SELECT invoice_id, store, territory, category, soldqty,\n"
        "  sale_value, sale_value_line_rate, purchase_net, purchase_gross, margin FROM econ",
        "extract_sale_lines": _with(HDR, LINES) + "SELECT * FROM lines",
        "extract_invoices": _with(HDR) + "SELECT invoice_id, invoicedate, store, territory, customer FROM hdr",
        "extract_targets": _with(HDR, TARGETS)
        + 'SELECT "Store", "TM", "Category", "Date", CASE WHEN day("Date") <> 13 THEN round("Daily_Target", 4) END AS "Daily_Target" FROM targets',
        # Orders of up to 64 lines: documents of four lines each.
        "extract_documents": "WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)\n"
        "SELECT CAST(o_orderkey AS VARCHAR) AS invoiceno, greatest(1, (coalesce(n, 0) + 3) // 4) AS documents, coalesce(n, 0) AS lines,\n"
        "  CAST(least(4, coalesce(n, 0)) AS INTEGER) AS most_lines, CAST(coalesce(n, 0) AS INTEGER) AS reassembled_lines\n"
        "FROM orders LEFT JOIN c ON o_orderkey = l_orderkey",
        "extract_rejects": inv + ", " + FAULTY_LOTS + "\n"
        "SELECT 'sales' AS extract, CASE WHEN o_orderkey % 101 = 0 THEN 'no _id' WHEN o_orderkey % 103 = 0 OR o_orderdate IS NULL THEN 'no invoicedate' END AS reject_reason,\n"
        "  count(*) AS records FROM orders GROUP BY ALL\n"
        "UNION ALL SELECT 'lots', reject_reason, count(*) FROM faulty GROUP BY ALL",
        "extract_accepted_value": inv + ", " + FAULTY_LOTS + "\n"
        "SELECT category, count(*) AS lots, count(kept_value) AS valued, round(sum(kept_value) / 100000.0, 2) AS value_lakh\n"
        "FROM faulty WHERE reject_reason IS NULL GROUP BY category",
        "sales_history": _with(CLOCK_WINDOWS, HDR, LINES, ECON)
        + _history(None, "", {"achieved_lakh": "e.sale_value", "margin_lakh": "e.margin", "purchase_lakh": "e.purchase_gross"}, False),
        "category_history": _with(CLOCK_WINDOWS, HDR, LINES, ECON) + _history("category", "category", {"achieved_lakh": "e.sale_value"}, True),
        "category_margin_history": _with(CLOCK_WINDOWS, HDR, LINES, ECON) + ", " + _running_history(),
        "store_target_history": _with(CLOCK_WINDOWS, HDR, TARGETS)
        + _history('"Store"', "store", {"target_lakh": 'e."Daily_Target"'}, False, "targets", '"Date"'),
        "customers_summary": _with(HDR)
        + f"SELECT territory, false AS is_total, count(DISTINCT customer) AS customers FROM hdr WHERE {_kept('territory')} AND territory IS NOT NULL GROUP BY territory\n"
        + f"UNION ALL SELECT NULL, true, count(DISTINCT customer) FROM hdr WHERE {_kept('territory')}",
        "extract_lots": "WITH " + LOTS.replace("o.o_orderdate AS invoicedate", _DATED_BY_LAYOUT)
        + "SELECT store, territory, category, status, rate, subqty, soldqty, expirydate, invoicedate FROM lots",
        "extract_lots_wide": _with(LOTS_WIDE)
        + "SELECT * REPLACE (CAST(round_even(subqty + 0.5, 0) AS BIGINT) AS subqty, CAST(round_even(soldqty + 0.5, 0) AS BIGINT) AS soldqty) FROM lw",
        "totals_unrounded": _with(WINDOWS, HDR, LINES, ECON)
        + "SELECT window_seq, window_name, round(v, 4) AS achieved_lakh_4,\n"
        "  CAST(CAST(round(v) * 1000000 AS BIGINT) AS VARCHAR) || '.25%' AS scaled_text FROM (\n"
        "  SELECT w.window_seq, w.window_name, coalesce(sum(e.sale_value), 0) / 100000.0 AS v\n"
        "  FROM win w LEFT JOIN econ e ON e.invoicedate BETWEEN w.ws AND w.we GROUP BY w.window_seq, w.window_name)",
        "achieved_revenue_by_window": sales + _total("e.sale_value", "achieved_lakh"),
        "target_revenue_by_window": tgt + _total('e."Daily_Target"', "target_lakh", "targets", '"Date"'),
        "actual_margin_by_window": sales
        + "SELECT *, CAST(margin_lakh AS VARCHAR) || '%' AS margin_text FROM ("
        + _total("e.margin", "margin_lakh")
        + ")",
        "achieved_purchase_by_window": sales + _total("e.purchase_gross", "purchase_lakh"),
        "sales_summary": _with(WINDOWS, HDR, LINES, ECON, TARGETS)
        + "SELECT w.window_seq, w.window_name,\n"
        "  (SELECT round(coalesce(sum(\"Daily_Target\"), 0) / 100000.0, 2) FROM targets t WHERE t.\"Date\" BETWEEN w.ws AND w.we) AS target_lakh,\n"
        "  round(coalesce(sum(e.sale_value), 0) / 100000.0, 2) AS achieved_lakh,\n"
        "  round(coalesce(sum(e.margin), 0) / 100000.0, 2) AS margin_lakh,\n"
        "  CAST(round(coalesce(sum(e.margin), 0) / 100000.0, 2) AS VARCHAR) || '%' AS margin_text,\n"
        "  round(coalesce(sum(e.purchase_gross), 0) / 100000.0, 2) AS purchase_lakh\n"
        "FROM win w LEFT JOIN econ e ON e.invoicedate BETWEEN w.ws AND w.we\n"
        "GROUP BY w.window_seq, w.window_name, w.ws, w.we",
        "category_margin": sales + _keyed("category", "category", "margin", "margin_lakh", "territory"),
        "category_margin_running": _running_margin("category"),
        "category_achieved": sales + _keyed("category", "category", "sale_value", "achieved_lakh", "territory"),
        "category_target": tgt + _keyed('"Category"', "category", '"Daily_Target"', "target_lakh", '"TM"', "targets", '"Date"'),
        "store_achieved": sales + _keyed("store", "store", "sale_value", "achieved_lakh", "territory"),
        "store_margin_fy": sales + _keyed("store", "store", "margin", "margin_lakh", "territory", only_window="fy"),
        "store_target": tgt + _keyed('"Store"', "store", '"Daily_Target"', "target_lakh", None, "targets", '"Date"'),
        "territory_margin": sales + _keyed("territory", "territory", "margin", "margin_lakh", "territory"),
        "territory_achieved": sales + _keyed("territory", "territory", "sale_value", "achieved_lakh", "territory"),
        "territory_target": tgt + _keyed('"TM"', "territory", '"Daily_Target"', "target_lakh", None, "targets", '"Date"'),
        "lot_values": inv
        + "SELECT store, territory, category, status, returned_qty, quantity, value,\n"
        f"  age_days, expiry_days FROM lot_vals WHERE {_kept('territory')}",
        "inventory_age_by_category": inv + ",\n" + _grid("category", "age_days", False, True),
        "inventory_age_by_territory": inv + ",\n" + _grid("territory", "age_days", False, True),
        "expired_by_category": inv
        + "SELECT category, round(coalesce(sum(value), 0) / 100000.0, 2) AS expired_lakh FROM lot_vals\n"
        f"WHERE category IS NOT NULL AND {_kept('territory')} AND expiry_days <= 0 GROUP BY category",
        "expired_by_store": inv
        + "SELECT store, round(coalesce(sum(value), 0) / 100000.0, 2) AS expired_lakh FROM lot_vals\n"
        f"WHERE store IS NOT NULL AND {_kept('territory')} AND expiry_days <= 0 GROUP BY store",
        "expiry_grid_by_category": inv + ",\n" + _grid("category", "expiry_days", True, False),
        "customers_by_territory": _with(HDR)
        + "SELECT territory, count(DISTINCT customer) AS customers FROM hdr\n"
        f"WHERE territory IS NOT NULL AND {_kept('territory')} GROUP BY territory",
        "customers_total": _with(HDR)
        + f"SELECT count(DISTINCT customer) AS customers FROM hdr WHERE {_kept('territory')}",
        "lot_model": model + f"SELECT {MODEL_COLUMNS} FROM model",
        "lot_expiry_bands": model
        + "SELECT exp_seq, expiry_filter, count(*) AS lots, CAST(sum(available_qty) AS BIGINT) AS available_qty,\n"
        "  round(sum(current_inventory_value), 2) AS current_inventory_value FROM model GROUP BY exp_seq, expiry_filter",
        "lot_weighted_age": model
        + "SELECT category_name, round(sum(average_inventory_age), 6) AS weighted_age_days,\n"
        "  round(sum(current_inventory_value), 2) AS current_inventory_value FROM model GROUP BY category_name",
        "lot_fiscal_year": model
        + "SELECT fiscal_year, count(*) AS lots, round(sum(current_inventory_value), 2) AS current_inventory_value,\n"
        "  round(sum(sold_inventory_value), 2) AS sold_inventory_value FROM model GROUP BY fiscal_year",
        "scorecard_category": _scorecard("category", "Category", True, True, False),
        "scorecard_store": _scorecard("store", "Store", False, False, True),
        "scorecard_territory": _scorecard("territory", "TM", False, False, False),
        "inventory_age_grid_wide": inv + ",\n" + _grid("category", "age_days", False, True, wide=True),
    }
