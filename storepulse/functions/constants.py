"""Fixed values that must equal the original report job's for the same results.

They are stated here once, in their natural order, and every operator
takes them as overridable parameters.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Territories left out of the sales, inventory and customer reports.
EXCLUDED_TERRITORIES = (
    "RJ RSP TERRITORY",
    "MH RSP TERRITORY",
    "MP RSP TERRITORY",
    "KA RSP TERRITORY",
    "HO",
)

# Inventory age / expiry buckets: right-closed bins (1, 45], (45, 90],
# (90, 135], (135, inf) with these labels, in this order.
AGE_BUCKET_LABELS = ("1-45 days", "46-90 days", "91-135 days", "135+ days")
AGE_BUCKET_EDGES = (1, 45, 90, 135)

# Expiry bands of the enriched lot table: upper day bound (inclusive) and
# label; anything above the last bound is "> 6m". Sequence is the position.
EXPIRY_BANDS = (
    (0, "Expired"),
    (7, "< 1wk"),
    (15, "1wk-2wk"),
    (30, "2wk-1m"),
    (90, "1m-3m"),
    (180, "3m-6m"),
)
EXPIRY_BAND_LAST = "> 6m"

# Fiscal-year labels of the enriched lot table: April-March years starting
# 2020 through 2024, anything else (and null) is "None".
FISCAL_YEAR_FIRST = 2020
FISCAL_YEAR_LAST = 2024
FISCAL_YEAR_NONE = "None"

# Lot status spellings: the report scripts test "creditnote", the BI model
# tests "CreditNote" and looks for "Stock" inside the status.
STATUS_CREDITNOTE_SCRIPT = "creditnote"
STATUS_CREDITNOTE_MODEL = "CreditNote"
STATUS_STOCK_MARKER = "Stock"

# Fixed service-charge tax used by the "achieved" measures (18 %).
SERVICE_TAX_RATE = 0.18

# Reports are published in lakh (1e5) rounded to two decimals.
LAKH = 100000.0
LAKH_DIGITS = 2
