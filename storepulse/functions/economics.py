"""Per-line sale economics as built-in column expressions.

All inputs are the canonical sale-line columns (see
``storepulse.sources.schemas.LINE_COLUMNS``). Divisions by the lot size use
``try_divide`` so a zero ``subqty`` makes that line's margin null (skipped by
the sums) instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import LAKH, LAKH_DIGITS, SERVICE_TAX_RATE


def c(name: str) -> Column:
    return F.col(name)


def gst_factor() -> Column:
    return F.lit(1.0) + c("gst") / F.lit(100.0)


def unit_price_ex_tax() -> Column:
    """Selling price without GST: ``sellingprice / (1 + gst/100)``."""
    return c("sellingprice") / gst_factor()


def service_ex_tax_fixed(rate: float = SERVICE_TAX_RATE) -> Column:
    """Service charge without a fixed service tax (18 % by default)."""
    return c("servicecharge") / F.lit(1.0 + rate)


def service_ex_tax_line() -> Column:
    """Service charge without the line's own GST rate."""
    return c("servicecharge") / gst_factor()


def sale_value(rate: float = SERVICE_TAX_RATE) -> Column:
    """Achieved sale value of a line (fixed service tax)."""
    return c("soldqty") * (unit_price_ex_tax() + service_ex_tax_fixed(rate))


def sale_value_line_rate() -> Column:
    """Sale value of a line with the service charge taxed at the line rate."""
    return c("soldqty") * (unit_price_ex_tax() + service_ex_tax_line())


def purchase_net() -> Column:
    """``soldqty * (rate - discount)``."""
    return c("soldqty") * (c("rate") - c("discount"))


def purchase_gross() -> Column:
    """``soldqty * rate`` (discount not deducted)."""
    return c("soldqty") * c("rate")


def per_unit_of_lot(name: str) -> Column:
    return c("soldqty") * F.try_divide(c(name), c("subqty"))


def margin() -> Column:
    """Line margin: credit notes add, transport and other charges reduce."""
    cost = (
        purchase_net()
        - per_unit_of_lot("cn_stock")
        + per_unit_of_lot("transport_charges")
        + per_unit_of_lot("other_charges")
    )
    return sale_value_line_rate() - cost


def to_lakh(value: Column, digits: int | None = LAKH_DIGITS) -> Column:
    """Scale to lakh; round unless ``digits`` is None."""
    scaled = value / F.lit(LAKH)
    return scaled if digits is None else F.round(scaled, digits)


def as_percent_text(value: Column, digits: int = 2) -> Column:
    """Rounded number in plain digits with a ``%`` suffix (``12.3`` -> ``12.3%``, ``12`` -> ``12.0%``).

    At least one digit follows the point and no zero beyond it; never an exponent.
    """
    scale = max(1, digits)
    plain = F.round(value, digits).cast(f"decimal(38,{scale})").cast("string")
    return F.concat(F.regexp_replace(plain, r"(\.\d+?)0+$", "$1"), F.lit("%"))


def clean_double(col: Column) -> Column:
    """NaN to null, so sums skip it as the original frames did."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
