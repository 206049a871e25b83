"""Sums of doubles that do not depend on the order of the rows.

A sum of doubles rounds at every addition, so its last digits change with
the partitioning of a run. Here each value is cut into three whole numbers: its floor and
the next two groups of 30 binary digits. Their sums are sums of longs, exact
in any order and cheap in generated code, and are put together at the end.
A value is exact down to 2**-60 (any double from 1/128 on, in size); what lies below is cut off
row by row, so even then the order does not matter. The total is rounded to a
double once. A group may hold 2**33 rows, and its floors must add up to less than 2**63;
beyond that ANSI arithmetic raises instead of wrapping. Nulls are skipped, a
sum of nothing is null, and infinite or NaN values are errors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Binary digits of a group behind the point.
GROUP_BITS = 30
#: A total: the sum times 2**60, a whole number.
TOTAL_TYPE = "decimal(38,0)"

_GROUP = float(1 << GROUP_BITS)


def _times(groups: int) -> Column:
    return F.lit(str(1 << (GROUP_BITS * groups))).cast("decimal(19,0)")


def exact_total(value: Column) -> Column:
    """Aggregate: the exact sum of a double column, as ``TOTAL_TYPE``. Totals add up with ``sum``, exactly."""
    value = value.cast("double")
    whole = F.floor(value)
    rest = (value - whole) * F.lit(_GROUP)
    first = F.floor(rest)
    second = F.floor((rest - first) * F.lit(_GROUP))
    high, mid, low = (F.sum(g.cast("long")) for g in (whole, first, second))
    return (high.cast("decimal(19,0)") * _times(2) + mid.cast("decimal(19,0)") * _times(1) + low.cast("decimal(19,0)")).cast(TOTAL_TYPE)


def exact_value(total: Column) -> Column:
    """The double nearest to an exact total."""
    return total.cast("double") / F.lit(_GROUP * _GROUP)


def exact_sum(value: Column) -> Column:
    """Aggregate: the sum of a double column, rounded once, whatever the order of its rows."""
    return exact_value(exact_total(value))
