"""Exact decimal arithmetic for money and percentages.

Everything stays DECIMAL, where ``round`` is half away from zero, so a tie such as
98.635 rounds the same way on every engine. On DOUBLE it would not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coverloom.schemas import MONEY, PERCENT

# Wide enough for 10^20 rows or currency units. Dividing the second by the first keeps 12
# decimals; with wider operands Spark would cut the quotient to 6 before it is rounded.
_WHOLE = "decimal(22,2)"
_TOTAL = "decimal(26,2)"


def money(amount: Column) -> Column:
    return F.round(amount, 2).cast(MONEY)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole`` as a percentage; NULL when ``whole`` is zero."""
    return mean(part.cast(_WHOLE) * 100, whole, places)


def mean(total: Column, n: Column, places: int = 2) -> Column:
    """``total / n`` rounded once, from the exact sum; NULL when ``n`` is zero."""
    n = F.nullif(n.cast(_WHOLE), F.lit(0).cast(_WHOLE))
    return F.round(total.cast(_TOTAL) / n, places).cast(PERCENT)
