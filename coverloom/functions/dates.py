"""Date arithmetic that counts calendar boundaries, not elapsed time.

31 January to 1 February is one month and 31 December to 1 January is one year.
Spark's own ``months_between`` and ``timestampdiff`` measure elapsed time and give 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_gap(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)).cast("bigint")


def month_gap(later: Column, earlier: Column) -> Column:
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("bigint")


def day_gap(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def period_of(day: Column) -> Column:
    """Calendar month as ``YYYY-MM``."""
    return F.date_format(day, "yyyy-MM")
