"""Column helpers. Each one builds a JVM-side expression; none is a UDF."""

from coverloom.functions.dates import day_gap, month_gap, period_of, year_gap
from coverloom.functions.labels import choose, lookup
from coverloom.functions.numbers import mean, money, percent
from coverloom.functions.text import strip_space

__all__ = [
    "choose", "day_gap", "lookup", "mean", "money", "month_gap", "percent", "period_of",
    "strip_space", "year_gap",
]
