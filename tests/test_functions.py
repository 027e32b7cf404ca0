from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coverloom.functions import choose, day_gap, lookup, mean, money, month_gap, percent, period_of, strip_space, year_gap


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    ("later", "earlier", "months", "years", "days"),
    [
        (date(2024, 2, 1), date(2024, 1, 31), 1, 0, 1),
        (date(2024, 1, 1), date(2023, 12, 31), 1, 1, 1),
        (date(2024, 1, 31), date(2024, 1, 1), 0, 0, 30),
        (date(2023, 11, 30), date(2024, 1, 1), -2, -1, -32),
    ],
)
def test_gaps_count_boundaries(spark, later, earlier, months, years, days):
    a, b = F.lit(later), F.lit(earlier)
    assert value(spark, month_gap(a, b)) == months
    assert value(spark, year_gap(a, b)) == years
    assert value(spark, day_gap(a, b)) == days


def test_gap_with_null_is_null(spark):
    assert value(spark, month_gap(F.lit(date(2024, 1, 1)), F.lit(None).cast("date"))) is None


def test_period(spark):
    assert value(spark, period_of(F.lit(date(2024, 3, 9)))) == "2024-03"


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\r\n", chr(0xA0), chr(0x2003), chr(0x3000)])
def test_strip_space_takes_every_kind(spark, space):
    assert value(spark, strip_space(F.lit(f"{space} Ann{space}Lee {space}"))) == f"Ann{space}Lee"


def test_choose_sends_null_to_default(spark):
    tier = F.lit(None).cast("string")
    assert value(spark, lookup(tier, {"gold": 3}, 1)) == 1
    assert value(spark, choose([(tier == "gold", "x"), (tier == "silver", "y")], "z")) == "z"


def test_ties_round_away_from_zero(spark):
    assert value(spark, percent(F.lit(1), F.lit(800))) == Decimal("0.13")  # 0.125
    assert value(spark, percent(F.lit(201), F.lit(20000))) == Decimal("1.01")  # 1.005
    assert value(spark, percent(F.lit(-1), F.lit(800))) == Decimal("-0.13")
    assert value(spark, money(F.lit(Decimal("0.125")))) == Decimal("0.13")
    assert value(spark, mean(F.lit(Decimal("197.27")), F.lit(2))) == Decimal("98.64")  # 98.635


def test_mean_of_a_very_wide_sum_is_rounded_once(spark):
    total = F.lit(Decimal("98634999.60")).cast("decimal(38,2)")
    # 98.6349996 must not become 98.635 on the way to 98.63.
    assert value(spark, mean(total, F.lit(1000000))) == Decimal("98.63")


def test_zero_denominator_is_null(spark):
    assert value(spark, percent(F.lit(1), F.lit(0))) is None
    assert value(spark, mean(F.lit(1), F.lit(0))) is None


def test_percent_of_very_large_sums(spark):
    part, whole = Decimal("99999999999999999999.98"), Decimal("99999999999999999999.99")
    assert value(spark, percent(F.lit(part), F.lit(whole))) == Decimal("100.00")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=50, max_size=50))
def test_percent_is_exact_half_up(spark, pairs):
    frame = spark.createDataFrame(pairs, "n long, d long").select("n", "d", percent(F.col("n"), F.col("d")).alias("p"))
    for n, d, p in frame.collect():
        hundredths = Fraction(n * 10000, d)
        exact = int(hundredths + Fraction(1, 2))
        assert p == Decimal(exact).scaleb(-2).quantize(Decimal("0.01"), ROUND_HALF_UP)
