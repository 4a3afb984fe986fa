from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankpulse.functions.dates import complete_days, complete_years, month_number
from bankpulse.functions.numbers import money_mean, pct, rounded_ratio


def test_halves_round_away_from_zero(spark):
    rows = [(1, 8, Decimal("12.5")), (1, 16, Decimal("6.3")), (-1, 16, Decimal("-6.3")), (3, 0, None), (None, 4, None)]
    frame = spark.createDataFrame(rows, "num bigint, den bigint, wanted decimal(18,1)")
    for row in frame.select("wanted", pct(F.col("num"), F.col("den")).alias("got")).collect():
        assert row.got == row.wanted


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-10**9, 10**9)), min_size=50, max_size=80))
def test_ratio_is_exact(spark, pairs):
    frame = spark.createDataFrame(pairs, "num bigint, den bigint")
    for row in frame.select("num", "den", rounded_ratio(F.col("num"), F.col("den"), 2).alias("got")).collect():
        if row.den == 0:
            assert row.got is None
        else:
            exact = Fraction(row.num, row.den) * 100
            size = (abs(exact) * 2 + 1) // 2
            assert row.got == Decimal(int(size if exact >= 0 else -size)).scaleb(-2)


def test_money_mean(spark):
    frame = spark.createDataFrame([(Decimal("10.00"), 3)], "total decimal(18,2), n bigint")
    assert frame.select(money_mean(F.col("total"), F.col("n"))).first()[0] == Decimal("3.33")
    assert (Decimal("10.00") / 3).quantize(Decimal("1"), ROUND_HALF_UP) == frame.select(
        money_mean(F.col("total"), F.col("n"), 0)).first()[0]


@pytest.mark.parametrize("start, end, years", [
    ("2000-02-29", "2018-02-28", 17), ("2000-02-29", "2018-03-01", 18), ("2000-05-06", "2018-05-06", 18),
    ("2000-05-06", "2018-05-05", 17),
])
def test_complete_years(spark, start, end, years):
    frame = spark.createDataFrame([(start, f"{end} 00:00:00")], "s string, e string")
    got = frame.select(complete_years(F.col("s").cast("date"), F.col("e").cast("timestamp_ntz"))).first()[0]
    assert got == years


def test_days_are_full_24_hours_and_months_are_numbered_without_gaps(spark):
    frame = spark.createDataFrame([("2025-01-01 10:00:00", "2025-01-03 09:59:59")], "s string, e string")
    assert frame.select(complete_days(F.col("s").cast("timestamp_ntz"), F.col("e").cast("timestamp_ntz"))).first()[0] == 1
    months = spark.createDataFrame([("2025-11-01", "2026-02-01"), ("2026-02-01", "2025-11-01")], "s string, e string")
    got = [r[0] for r in months.select(month_number(F.col("e").cast("date")) - month_number(F.col("s").cast("date"))).collect()]
    assert got == [3, -3]


def test_upper_tail_of_chi_square(spark):
    import math

    from bankpulse.operators.stats import upper_tail

    def wanted(chi2, dof):
        """From two degrees less, by integration by parts."""
        if dof <= 2:
            return {0: 1.0, 1: math.erfc(math.sqrt(chi2 / 2)), 2: math.exp(-chi2 / 2)}[dof]
        half = dof / 2 - 1
        return wanted(chi2, dof - 2) + math.exp(half * math.log(chi2 / 2) - chi2 / 2 - math.lgamma(half + 1))

    # upper 5 % and 1 % points from published tables
    points = {1: (3.841, 6.635), 2: (5.991, 9.210), 3: (7.815, 11.345), 4: (9.488, 13.277), 5: (11.070, 15.086), 10: (18.307, 23.209),
              15: (24.996, 30.578), 20: (31.410, 37.566), 29: (42.557, 49.588), 30: (43.773, 50.892)}
    rows = [(x, d, p) for d, xs in points.items() for x, p in zip(xs, (0.05, 0.01), strict=True)]
    rows += [(x, d, wanted(x, d)) for x in (0.5, 1.0, 3.84, 7.9, 8.1, 20.0, 90.0) for d in range(3, 31)]
    rows += [(x, d, wanted(x, d)) for x in (0.0, 1e-9, 0.01, 0.5, 3.84, 7.9, 8.1, 90.0) for d in (0, 1, 2)]
    rows += [(0.0, 7, 1.0), (2000.0, 2000, None), (1e6, 3, 0.0)]
    frame = spark.createDataFrame(rows, "chi2 double, dof int, wanted double")
    for r in frame.withColumn("p", upper_tail(frame.chi2, frame.dof)).collect():
        if r.wanted is None:  # the normal limit of many degrees
            assert abs(r.p - 0.4958) < 1e-3
        else:
            assert abs(r.p - r.wanted) < (2e-5 if r.wanted in (0.05, 0.01) else 1e-8), r
