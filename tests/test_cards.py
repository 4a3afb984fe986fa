from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bankpulse.functions.cards import check_digit, passes_luhn, valid_card_input

GOOD = "4000003972196501"


def verdicts(spark, numbers):
    frame = spark.createDataFrame([(n,) for n in numbers], "number string")
    return {row.number: row.ok for row in frame.select("number", passes_luhn(F.col("number")).alias("ok")).collect()}


def test_known_numbers(spark):
    good = [GOOD, "79927398713"]
    bad = ["4000003972196502", "40000039721965O1", "", "4", " 4000003972196501", "4000003972196501\n", "４００００"]
    found = verdicts(spark, good + bad)
    assert all(found[n] for n in good)
    assert not any(found[n] for n in bad)


def test_missing_number_is_invalid(spark):
    frame = spark.createDataFrame([(None,)], "number string")
    assert frame.select(passes_luhn(F.col("number")), valid_card_input(F.col("number"))).first() == (False, False)


def test_length_counts_for_card_input(spark):
    frame = spark.createDataFrame([(GOOD,), ("79927398713",)], "number string")
    assert [r[0] for r in frame.select(valid_card_input(F.col("number"))).collect()] == [True, False]


def test_every_single_digit_error_is_found(spark):
    typos = [GOOD[:i] + d + GOOD[i + 1:] for i in range(16) for d in "0123456789" if d != GOOD[i]]
    assert len(typos) == 144
    assert not any(verdicts(spark, typos).values())


def test_adjacent_swaps_are_found_except_zero_nine(spark):
    pairs = [(a, b) for a in range(10) for b in range(10) if a != b]
    rows = [(a, b, f"40000012345{a}{b}12") for a, b in pairs]
    frame = spark.createDataFrame(rows, "a int, b int, body string")
    number = F.concat("body", check_digit(F.col("body")).cast("string"))
    swapped = F.concat(
        F.substring(number, 1, 11), F.substring(number, 13, 1), F.substring(number, 12, 1), F.substring(number, 14, 9)
    )
    for row in frame.select("a", "b", passes_luhn(number).alias("whole"), passes_luhn(swapped).alias("swapped")).collect():
        assert row.whole
        assert row.swapped == ({row.a, row.b} == {0, 9})


@pytest.mark.parametrize("body, digit", [("400000397219650", 1), ("7992739871", 3), ("40000x", None)])
def test_check_digit(spark, body, digit):
    frame = spark.createDataFrame([(body,)], "body string")
    assert frame.select(check_digit(F.col("body"))).first()[0] == digit
