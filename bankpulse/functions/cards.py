"""Card-number check digits as column expressions (no join, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CARD_LENGTH = 16


def _weighted_sum(digits: Column, doubled_parity: int) -> Column:
    """Sum over the digits from the right; those whose 0-based position has the
    given parity count double, with the digits of the double added up."""
    from_right = F.split(F.reverse(digits), "")

    def weight(char: Column, position: Column) -> Column:
        digit = char.try_cast("int")
        double = digit * 2
        return F.when(position % 2 == doubled_parity, F.when(double > 9, double - 9).otherwise(double)).otherwise(digit)

    return F.aggregate(F.transform(from_right, weight), F.lit(0), lambda total, value: total + value)


def check_digit(partial: Column) -> Column:
    """The digit to append to a partial number."""
    return F.when(partial.rlike("^[0-9]+$"), F.pmod(10 - _weighted_sum(partial, 0) % 10, F.lit(10)))


def passes_luhn(number: Column) -> Column:
    """ASCII digits only, at least two of them, and a valid check digit."""
    looks_right = F.coalesce(number.rlike(r"\A[0-9]{2,}\z"), F.lit(False))
    return F.when(looks_right, _weighted_sum(number, 1) % 10 == 0).otherwise(F.lit(False))


def valid_card_input(number: Column) -> Column:
    return F.coalesce(F.length(number) == CARD_LENGTH, F.lit(False)) & passes_luhn(number)
