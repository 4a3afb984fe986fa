"""Sets of whole numbers as 64-bit words.

Grouped by word, numbers that are close travel as one row per task and word (16 bytes for up to
64 numbers), whatever the number of log rows; numbers far apart cost one word each, so the
exchange is never more than twice that of the numbers. Words are combined before a shuffle, merge
over any grouping, and hold for negative numbers too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64


def word_of(number: Column) -> Column:
    """The word that holds a number."""
    return F.shiftright(number.cast("bigint"), 6)


def bit_of(number: Column) -> Column:
    """The number's bit in its word."""
    place = number.cast("bigint").bitwiseAND(F.lit(BITS - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def members(word: Column, bits: Column) -> Column:
    """The numbers of a word as an array."""
    numbers = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: word * F.lit(BITS) + i)
    return F.filter(numbers, lambda n: bits.bitwiseAND(bit_of(n)) != 0)


def number_in(text: Column) -> Column:
    """The number that a text writes without sign, leading zero or blank, up to 18 digits; else null.
    Different texts have different numbers."""
    return F.when(text.rlike("^(0|[1-9][0-9]{0,17})$"), text.try_cast("bigint"))
