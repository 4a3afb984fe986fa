"""Exact distinct counts without an exchange of all values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.bitsets import bit_of, number_in, word_of


def distinct_words(frame: DataFrame, value: Column, *totals: Column) -> DataFrame:
    """One row per word of the values, with its ``bits`` and the given ``totals``.

    Whole numbers and texts that write one share words; any other text is a row of its own with
    one bit (this is the plain distinct, for values that no number stands for). Nulls have no bit.
    """
    kind = frame.select(value.alias("v")).schema["v"].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        number, other = value, F.lit(None).cast("string")
    else:
        number = number_in(value)
        other = F.when(number.isNull(), value)
    # a text's bit lies in the group of the null word, apart from all numbers
    bit = F.when(number.isNotNull(), bit_of(number)).when(other.isNotNull(), F.lit(1).cast("bigint"))
    return frame.groupBy(word_of(number).alias("word"), other.alias("other")).agg(F.bit_or(bit).alias("bits"), *totals)


def count_bits() -> Column:
    """How many values the words of a group hold."""
    return F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint")


def counts(frame: DataFrame, value: Column) -> DataFrame:
    """One row: ``n_rows``, ``n_values`` (not null) and ``n_distinct``."""
    words = distinct_words(frame, value, F.count("*").alias("n_rows"), F.count(value).alias("n_values"))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
    return words.agg(total("n_rows"), total("n_values"), count_bits().alias("n_distinct"))
