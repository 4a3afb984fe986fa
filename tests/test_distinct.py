from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from bankpulse.functions.bitsets import bit_of, members, number_in, word_of
from bankpulse.operators.business import month_words
from bankpulse.operators.distinct import counts

EDGES = [0, 1, 63, 64, -1, -63, -64, -65, 2**31, 2**63 - 1, -(2**63)]


def test_words_give_their_members_back(spark):
    frame = spark.createDataFrame([(n,) for n in EDGES], "n bigint")
    words = frame.groupBy(word_of(F.col("n")).alias("w")).agg(F.bit_or(bit_of(F.col("n"))).alias("b"))
    found = [r.n for r in words.select(F.explode(members(F.col("w"), F.col("b"))).alias("n")).collect()]
    assert sorted(found) == sorted(EDGES)


@pytest.mark.parametrize("kind", ["bigint", "int"])
def test_numbers_are_counted_exactly(spark, kind):
    rng = random.Random(5)
    dense = [rng.randint(-300, 300) for _ in range(2000)]
    apart = [rng.randint(-(2**31), 2**31 - 1) for _ in range(2000)]
    values = [*dense, *apart, *apart[:500], None, None]
    row = counts(spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(6), F.col("v")).first()
    assert tuple(row) == (len(values), len(values) - 2, len(set(values)) - 1)


def test_texts_are_counted_by_their_letters(spark):
    """Only a text that is the one way to write its number shares a word with others."""
    values = ["7", "07", "+7", " 7", "7.0", "", "-7", "0", "00", "64", "abc", "ABC", "9" * 18, "9" * 19, "1" + "0" * 30, "٧", None, "7", "abc"]
    row = counts(spark.createDataFrame([(v,) for v in values], "v string"), F.col("v")).first()
    assert tuple(row) == (19, 18, 16)
    numbers = spark.createDataFrame([(v,) for v in values], "v string").select(number_in(F.col("v")).alias("n"))
    assert sorted(r.n for r in numbers.where("n is not null").collect()) == [0, 7, 7, 64, 10**18 - 1]


def test_nothing_has_no_values(spark):
    for kind in ("bigint", "string"):
        assert tuple(counts(spark.createDataFrame([], f"v {kind}"), F.col("v")).first()) == (0, 0, 0)


def test_months_beyond_a_word_go_to_further_words(spark):
    days = [date(y, m, 1 + m) for y in range(2012, 2027) for m in (1, 6, 12)]
    rows = spark.createDataFrame([(a, d) for d in days for a in (1, 1, 2)], "account_id bigint, day date")
    words = month_words(rows, F.col("day"))
    months = words.select("account_id", F.explode(members(F.col("word"), F.col("bits"))).alias("month")).collect()
    assert sorted(tuple(r) for r in months) == sorted({(a, d.year * 12 + d.month - 1) for d in days for a in (1, 2)})
    assert words.count() == 2 * len({(d.year * 12 + d.month - 1) // 64 for d in days})
