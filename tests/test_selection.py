from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bankpulse.operators.ordering import ntile
from bankpulse.operators.selection import Target, group_ends, passed, rows_at, select_ranks


def numbers(kind, n=3000):
    rng = random.Random(n)
    return {
        "equal": [7] * n,
        "few": [rng.choice([0, 0, 0, 1, -5, 900]) for _ in range(n)],
        "wide": [rng.randint(-(2**63), 2**63 - 1) for _ in range(n - 2)] + [2**63 - 1, -(2**63)],
        "near": [10**17 + rng.randint(0, 10**6) for _ in range(n)],
    }[kind]


@pytest.mark.parametrize("kind", ["equal", "few", "wide", "near"])
def test_selected_rows_are_those_of_a_sort(spark, kind):
    values = numbers(kind)
    rows = [(k * 31 - 40_000, v) for k, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "key bigint, v bigint").repartition(5)
    ranks = {"first": 1, "second": 2, "middle": 1500, "again": 1500, "last": 3000}
    wanted = sorted((v, k) for k, v in rows)
    found = rows_at(frame, [F.col("v")], F.col("key"), {0: lambda n: ranks})
    assert found == {name: wanted[rank - 1] for name, rank in ranks.items()}


def test_columns_are_selected_together(spark):
    rows = [(k, k % 3, -k) for k in range(100)]
    frame = spark.createDataFrame(rows, "key bigint, a bigint, b bigint")
    found = rows_at(frame, [F.col("a"), F.col("b")], F.col("key"), {0: lambda n: {"a": n // 2}, 1: lambda n: {"b": 1}})
    assert found == {"a": sorted((a, k) for k, a, _ in rows)[49], "b": (-99, 99)}


def test_one_row_no_row_and_a_rank_outside(spark):
    frame = spark.createDataFrame([(4, 9)], "key bigint, v bigint")
    assert rows_at(frame, [F.col("v")], F.col("key"), {0: lambda n: {"x": n}}) == {"x": (9, 4)}
    assert rows_at(frame.limit(0), [F.col("v")], F.col("key"), {0: lambda n: {"x": n}}) == {}
    with pytest.raises(ValueError):
        rows_at(frame, [F.col("v")], F.col("key"), {0: lambda n: {"x": 2}})


def test_a_target_ends_at_its_place_among_equals(spark):
    rows = spark.createDataFrame([(0, 5)] * 10 + [(0, 6)] * 10 + [(1, 5)], "group int, number bigint")
    assert select_ranks(rows, [Target(0, 13, 5, 6)]) == [Target(0, 3, 6, 6)]


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 19, 25, 100])
def test_groups_end_where_ntile_ends_them(spark, n):
    frame = spark.range(1, n + 1).select("id", (-F.col("id") % 4).alias("v"))
    ends = rows_at(frame, [F.col("v")], F.col("id"), {0: lambda rows: {str(i): e for i, e in enumerate(group_ends(rows, 10))}})
    group = sum([passed(F.col("v"), F.col("id"), end).cast("int") for end in ends.values()], F.lit(1))
    found = {r.id: r.g for r in frame.select("id", group.alias("g")).collect()}
    order = sorted(found, key=lambda i: (-(i % 4) if i % 4 else 0, i))
    ranks = spark.createDataFrame([(r, i) for r, i in enumerate(order, 1)], "rn bigint, id bigint")
    assert found == {r.id: r.g for r in ranks.select("id", ntile(F.col("rn"), F.lit(n), 10).alias("g")).collect()}
