"""Rows at given ranks, found by narrowing histograms instead of a sort."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bits of a number that one round settles: a histogram has at most 2^16 + 1 parts per open range.
ROUND_BITS = 16


@dataclass(frozen=True)
class Target:
    """The ``rank``-th smallest number (from 1) among those of ``group`` from ``low`` to ``high``."""

    group: int
    rank: int
    low: int
    high: int

    @property
    def range(self) -> tuple[int, int, int]:
        return self.group, self.low, self.high

    @property
    def shift(self) -> int:
        return max(0, (self.high - self.low).bit_length() - ROUND_BITS)


def select_ranks(rows: DataFrame, targets: list[Target]) -> list[Target]:
    """Narrow each target to the one number at its rank: then ``low`` = ``high``, and ``rank`` is
    the position among the rows with that number.

    ``rows``: group int, number bigint, without nulls; they are read once a round. A round counts
    the rows of each open range by their leading bits and goes on in the part with the rank; 64 bits
    take four rounds. Only counts are shuffled, a row per task and part, however many rows are equal.
    """
    spark, targets = rows.sparkSession, list(targets)
    while still := {t.range: t.shift for t in targets if t.low < t.high}:  # a range per target at most
        ranges = list(still)
        parts = spark.createDataFrame(
            [(i, *key, still[key]) for i, key in enumerate(ranges)],
            "range int, group int, low bigint, high bigint, shift int",
        )
        wanted = spark.createDataFrame(
            [(i, ranges.index(t.range), t.rank) for i, t in enumerate(targets) if t.low < t.high],
            "target int, range int, rank bigint",
        )
        counted = (
            rows.join(F.broadcast(parts), "group")
            .where(F.col("number").between(F.col("low"), F.col("high")))
            .groupBy("range", F.call_function("shiftright", F.col("number"), F.col("shift")).alias("part"))
            .agg(F.count("*").alias("n"))
            .withColumn("upto", F.sum("n").over(W.partitionBy("range").orderBy("part")))  # over the parts of a range
        )
        before = F.col("upto") - F.col("n")
        hit = (F.col("rank") > before) & (F.col("rank") <= F.col("upto"))
        placed = counted.join(F.broadcast(wanted), "range").where(hit).select("target", "part", before.alias("before"))
        for row in placed.collect():  # a row per target
            t = targets[row.target]
            targets[row.target] = replace(
                t, rank=t.rank - row.before,
                low=max(t.low, row.part << t.shift), high=min(t.high, ((row.part + 1) << t.shift) - 1),
            )
    return targets


def rows_at(
    frame: DataFrame, values: list[Column], key: Column, ranks: dict[int, Callable[[int], dict[str, int]]]
) -> dict[str, tuple[int, int]]:
    """(value, key) of the rows at named ranks of each of the ``values``, in the order of (value, key).

    Values and the unique ``key`` are whole numbers without nulls. ``ranks[i]`` names ranks of the
    i-th value, given the number of rows. First the values are selected, then, among the rows equal
    to them, the keys. Nothing is found in an empty frame, which should be written or cheap to read.
    """
    long = frame.select(
        key.cast("bigint").alias("key"), F.posexplode(F.array(*[v.cast("bigint") for v in values])).alias("group", "number")
    )
    ends = [f(name).alias(f"{end}_{name}") for name in ("number", "key") for end, f in (("low", F.min), ("high", F.max))]
    extents = long.groupBy("group").agg(F.count("*").alias("n"), *ends).collect()  # a row per value
    names, first, keys = [], [], {}
    for row in extents:
        keys[row.group] = row.low_key, row.high_key
        for name, rank in ranks[row.group](row.n).items():
            if not 1 <= rank <= row.n:
                raise ValueError(f"{name}: rank {rank} of {row.n} rows")
            names.append(name)
            first.append(Target(row.group, rank, row.low_number, row.high_number))
    found = select_ranks(long.select("group", "number"), first)
    equal = sorted({(t.group, t.low) for t in found})
    ties = frame.sparkSession.createDataFrame([(i, *e) for i, e in enumerate(equal)], "tie int, group int, number bigint")
    tied = long.join(F.broadcast(ties), ["group", "number"]).select(F.col("tie").alias("group"), F.col("key").alias("number"))
    second = select_ranks(tied, [Target(equal.index((t.group, t.low)), t.rank, *keys[t.group]) for t in found])
    return {name: (value.low, row.low) for name, value, row in zip(names, found, second)}


def passed(value: Column, key: Column, row: tuple[int, int] | None) -> Column:
    """Whether (value, key) comes after the given row; unknown without one."""
    if row is None:
        return F.lit(None).cast("boolean")
    at, at_key = (F.lit(number).cast("bigint") for number in row)
    return (value > at) | ((value == at) & (key > at_key))


def group_ends(n: int, groups: int) -> list[int]:
    """The last rank of each group but the final one, when the first ``n`` mod ``groups`` groups
    get one row more."""
    return [n // groups * g + min(g, n % groups) for g in range(1, groups)]
