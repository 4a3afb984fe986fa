"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q, at least four times as long, that no
neighbouring word extends. Runs are found at dyadic scales t = 1, 2, 4, ...: at scale t a
position belongs to the synchronising set if the hash of the t words at it, or of those t words
later, is the least among the t + 1 positions between. Whether a position belongs depends on the
2t words at it alone, so equal contexts are selected alike, and any t neighbouring positions hold
a selected one unless all about them has a period of t/3 or less. Positions inside such highly
periodic regions are left out of the minima; their periods were found at smaller scales, and
periods 1 and 2 by direct comparison. Two selected positions with equal contexts of 2t words at
a distance q of 3t to 6t propose the period q. A run three times as long as its period has such a
pair: a selected position lies in its first q + t words, and the context q words later ends
inside the run. (Runs of three periods are found because the next scales need the regions; those
shorter than four periods are not reported.)

Proposals grow to both sides by comparing hashes of doubling lengths. Hashes only propose: every
run is compared word by word, and one that a hash collision made too long is measured directly.
A multiple of the smallest period gives the same stretch and is dropped.

Documents are independent; a task joins those of a chunk of text, each behind a separator that
equals nothing, and works on the whole. Null and empty texts have no words and no runs. Rows
are kept one for one, so repeated rows give equal rows and an empty table none; a null doc_id
stays null. Further columns are ignored. A text is read whole; memory is about 200 bytes a word
of the longest one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import WORD, chunks, let, pick, table

SHORTEST, PERIODS = 6, 4
#: Periods that a run needs to be found at all; scales cover three to six times their length.
FOUND_PERIODS = 3
#: Bytes of text that are worked on together.
TEXT_BYTES = 2 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_NEVER = _U(2**64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hashes:
    """Hashes of any stretch of a sequence of numbers from sums of powers, modulo 2^64."""

    def __init__(self, x: np.ndarray) -> None:
        powers = []
        for base in (_BASE, _INVERSE):
            steps = np.full(len(x) + 1, base, np.uint64)
            steps[0] = 1
            powers.append(np.cumprod(steps, dtype=np.uint64))
        self.up, self.down = powers
        values = _mix(x.astype(np.uint64) + _U(0x632BE59BD9B4E019))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[:-1], dtype=np.uint64)])

    def windows(self, size: int, end: int) -> np.ndarray:
        """Hash of the ``size`` numbers from each position on, for all that end by ``end``."""
        count = max(0, end - size + 1)
        return (self.sums[size : size + count] - self.sums[:count]) * self.down[:count]

    def equal(self, i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
        """Whether the stretches at i and at j > i have equal hashes."""
        return (self.sums[i + size] - self.sums[i]) * self.up[j - i] == self.sums[j + size] - self.sums[j]

    def common(self, i: np.ndarray, j: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """How many numbers before i and j, and from i and j on, are equal (i < j)."""
        before, after = np.zeros_like(i), np.zeros_like(i)
        size = 1 << max(0, int(longest).bit_length())
        while size:
            room = np.flatnonzero(j + after + size < len(self.sums))
            at = room[self.equal(i[room] + after[room], j[room] + after[room], size)]
            after[at] += size
            room = np.flatnonzero(i - before - size >= 0)
            at = room[self.equal(i[room] - before[room] - size, j[room] - before[room] - size, size)]
            before[at] += size
            size //= 2
        return before, after


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each position on."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def synchronising(hashes: Hashes, t: int, end: int, regions: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set of scale t. ``regions`` (start, stop, period) are the
    runs found so far; where t words lie in one of period t/3 or less, nothing is selected."""
    value = _mix(hashes.windows(t, end) ^ _U(t)) >> _U(1)
    inside = regions[(FOUND_PERIODS * regions[:, 2] <= t) & (regions[:, 1] - regions[:, 0] >= t) & (regions[:, 1] <= end)]
    if len(inside):
        change = np.zeros(len(value) + 1, np.int64)
        np.add.at(change, inside[:, 0], 1)
        np.add.at(change, inside[:, 1] - t + 1, -1)
        value[np.cumsum(change[:-1]) > 0] = _NEVER
    if len(value) <= t:
        return np.empty(0, np.int64)
    least = _least(value, t + 1)
    return np.flatnonzero((least != _NEVER) & ((least == value[:-t]) | (least == value[t:])))


def proposals(hashes: Hashes, chosen: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected positions and distances of 3t to 6t at which the context of 2t words is equal."""
    context = (hashes.sums[chosen + 2 * t] - hashes.sums[chosen]) * hashes.down[chosen]
    first, step = np.arange(len(chosen)), 0
    places, periods = [], []
    while len(first):
        step += 1
        first = first[first + step < len(chosen)]
        distance = chosen[first + step] - chosen[first]
        near = distance < 2 * FOUND_PERIODS * t
        first, distance = first[near], distance[near]
        fits = (distance >= FOUND_PERIODS * t) & (context[first] == context[first + step])
        places.append(chosen[first[fits]])
        periods.append(distance[fits])
    return np.concatenate(places or [first]), np.concatenate(periods or [first])


def extent(x: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """Start and stop of the stretch about i and i + q with equal numbers q apart, compared directly."""
    start = stop = i
    while start > 0 and x[start - 1] == x[start - 1 + q]:
        start -= 1
    while stop + q < len(x) and x[stop] == x[stop + q]:
        stop += 1
    return start, stop + q


def _short_periods(x: np.ndarray) -> np.ndarray:
    found = []
    for q in (1, 2):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]]).astype(np.int8)
        change = np.diff(same)
        starts, stops = np.flatnonzero(change == 1), np.flatnonzero(change == -1) + q
        long = stops - starts >= FOUND_PERIODS * q
        if q == 2:
            long &= x[np.minimum(starts, len(x) - 1)] != x[np.minimum(starts + 1, len(x) - 1)]
        found.append(np.stack([starts[long], stops[long], np.full(long.sum(), q)], axis=1))
    return np.concatenate(found)


def all_runs(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, stop, period) of all runs of three periods or more. ``x`` joins sequences
    of the given sizes, longest first, each with a number of its own behind it."""
    if not len(x):
        return np.empty((0, 3), np.int64)
    ends = np.cumsum(sizes + 1)
    hashes, found = Hashes(x), _short_periods(x)
    seen = set(map(tuple, found[:, :2].tolist()))
    t = 1
    while len(long := np.flatnonzero(sizes >= FOUND_PERIODS * FOUND_PERIODS * t)):
        end = int(ends[long[-1]])  # shorter sequences come later
        chosen = synchronising(hashes, t, end, found)
        place, period = proposals(hashes, chosen[chosen + 2 * t <= end], t)
        before, after = hashes.common(place, place + period, int(sizes[0]))
        start, stop = place - before, place + period + after
        true = stop - start >= FOUND_PERIODS * period
        rows = np.unique(np.stack([start, stop, period, place], axis=1)[true], axis=0)
        fresh, last = [], None
        for l, r, q, i in rows.tolist():
            if (l, r, q) == last:
                continue
            last = (l, r, q)
            if not np.array_equal(x[l : r - q], x[l + q : r]):
                l, r = extent(x, i, q)
                if r - l < FOUND_PERIODS * q:
                    last = None
                    continue
            if (l, r) not in seen:
                seen.add((l, r))
                fresh.append((l, r, q))
        if fresh:
            found = np.concatenate([found, np.array(fresh, np.int64)])
        t *= 2
    return found


def analysed(texts: list[bytes | None]) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """Per text its runs (start, length, period) by start, then period, and its words without
    those that repeat the first period of a run, joined by a space."""
    split = [(t or b"").split() for t in texts]
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    sizes = np.array([len(words) for words in split], np.int64)
    order = np.argsort(-sizes, kind="stable")
    x = np.empty(int(sizes.sum()) + len(texts), np.int64)
    ends = np.cumsum(sizes[order] + 1)
    for place, i in enumerate(order.tolist()):
        end = int(ends[place]) - 1
        x[end - len(split[i]) : end] = np.fromiter(map(number.__getitem__, split[i]), np.int64, len(split[i]))
        x[end] = -1 - place
    runs = all_runs(x, sizes[order])
    length = runs[:, 1] - runs[:, 0]
    runs = runs[(length >= SHORTEST) & (length >= PERIODS * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    change = np.zeros(len(x) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    found: list = [None] * len(texts)
    for place, i in enumerate(order.tolist()):
        first, stop = int(ends[place]) - 1 - len(split[i]), int(ends[place]) - 1
        mine = runs[cuts[place] : cuts[place + 1]]
        words = split[i]
        if len(mine):
            words = [w for w, keep in zip(words, kept[first:stop].tolist(), strict=True) if keep]
        found[i] = ([(l - first, r - l, q) for l, r, q in mine.tolist()], b" ".join(words))
    return found


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs, collapsed (the text without repeats): a row per document."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, most=TEXT_BYTES):
            found = analysed(chunk.column("text").to_pylist())
            runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rows] for rows, _ in found]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(runs, kind), pa.array([text for _, text in found], pa.binary())],
                ["doc_id", "runs", "collapsed"],
            )

    texts = pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("binary"))
    return texts.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed binary").withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(docs: DataFrame) -> DataFrame:
    """The documents with the repetition that the id of a tenth of them asks for: from word a
    on, the p words from there again and again. A null id asks for none."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(words: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        return let(
            F.struct((g % n).cast("int").alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).cast("int").alias("p")),
            lambda s: F.array_join(F.transform(words, lambda w, i: F.when(i < s.a, w).otherwise(F.get(words, s.a + (i - s.a) % s.p))), " "),
        )

    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    changed = F.when((h % 10 == 0) & F.col("text").rlike(WORD), let(words, repeated)).otherwise(F.col("text"))
    return pick(docs, "doc_id", "text").withColumn("text", changed)


def report(found: DataFrame) -> DataFrame:
    """Digest columns of rows with runs and the collapsed text."""
    better = lambda one, two: F.when(two.length * one.period > one.length * two.period, two).otherwise(one)
    best = F.aggregate(F.slice("runs", F.lit(2), F.size("runs")), F.get("runs", F.lit(0)), better)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return report(periodic_runs(planted(table(spark, folder, "documents"))))
