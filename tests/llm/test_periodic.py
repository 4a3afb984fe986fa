"""Periodic runs against a search of every period, and the digests of the query."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from bankpulse.llm import periodic
from bankpulse.llm.periodic import Hashes, analysed, extent, op13_periodic_runs, periodic_runs, planted, report
from tests.conftest import SMALL
from tests.llm.conftest import by_rows, prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """start, length, period: every period is tried at every place, the smallest kept."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((start, stop - start, q) for (start, stop), q in found.items())


def texts(rng, words, letters, repeats):
    made = [b"w%d" % rng.randrange(letters) for _ in range(words)]
    for _ in range(repeats if words > 8 else 0):
        a = rng.randrange(words)
        p = rng.randint(1, max(1, (words - a) // 4))
        for i in range(a, rng.randint(a, words)):
            made[i] = made[a + (i - a) % p]
    return b" ".join(made)


def check(some):
    for text, (runs, collapsed) in zip(some, analysed(some), strict=True):
        words = (text or b"").split()
        assert runs == brute(words)
        gone = {i for start, length, q in runs for i in range(start + q, start + length)}
        assert collapsed == b" ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_the_search_of_all_periods(seed):
    rng = random.Random(seed)
    check([texts(rng, rng.randint(0, rng.choice([12, 60, 400])), rng.choice([1, 2, 3, 60]), rng.randint(0, 3)) for _ in range(12)])


def test_long_periods_and_nested_runs():
    rng = random.Random(5)
    inner = (b"a " * 40 + b"b c b c b c b c b c d ").strip()
    block = b" ".join(b"w%d" % rng.randrange(9) for _ in range(300))
    check([b" ".join([inner] * 6), b" ".join([block] * 5), b" ".join([block, inner] * 4), b"x " * 3000, None, b"", b" \t\n"])
    check([(b"q " + block + b" ") * 4 + block[:50]])


def test_a_hash_that_collides_only_costs_time(monkeypatch):
    monkeypatch.setattr(periodic, "_mix", lambda x: x & np.uint64(1))
    rng = random.Random(6)
    for _ in range(30):
        check([texts(rng, 60, rng.choice([2, 5]), 2) for _ in range(3)])


def test_extent_and_common_parts():
    x = np.array([9, 1, 2, 1, 2, 1, 2, 7, -1])
    assert extent(x, 3, 2) == (1, 7)
    before, after = Hashes(x).common(np.array([3]), np.array([5]), 8)
    assert (before[0], after[0]) == (2, 2)


def digest(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words) if n < 3000 else [r for r in analysed([" ".join(words).encode()])[0][0]]
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query(spark, small_docs, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect() if len(r.text or "") < 8000]
    rows += [(10_000 + i, prose(i, 80) + " " + "a b c " * (i % 7)) for i in range(60)]
    wanted = sorted((digest(*r) for r in rows), key=str)
    assert sum(w[1] > 0 for w in wanted) > 20 and any(zlib.crc32(str(w[0]).encode()) % 10 == 0 for w in wanted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_rows(report(periodic_runs(planted(docs)))) == wanted
    assert report(periodic_runs(planted(no_docs))).count() == 0
    odd = report(periodic_runs(planted(odd_docs))).collect()
    assert sorted((tuple(r) for r in odd), key=str) == sorted((digest(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()), key=str)
    assert op13_periodic_runs(spark, SMALL).count() == small_docs.count()
