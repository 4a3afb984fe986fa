"""Sharding and mixing: their laws, brute force, and the DuckDB checks."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from bankpulse.llm.mixing import mix, repeat_mixed, targets
from bankpulse.llm.queries import CHECKS, QUERIES
from bankpulse.llm.sharding import shard
from oracle.compare import connect, difference
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), CHECKS[name]) is None


def check_shards(docs):
    rows = shard(docs).collect()
    wanted = Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.select("doc_id", "text").collect()
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == wanted
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, [])) for k in range(16)]
    assert set(slots) <= set(range(16)) and max(counts) - min(counts) <= 1
    return rows


def test_shards(odd_docs, small_docs, no_docs):
    check_shards(odd_docs)
    rows = check_shards(small_docs)
    source = {r.doc_id: r.source for r in small_docs.collect()}
    totals = Counter(source.values())
    per_shard = Counter((source[r.doc_id], r.shard) for r in rows)
    for name, n in totals.items():
        for k in range(16):
            assert abs(per_shard[name, k] - n / 16) <= 2
    assert shard(no_docs).count() == 0


def filled(sizes, weights, most=3):
    """Targets by resharing the excess until no source is above its cap."""
    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        if not free:
            return [most * s for s in sizes]
        level = (total - sum(most * sizes[i] for i in capped)) / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] > most * sizes[i]}
        if not over:
            return [most * s if i in capped else level * weights[i] for i, s in enumerate(sizes)]
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 1000, 50, 3, 0, 7000], [5], [0, 0], [1, 1, 1, 100000], [100, 200, 300]])
def test_targets(spark, sizes):
    names = [f"={i}" for i in range(len(sizes))]
    frame = spark.createDataFrame(list(zip(names, sizes)), "stratum string, source_size long")
    found = {r.stratum: r.target for r in targets(frame).collect()}
    wanted = filled(sizes, [1 + i % 3 for i in range(len(sizes))])
    assert [found[n] for n in names] == pytest.approx(wanted)


def check_mix(docs):
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    by_target = defaultdict(list)
    for r in rows:
        by_target[r.source_size, r.target].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for (_, target), group in by_target.items():
        assert abs(sum(r.taken for r in group) - target) <= max(r.size for r in group) / 2 + 1e-6
    assert sum(t for _, t in by_target) == pytest.approx(sum(r.size for r in rows))


def test_mix(odd_docs, small_docs, no_docs):
    check_mix(small_docs)
    assert len(mix(odd_docs).collect()) == odd_docs.count()
    assert mix(no_docs).count() == 0
    assert sorted(map(tuple, mix(small_docs).collect())) == sorted(map(tuple, mix(small_docs.repartition(7)).collect()))


def test_documents_come_as_often_as_taken(small_docs, odd_docs, no_docs):
    times = Counter(r.doc_id for r in repeat_mixed(small_docs).collect())
    assert {r.doc_id: r.copies for r in mix(small_docs).collect() if r.copies} == times
    assert repeat_mixed(odd_docs).columns == small_docs.columns
    assert repeat_mixed(no_docs).count() == 0
