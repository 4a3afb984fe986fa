"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from bankpulse.llm.common import pick
from bankpulse.llm.neighbours import FACTOR, nearest, op5_neighbours, shard_count


def brute(rows, queries, k=10):
    fine = [(i, np.array(v, float)) for i, v in rows if v is not None and i is not None and None not in v]
    fine = [(i, v) for i, v in fine if len(v) and np.isfinite(v).all() and v.any()]
    found = {}
    for q, vector in fine:
        if q in queries:
            near = sorted((float(np.sqrt(((v - vector) ** 2).sum())), i) for i, v in fine if i != q and len(v) == len(vector))
            found[q] = near[:k]
    return found


def result(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    return found


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "id long, vector array<float>")


@pytest.mark.parametrize("shard_vectors", [10_000, 150])
def test_factor_one_is_exact(spark, shard_vectors):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 6)).round(1).astype(np.float32)  # coarse: many equal distances
    vectors[300:420] = vectors[7]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = frame_of(spark, rows)
    found = result(nearest(frame, frame.where("id % 50 = 7"), factor=1.0, shard_vectors=shard_vectors))
    wanted = brute(rows, {i for i in range(700) if i % 50 == 7})
    assert found.keys() == wanted.keys()
    for q in wanted:
        assert [i for _, i in found[q]] == [i for _, i in wanted[q]]
        assert [s for s, _ in found[q]] == pytest.approx([s for s, _ in wanted[q]], rel=1e-12)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 1.0, 1.0]), (8, [1.0, 0.5]), (8, [1.0, 0.5]), (None, [1.0, 1.0]), (200, [5.0])]
    frame = frame_of(spark, rows)
    found = result(nearest(frame, frame.where("id % 100 = 0")))
    assert {q: [i for _, i in near] for q, near in found.items()} == {0: [8, 8, 100], 100: [8, 8, 0]}
    assert nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_a_query_id_with_two_vectors_is_searched_with_each(spark):
    rows = [(100, [0.0, 1.0]), (100, [9.0, 1.0]), (100, [9.0, 1.0]), (1, [0.0, 2.0]), (2, [9.0, 3.0]), (2, [0.0, 4.0]), (3, [5.0, 1.0])]
    frame = frame_of(spark, rows)
    found = {}
    for r in sorted(nearest(frame, frame.where("id = 100"), k=3).collect(), key=lambda r: r.rank):
        found.setdefault(r.query_vector, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found.values()) == sorted([[(1, 1, 1.0), (2, 2, 3.0), (3, 3, 5.0)], [(1, 2, 2.0), (2, 3, 4.0), (3, 1, pytest.approx(82**0.5))]])


def test_columns_with_names_used_inside(spark):
    rows = [(i * 50, [float(i), 1.0], "x", "y", "z", "w") for i in range(5)]
    plain = frame_of(spark, [r[:2] for r in rows])
    clash = spark.createDataFrame(rows, "id long, vector array<float>, shard string, kind string, dim string, tag string")
    picked = pick(clash, "id", "vector")
    assert result(nearest(picked, picked.where("id % 100 = 0"))) == result(nearest(plain, plain.where("id % 100 = 0")))


def test_shards_grow_once_there_are_many():
    assert [shard_count(n) for n in (0, 4096, 4097, 51282, 10**6, 10**7, 10**9)] == [1, 1, 2, 13, 245, 256, 15259]


def test_recall_of_the_production_factor(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    wanted = brute(rows, {i for i, _ in rows if i % 100 == 0})
    found = result(op5_neighbours(spark, folder))
    hits = sum(len({i for _, i in found[q]} & {i for _, i in near}) for q, near in wanted.items())
    assert FACTOR >= 1 and hits >= 0.9 * sum(map(len, wanted.values()))
