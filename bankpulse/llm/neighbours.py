"""Nearest neighbours with a vantage-point tree per shard.

Vectors are dealt to shards by a hash, so a shard fits a task at any size of the table: of
``shard_vectors`` until there are enough shards for a cluster, and up to ``full_vectors`` from
then on, because every query visits every shard. (Shards by nearest pivot, to leave out those
that the triangle inequality excludes, were measured: see the README.) A task sorts its shards, builds the tree of one, and streams the queries
through it. A node holds a vantage point and the ranges of distances to it of its two halves;
a half is skipped if the triangle inequality, its bound multiplied by ``factor``, shows that it
holds nothing nearer than the k-th found. Factor 1 is exact search; larger ones skip more.
Halves are cut by rank, so equal vectors give no deep trees.

The k nearest of each shard are merged per query, ties to the smaller vec_id. Vectors that are
null, empty, zero, or hold null or non-finite components take no part, nor do rows without a
vec_id; vectors are compared with those of equal dimension. A vec_id in several rows is a
candidate with each of them and never its own neighbour; as a query, each different vector of it
is searched on its own and has its own ranks (``query_vector`` tells them apart), equal ones once.
An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bankpulse.llm.common import pick, table

NEAREST = 10
#: Vectors of a shard, first and once there are ``MANY_SHARDS`` (32 MB at 64 dimensions).
SHARD_VECTORS, FULL_VECTORS, MANY_SHARDS = 4096, 65536, 256
LEAF = 64
QUERIES_AT_ONCE = 256
FACTOR = 1.1
SEED = 5
#: Rounding of a computed bound may not skip a tie.
ROUNDING = 1 + 1e-9


class Tree:
    def __init__(self, ids: np.ndarray, points: np.ndarray, seed: int = SEED) -> None:
        self.ids, self.points = ids, points
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(ids)))

    def _build(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members
        vantage = members[self.random.integers(len(members))]
        members = members[members != vantage]
        distance = self._distances(self.points[[vantage]], members)[0]
        order = np.argsort(distance, kind="stable")
        halves = []
        for half in (order[: len(order) // 2], order[len(order) // 2 :]):
            halves.append((distance[half].min(), distance[half].max(), self._build(members[half])))
        return vantage, halves

    def _distances(self, queries: np.ndarray, members: np.ndarray) -> np.ndarray:
        return np.sqrt(((queries[:, None, :] - self.points[members][None]) ** 2).sum(axis=2))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        """Distances and ids of the k nearest per query; missing ones have distance inf."""
        best = np.full((len(queries), k), np.inf), np.full((len(queries), k), np.iinfo(np.int64).max)

        def offer(active: np.ndarray, members: np.ndarray) -> np.ndarray:
            distance = self._distances(queries[active], members)
            ids = np.broadcast_to(self.ids[members], distance.shape)
            other = np.where(ids == query_ids[active][:, None], np.inf, distance)
            every = np.concatenate([best[0][active], other], axis=1), np.concatenate([best[1][active], ids], axis=1)
            order = np.lexsort((every[1], every[0]), axis=1)[:, :k]
            best[0][active], best[1][active] = (np.take_along_axis(e, order, axis=1) for e in every)
            return distance

        def visit(node, active: np.ndarray) -> None:
            if isinstance(node, np.ndarray):
                if len(node):
                    offer(active, node)
                return
            vantage, (inner, outer) = node
            distance = offer(active, np.array([vantage]))[:, 0]
            nearer = distance <= (inner[1] + outer[0]) / 2
            for mine, halves in ((nearer, (inner, outer)), (~nearer, (outer, inner))):
                for low, high, half in halves:
                    group, d = active[mine], distance[mine]
                    bound = np.maximum(d - high, low - d) * factor
                    group = group[bound <= best[0][group, k - 1] * ROUNDING]
                    if len(group):
                        visit(half, group)

        if len(self.ids):
            visit(self.root, np.arange(len(queries)))
        return best


def usable(vectors: DataFrame) -> DataFrame:
    """id, vector (double), dim of the vectors that take part."""
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return (
        vectors.withColumn("vector", F.col("vector").cast("array<double>"))
        .where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))
        .withColumn("dim", F.size("vector"))
    )


def _searcher(k: int, factor: float):
    """Function for partitions sorted by dim, shard, kind: points (0) come before queries (1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, ids, points = None, None, [], []
        for batch in batches:
            dims, shards, kinds, numbers, tags = (batch.column(c).to_numpy() for c in ("dim", "shard", "kind", "id", "tag"))
            edge = (np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(kinds) != 0)
            cuts = np.concatenate([[0], np.flatnonzero(edge) + 1, [batch.num_rows]])
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                if (dims[start], shards[start]) != shard:
                    shard, tree, ids, points = (dims[start], shards[start]), None, [], []
                part = batch.column("vector").slice(start, end - start).flatten().to_numpy().reshape(end - start, -1)
                if kinds[start] == 0:
                    ids.append(numbers[start:end])
                    points.append(part)
                    continue
                if tree is None:
                    if not ids:
                        continue
                    tree = Tree(np.concatenate(ids), np.concatenate(points))
                    ids, points = [], []
                for at in range(0, len(part), QUERIES_AT_ONCE):
                    asked, tag = (x[start:end][at : at + QUERIES_AT_ONCE] for x in (numbers, tags))
                    distance, near = tree.search(asked, part[at : at + QUERIES_AT_ONCE], k, factor)
                    there = np.isfinite(distance)
                    hits = there.sum(axis=1)
                    held = [np.repeat(asked, hits), np.repeat(tag, hits), near[there], distance[there]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["query_id", "query_vector", "vec_id", "score"])

    return run


def shard_count(vectors: int, shard_vectors: int = SHARD_VECTORS, full_vectors: int = FULL_VECTORS) -> int:
    wanted = -(-vectors // shard_vectors)
    return max(1, min(wanted, max(MANY_SHARDS, -(-vectors // full_vectors))))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = NEAREST, factor: float = FACTOR,
    shard_vectors: int = SHARD_VECTORS, full_vectors: int = FULL_VECTORS,
) -> DataFrame:
    """query_id, rank, vec_id, score, query_vector (a hash); both inputs have id and vector."""
    points, asked = usable(vectors), usable(queries).dropDuplicates(["id", "vector"])
    shards = shard_count(points.count(), shard_vectors, full_vectors)
    place = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    dealt = points.withColumns({"shard": F.pmod(F.xxhash64("id"), F.lit(shards)), "kind": F.lit(0), "tag": F.lit(0).cast("long")})
    every = asked.withColumns({"kind": F.lit(1), "tag": F.xxhash64("vector")}).withColumn("shard", place)
    together = dealt.unionByName(every).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    found = together.mapInArrow(_searcher(k, factor), "query_id long, query_vector long, vec_id long, score double")
    # k rows per query and shard: one window per query over few rows
    order = W.partitionBy("query_id", "query_vector").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score", "query_vector"
    )


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = pick(table(spark, folder, "embeddings"), "vec_id", "embedding").toDF("id", "vector")
    return nearest(rows, rows.where(F.col("id") % 100 == 0))
