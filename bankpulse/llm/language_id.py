"""Language identification with hyperdimensional profiles.

Each symbol (a letter in lower case, or the gap between words) has a random vector of +1 and -1,
made from the seed and its code point. The vector of a three-symbol sequence binds them: the
product of the first, rotated twice, the second, rotated once, and the third. A document bundles
(adds) the vectors of its sequences; a language prototype bundles its documents. The prediction
is the language whose prototype has the largest cosine with the document.

Sequences are bound and added in blocks, so memory is bounded whatever the number of letters and
of distinct sequences; it grows with the longest text alone, by some bytes a character.

Prototypes are sums, so tasks bundle their own rows and Spark adds the partial vectors; only
one vector per language reaches the driver. Texts that are null or have no letter are ``und``
with score 0, as is everything if nothing could be learned. Equal cosines: the first by name.
Rows are kept one for one: repeated rows give equal predictions, an empty table none, a null
doc_id stays null and counts as held out. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import chunks, pick, table

DIMENSIONS = 1024
SEED = 20240607
DOCS_AT_ONCE = 256
#: Sequences bound at a time, cells of a count table, and letters whose vectors a task keeps.
BOUND_AT_ONCE, TABLE_CELLS, KEPT_LETTERS = 2048, 1 << 23, 1 << 15
UNKNOWN = "und"


class Profiles:
    """Symbol vectors and the bundling of texts; made anew in each task from the seed."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED) -> None:
        self.dimensions, self.seed = dimensions, seed
        self.vectors: dict[int, np.ndarray] = {}
        self.letter = self._letters(range(0x10000))

    @staticmethod
    def _letters(points) -> np.ndarray:
        return np.array([chr(p).isalpha() for p in points], bool)

    def vector(self, symbol: int) -> np.ndarray:
        """+1 and -1 of a code point; 0 is the gap."""
        if symbol not in self.vectors:
            if len(self.vectors) >= KEPT_LETTERS:
                self.vectors.clear()
            bits = np.random.default_rng([self.seed, symbol]).integers(0, 2, self.dimensions, np.int8)
            self.vectors[symbol] = 2 * bits - 1
        return self.vectors[symbol]

    def symbols(self, text: str) -> np.ndarray:
        """Code points of the letters, gaps of any length as 0, one at both ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        if len(points) and points.max() >= 0x10000:
            wide, back = np.unique(points, return_inverse=True)
            letter = self._letters(wide.tolist())[back]
        else:
            letter = self.letter[points]
        found = np.concatenate([[0], np.where(letter, points, 0), [0]]).astype(np.int32)
        return found[np.concatenate([[True], (found[1:] != 0) | (found[:-1] != 0)])]

    def bundle(self, texts: list[np.ndarray], owner: np.ndarray, owners: int) -> np.ndarray:
        """Sum of the sequence vectors of the symbol arrays per owner, a row each."""
        total = np.zeros((owners, self.dimensions))
        joined = np.concatenate(texts) if texts else np.empty(0, np.int32)
        if len(joined) < 3:
            return total
        present = np.flatnonzero(np.bincount(joined))
        rank = np.zeros(int(present[-1]) + 1, np.int64)
        rank[present] = np.arange(len(present))
        place, size = rank[joined], len(present)
        inside = np.ones(len(joined), bool)  # sequences do not go over the end of a text
        ends = np.cumsum([len(t) for t in texts])
        for back in (1, 2):
            inside[np.maximum(0, ends - back)] = False
        inside = inside[:-2]
        codes = ((place[:-2] * size + place[1:-1]) * size + place[2:])[inside]
        whose = np.repeat(owner, [len(t) for t in texts])[:-2][inside]
        distinct, code = self._distinct(codes, size**3)
        cells = whose * len(distinct) + code
        for start in range(0, len(distinct), BOUND_AT_ONCE):
            some = distinct[start : start + BOUND_AT_ONCE]
            if owners * len(distinct) <= TABLE_CELLS:
                if not start:
                    table = np.bincount(cells, minlength=owners * len(distinct)).reshape(owners, -1)
                counts = table[:, start : start + len(some)]
            else:
                if not start:
                    order = np.argsort(code, kind="stable")
                    code, whose = code[order], whose[order]
                low, high = np.searchsorted(code, (start, start + len(some)))
                counts = np.bincount(whose[low:high] * len(some) + code[low:high] - start, minlength=owners * len(some)).reshape(owners, -1)
            total += counts.astype(np.float32) @ self._bound(present, some, size)
        return total

    @staticmethod
    def _distinct(codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The codes that occur, and the place of each among them."""
        if most > TABLE_CELLS:
            return np.unique(codes, return_inverse=True)
        distinct = np.flatnonzero(np.bincount(codes, minlength=1))
        rank = np.zeros(most, np.int64)
        rank[distinct] = np.arange(len(distinct))
        return distinct, rank[codes]

    def _bound(self, present: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
        first, rest = np.divmod(codes, size * size)
        bound = np.ones((len(codes), self.dimensions), np.int8)
        for places, turns in ((first, 2), (rest // size, 1), (rest % size, 0)):
            used, back = np.unique(places, return_inverse=True)
            bound *= np.roll(np.stack([self.vector(int(present[u])) for u in used]), turns, axis=1)[back]
        return bound.astype(np.float32)


def _groups(chunk: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, chunk.num_rows, DOCS_AT_ONCE):
        yield chunk.slice(start, DOCS_AT_ONCE)


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Language -> bundled vector, from the columns text and lang of all rows given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = Profiles(dimensions, seed), {}
        for chunk in chunks(batches):
            for group in _groups(chunk):
                langs, owner = np.unique(np.array(group.column("lang").to_pylist(), object), return_inverse=True)
                texts = [profiles.symbols(t) for t in group.column("text").to_pylist()]
                for lang, vector in zip(langs, profiles.bundle(texts, owner, len(langs)), strict=True):
                    sums[lang] = sums.get(lang, 0) + vector.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
            ["lang", "vector"],
        )

    partial = labelled.select("text", "lang").mapInArrow(run, "lang string, vector array<long>")
    added = (
        partial.select("lang", F.posexplode("vector").alias("pos", "value"))
        .groupBy("lang", "pos").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("cells"))
    )
    rows = added.select("lang", F.col("cells.value").alias("vector")).collect()  # a vector per language
    return {r.lang: np.array(r.vector, np.float64) for r in sorted(rows, key=lambda r: r.lang)}


def predict(docs: DataFrame, learned: dict[str, np.ndarray], dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Add lang_pred and score to doc_id, held_out; the text goes."""
    learned = {lang: v / norm for lang, v in learned.items() if (norm := np.linalg.norm(v)) > 0}
    names = np.array([*learned, UNKNOWN], object)
    targets = np.array([*learned.values()], np.float64).reshape(len(learned), dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(dimensions, seed)
        for chunk in chunks(batches):
            for group in _groups(chunk):
                texts = [profiles.symbols(t or "") for t in group.column("text").to_pylist()]
                best, score = np.full(len(texts), len(learned)), np.zeros(len(texts))
                if learned:
                    vectors = profiles.bundle(texts, np.arange(len(texts)), len(texts))
                    norms = np.linalg.norm(vectors, axis=1)
                    cosines = vectors @ targets.T / np.where(norms > 0, norms, 1)[:, None]
                    known = np.array([len(t) > 2 for t in texts])
                    best = np.where(known, cosines.argmax(axis=1), best)
                    score = np.where(known, cosines.max(axis=1).clip(0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [group.column("doc_id"), group.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def held_out() -> Column:
    """A fifth of the ids, by a checksum; a null id counts as the empty text (held out)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame) -> DataFrame:
    rows = pick(docs, "doc_id", "text", "lang").withColumn("held_out", held_out())
    train = rows.where(~F.col("held_out") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    return predict(rows.drop("lang"), prototypes(train))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))
