"""What the corpus operators share: columns by exact name, words, batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
#: Bytes of text that a Python task holds decoded at a time (one document may exceed it).
CHUNK_BYTES = 4 << 20
#: Rows up to which a table of ids or thresholds is broadcast; above, the join is shuffled.
BROADCAST_ROWS = 200_000
#: The same for narrow rows of an id and a number or two.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(frame: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact spelling first; others can't clash with ours."""
    def place(name: str) -> int:
        if name in frame.columns:
            return frame.columns.index(name)
        return [c.lower() for c in frame.columns].index(name.lower())

    places = {name: place(name) for name in names}
    return frame.toDF(*[f"_{i}" for i in range(len(frame.columns))]).select(
        *[F.col(f"_{at}").alias(name) for name, at in places.items()]
    )


def documents(frame: DataFrame) -> DataFrame:
    """The columns of documents that ``frame`` has, without any others."""
    have = {c.lower() for c in frame.columns}
    return pick(frame, *[c for c in DOCUMENT if c in have])


def small_side(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table for broadcast if a count shows that it is small; else leave the
    choice to Spark, which then shuffles both sides."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once for the row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``most`` bytes of text each, whole rows."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for at, size in enumerate(sizes):
            if at > start and held + size > most:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
