"""Vector bin packing of tokenised documents into training sequences.

A document's ids are cut into pieces of at most ``max_tokens``: full ones and a rest. Every
piece has three sizes: tokens, one segment, and loss-bearing tokens (all but its first token,
which nothing predicts, unless the caller gives others, as for instructions). Sequences are
filled one at a time: among the pieces that still fit, the one with the largest weighted dot
product of its sizes and the room left goes in, until none fits.

Pieces are dealt to buckets of about ``bucket_pieces`` by a hash, so the number of buckets
follows the data and a bucket is packed in the memory of one task; a bucket wastes about one
sequence. Tokenised pieces are written once, so a lost executor changes no sequence.

Null and empty texts are documents of the single separating id. Repeated rows are packed each.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bankpulse.llm.common import chunks, pick, table
from bankpulse.operators.ordering import written

MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS = 1024, 64, 1024
BUCKET_PIECES = 4096
SEPARATOR = 0
VOCABULARY = "byte_bpe_50k"
#: Characters from which the library itself encodes a text: its run time has no bad cases.
LONG_TEXT = 200_000


class Encoder:
    """The ids that the ``tokenizers`` library gives for the .json file. The .tiktoken file is
    the same vocabulary as ranks and gives the same ids in a quarter of the CPU time."""

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.special = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items()}
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.quick = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> np.ndarray:
        if len(text) > LONG_TEXT or any(s in text for s in self.special):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.quick.encode_ordinary(text)
        return np.array([*ids, SEPARATOR], dtype="<u4")


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, and the place of the piece in its task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = Encoder(), 0
        for chunk in chunks(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist(), strict=True):
                ids = encoder.ids(text or "")
                for start in range(0, len(ids), max_tokens):
                    part = ids[start : start + max_tokens]
                    rows.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids), place))
                    place += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"]
    return pick(docs, "doc_id", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def fill(sizes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number of each piece and the tokens before it there; sizes: a row per piece,
    tokens first; one above ``room`` raises. Pieces of equal sizes are taken in their order."""
    if (sizes > room).any():
        raise ValueError("a piece is larger than a sequence may be")
    kinds, kind_of, left = np.unique(sizes, axis=0, return_inverse=True, return_counts=True)
    members = np.argsort(kind_of.ravel(), kind="stable")
    taken = np.concatenate([[0], np.cumsum(left)[:-1]])
    share = kinds / room
    weight = (sizes / room).mean(axis=0)
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    number, todo = 0, len(sizes)
    while todo:
        used = np.zeros(len(room), np.int64)
        while True:
            fits = np.flatnonzero((left > 0) & (kinds <= room - used).all(axis=1))
            if not len(fits):
                break
            best = fits[np.argmax(share[fits] @ (weight * (room - used) / room))]
            piece = members[taken[best]]
            sequence[piece], offset[piece] = number, used[0]
            taken[best] += 1
            left[best] -= 1
            used += kinds[best]
            todo -= 1
        number += 1
    return sequence, offset


def pack(
    items: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_LOSS,
    bucket_pieces: int = BUCKET_PIECES,
) -> DataFrame:
    """Add sequence_id and offset to written pieces (``length``, ``loss``, ``place``); a piece
    larger than a limit raises. Sequence ids are unique: bucket above, number in it below."""
    room = np.array([max_tokens, max_segments, max_loss], np.int64)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "place"], kind="stable").reset_index(drop=True)
        sizes = np.column_stack([group["length"], np.ones(len(group), np.int64), group["loss"]]).astype(np.int64)
        sequence, group["offset"] = fill(sizes, room)
        group["sequence_id"] = (int(group["bucket"].iloc[0]) << 32) + sequence
        return group.drop(columns="bucket")

    buckets = max(1, -(-items.count() // bucket_pieces))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return (
        items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "place"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(run, f"{shape}, offset long, sequence_id long")
    )


def packed_documents(docs: DataFrame) -> DataFrame:
    cut = written(pieces(docs).withColumn("loss", F.col("length") - 1))
    return pack(cut).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(table(spark, folder, "documents"))
