"""Token counts by byte-pair merging on a heap and a linked list.

A word starts as its bytes. The adjacent pair of lowest merge rank is popped from a heap,
leftmost first; the right symbol is unlinked and the pairs beside the new symbol are pushed.
The count is the number of initial symbols minus the merges made: no token is looked up or
emitted. Words repeat, so counts are remembered per worker process, up to a fixed number.

Null and empty texts have 0 bytes and 0 tokens; rows are kept one for one.
"""

from __future__ import annotations

import json
import sys
import types
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import chunks, pick, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
REMEMBERED_WORDS = 600_000
REMEMBERED_LENGTH = 100
_SHIFT = 24
_LOW = (1 << 32) - 1


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the other
    bytes, in order, as the characters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Ranks of the merges of a byte-level BPE file, and the symbol that each one makes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.of_byte = [0] * 256
        for character, byte in symbols.items():
            self.of_byte[byte] = vocabulary[character]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.made = [vocabulary[a + b] for a, b in pairs]
        self.rank = {vocabulary[a] << _SHIFT | vocabulary[b]: i for i, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]

    def count(self, word: bytes) -> int:
        rank, ids = self.rank, [self.of_byte[b] for b in word]
        n = len(ids)
        heap = [
            r << 32 | i for i in range(n - 1) if (r := rank.get(ids[i] << _SHIFT | ids[i + 1])) is not None
        ]
        if not heap:
            return n
        heapify(heap)
        following, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            item = heappop(heap)
            left, r = item & _LOW, item >> 32
            right = following[left]
            if right >= n or rank.get(ids[left] << _SHIFT | ids[right]) != r:
                continue  # one of the two has merged with another symbol meanwhile
            ids[left], ids[right] = self.made[r], -1
            after = following[left] = following[right]
            merges += 1
            if (p := before[left]) >= 0 and (r := rank.get(ids[p] << _SHIFT | ids[left])) is not None:
                heappush(heap, r << 32 | p)
            if after < n:
                before[after] = left
                if (r := rank.get(ids[left] << _SHIFT | ids[after])) is not None:
                    heappush(heap, r << 32 | left)
        return n - merges


class WordCounts(dict):
    """Word -> tokens; a missing word is counted, and kept if it is of usual length."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.merges = merges
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None

    def __missing__(self, word: str) -> int:
        n = self.merges.count(word.encode("utf-8", "surrogatepass"))
        if len(word) <= REMEMBERED_LENGTH:
            self[word] = n
        return n

    def of_text(self, text: str) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        if self.special is None:
            return sum(map(self.__getitem__, self.words(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.words(p))) for p in parts)


def process_counts(tokenizer: str) -> WordCounts:
    """The counts of this worker process: later tasks go on with what earlier ones counted."""
    shared = sys.modules.setdefault("bankpulse_word_counts", types.ModuleType("bankpulse_word_counts"))
    if tokenizer not in shared.__dict__:
        shared.__dict__[tokenizer] = WordCounts(Merges(public_tokenizers.path(tokenizer)))
    return shared.__dict__[tokenizer]


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = process_counts(tokenizer)
        for chunk in chunks(batches):
            texts = [t or "" for t in chunk.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array([counts.of_text(t) for t in texts], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
