"""Token counts and packing against the tokenizers library, by brute force."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bankpulse.llm.packing import Encoder, fill, packed_documents
from bankpulse.llm.token_counts import Merges, token_counts

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def library_ids(text: str | None) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [
    "", " ", "\x1c\x1d a\x1f b\x85c d　e", "don't we'LL I'd", "  lead", "a" * 3000, "\n \n\t x", "ÀÉ ǅ ١٢٣ ²½ ⅷ",
    "‍️👩‍👩‍👧 한국어 日本語 ไทย", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext", "\x00\x01\x7f",
]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_ids_equal_the_library(text):
    assert Encoder().ids(text).tolist() == [*library_ids(text), 0]


def check_counts(docs):
    wanted = Counter((r.doc_id, len((r.text or "").encode()), len(library_ids(r.text))) for r in docs.select("doc_id", "text").collect())
    assert Counter(tuple(r) for r in token_counts(docs).collect()) == wanted


def test_counts(odd_docs, small_docs, no_docs, spark):
    check_counts(odd_docs)
    check_counts(small_docs)
    check_counts(spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string"))
    assert token_counts(no_docs).count() == 0


def test_merging_keeps_rank_order():
    merges = Merges(public_tokenizers.path("byte_bpe_50k.json"))
    for word in (" the", "aaaaaaaaa", "antidisestablishmentarianism", "über", " " * 9):
        assert merges.count(word.encode()) == len(library_ids(word))


def check_packing(docs):
    rows = packed_documents(docs).collect()
    texts = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    wanted, found = Counter(), Counter()
    for (doc_id, text), times in texts.items():
        ids = np.array([*library_ids(text), 0], "<u4")
        for start in range(0, len(ids), 1024):
            part = ids[start : start + 1024]
            wanted[doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += times
    sequences = defaultdict(list)
    for r in rows:
        found[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == wanted
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024 and len(parts) <= 64
    used = sum(r.length for r in rows)
    return used, len(sequences) * 1024


def test_packing(odd_docs, small_docs, no_docs):
    check_packing(odd_docs)
    used, room = check_packing(small_docs)
    assert room - used < 1024 + 0.01 * room
    assert packed_documents(no_docs).count() == 0


def test_limits_hold_together():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 180, 500)
    sizes = np.column_stack([tokens, np.ones(500, np.int64), tokens - rng.integers(0, tokens)])
    room = np.array([256, 6, 180])
    with pytest.raises(ValueError, match="larger"):
        fill(np.array([[10, 1, 181]]), room)
    sequence, offset = fill(sizes, room)
    for s in range(sequence.max() + 1):
        assert (sizes[sequence == s].sum(axis=0) <= room).all()
        assert sorted(offset[sequence == s]) == np.cumsum([0, *tokens[sequence == s][np.argsort(offset[sequence == s])]])[:-1].tolist()


def test_packing_is_the_same_again(small_docs):
    assert sorted(map(tuple, packed_documents(small_docs).collect())) == sorted(map(tuple, packed_documents(small_docs).collect()))
