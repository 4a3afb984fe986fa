"""Language prediction: held-out accuracy and odd rows."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pytest

from bankpulse.llm import language_id
from bankpulse.llm.language_id import Profiles, identify, predict, prototypes


def test_held_out_accuracy(spark, small_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    rows = identify(docs).collect()
    assert len(rows) == len(truth)
    judged = [(r.lang_pred, truth[r.doc_id][0]) for r in rows if r.held_out and truth[r.doc_id][0]]
    assert sum(a == b for a, b in judged) >= 0.93 * len(judged)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = identify(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert identify(no_docs).count() == 0


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "more", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify(docs).collect()} == {"und"}


def bound(profiles, text):
    """The bundle of a text, sequence by sequence."""
    symbols, total = [0], np.zeros(profiles.dimensions)
    for letter in text.lower():
        if letter.isalpha():
            symbols.append(ord(letter))
        elif symbols[-1]:
            symbols.append(0)
    symbols += [0] if symbols[-1] else []
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        one, two, three = (profiles.vector(x).astype(int) for x in (a, b, c))
        total += np.roll(one, 2) * np.roll(two, 1) * three
    return total


TEXTS = ["Hello, Wörld", "hello   WÖRLD!", "", "?", "x", "日本語 の \U0001f600 文章 𠀀𠀁", "\u0130stanbul ǅ é", "a b c"]


@pytest.mark.parametrize("cells", [1 << 23, 50])
def test_bundle_is_the_sum_of_bound_letters(monkeypatch, cells):
    monkeypatch.setattr(language_id, "TABLE_CELLS", cells)
    monkeypatch.setattr(language_id, "BOUND_AT_ONCE", 7)
    monkeypatch.setattr(language_id, "KEPT_LETTERS", 5)
    profiles = Profiles(dimensions=64)
    symbols = [profiles.symbols(t) for t in TEXTS]
    assert (symbols[0] == symbols[1]).all()
    alone = profiles.bundle(symbols, np.arange(len(TEXTS)), len(TEXTS))
    assert (alone == [bound(profiles, t) for t in TEXTS]).all()
    two = profiles.bundle(symbols, np.array([0, 1] * 4), 2)
    assert (two == [alone[::2].sum(axis=0), alone[1::2].sum(axis=0)]).all()


def test_letters_have_vectors_of_their_own():
    profiles = Profiles()
    every = np.stack([profiles.vector(ord(c)) for c in "abcéèñßабв日本語"]).astype(float)
    cosines = every @ every.T / profiles.dimensions
    assert np.abs(cosines - np.eye(len(every))).max() < 0.2


def test_prototypes_and_cosines(spark):
    rows = [("en", "the cat and the hat"), ("en", "an old house"), ("fr", "le chat et la maison"), ("日", "日本語 の 文章"), ("fr", "été")]
    learned = prototypes(spark.createDataFrame(rows, "lang string, text string").repartition(3), 256)
    profiles = Profiles(256)
    wanted = {lang: sum(bound(profiles, t) for la, t in rows if la == lang) for lang in ("en", "fr", "日")}
    assert learned.keys() == wanted.keys() and all((learned[k] == wanted[k]).all() for k in wanted)
    texts = [(1, "the hat"), (2, "la maison"), (3, "文章 の"), (4, "zzz"), (5, "12"), (6, None)]
    docs = spark.createDataFrame([(*t, False) for t in texts], "doc_id long, text string, held_out boolean")
    for r in predict(docs, learned, 256).collect():
        vector = bound(profiles, dict(texts)[r.doc_id] or "")
        cosines = {k: float(vector @ w / np.linalg.norm(vector) / np.linalg.norm(w)) if vector.any() else 0 for k, w in wanted.items()}
        best = max(cosines, key=cosines.get)
        assert r.lang_pred == (best if vector.any() else "und") and abs(r.score - max(0, cosines[best])) < 1e-9


def test_memory_is_bounded_for_many_letters():
    rng = np.random.default_rng(3)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA0, 4_000_000 // 3)))
    profiles = Profiles()
    tracemalloc.start()
    total = profiles.bundle([profiles.symbols(text)], np.array([0]), 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total.any() and peak < 300e6
