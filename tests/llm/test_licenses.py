"""Licence scan against regular expressions and a recursive reading of expressions."""

from __future__ import annotations

import random
import re

import pytest

from bankpulse.llm.licenses import EXCEPTIONS, GRADES, LINKABLE, NOTICES, TAGS, Notice, Scanner, evaluate, label_of, op11_licenses, report, scan
from tests.conftest import SMALL
from tests.llm.conftest import prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(text):
    """n_words and the places of all notices, word by word."""
    words = WORDS.findall(lowered(text))
    places = []
    for notice in NOTICES:
        phrase = notice.phrase.split()
        places += [(i, len(phrase), notice.label, notice.base) for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
    return len(words), sorted(places)


def scanned(text):
    n, places, _ = Scanner().scan((text or "").encode())
    return n, sorted((p["start"], p["words"], p["label"], p["base"]) for p in places)


def noisy(rng):
    """Phrases, parts of them and prose, glued by all kinds of separators."""
    pieces = []
    for _ in range(rng.randint(0, 30)):
        words = rng.choice(NOTICES).phrase.split()
        start = rng.randint(0, len(words) - 1)
        piece = words if rng.random() < 0.5 else words[start : start + rng.randint(1, 4)]
        pieces += [rng.choice([str, str.upper, str.title])(w) for w in piece]
    return "".join(w + rng.choice([" ", "  ", "\n", ", ", "-", "\t(", "é", "", "\x7f", " "]) for w in pieces)


@pytest.mark.parametrize("seed", range(20))
def test_places_equal_the_search_word_by_word(seed):
    rng = random.Random(seed)
    for _ in range(20):
        text = noisy(rng)
        assert scanned(text) == brute(text)


def test_overlapping_and_repeated_phrases():
    text = "Under the MIT license under the mit LICENSE, cc-by-nc-sa cc by nc cc by nc"
    assert scanned(text) == brute(text)
    assert [p[0] for p in scanned(text)[1] if p[3]] == [0, 4, 8, 12, 15]
    twice = Scanner((Notice("a b", "one", True), Notice("a b", "two"), Notice("b a", "three")))
    assert [(p["label"], p["start"]) for p in twice.scan(b"a b a")[1]] == [("one", 0), ("two", 0), ("three", 1)]


def recursive(node):
    """Grade and labels of a made expression."""
    kind, *rest = node
    if kind == "id":
        return GRADES.get(label_of(rest[0]), 0.0), {label_of(rest[0])}
    if kind == "with":
        low = GRADES.get(label_of(rest[0]), 0.0)
        soft = any(rest[1].lower().startswith(e) for e in EXCEPTIONS)
        return (max(low, LINKABLE) if soft and low > 0.2 else low), {f"{label_of(rest[0])}-with-{rest[1].lower()}"}
    (one, first), (two, second) = map(recursive, rest)
    return (min if kind == "and" else max)(one, two), first | second


def made(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        name = rng.choice(["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-or-later", "LGPL-2.1+", "CC-BY-NC-4.0", "LicenseRef-x1"])
        return ("with", name, rng.choice(["Classpath-exception-2.0", "x-1"])) if rng.random() < 0.25 else ("id", name)
    return rng.choice(["and", "or"]), made(rng, depth - 1), made(rng, depth - 1)


def written(rng, node, above=0):
    kind, *rest = node
    if kind == "id":
        return rest[0]
    if kind == "with":
        return f"{rest[0]} {rng.choice(['WITH', 'with'])} {rest[1]}"
    rank = {"or": 1, "and": 2}[kind]
    text = f" {rng.choice([kind, kind.upper()])} ".join(written(rng, x, rank) for x in rest)
    return f"({text})" if rank < above or rng.random() < 0.2 else text


@pytest.mark.parametrize("seed", range(60))
def test_expressions_equal_a_recursive_reading(seed):
    rng = random.Random(seed)
    node = made(rng, 4)
    text = written(rng, node)
    for end in ("", " */", " is what we use"):
        expression, labels, permission = evaluate(text + end)
        assert (permission, set(labels)) == recursive(node)
        assert len(labels) == len(set(labels)) and expression == text.lower()


def test_whole_starts_of_broken_expressions():
    assert evaluate("MIT AND (GPL-2.0") == ("mit", ["mit"], 0.9)
    assert evaluate("MIT OR") == ("mit", ["mit"], 0.9)
    assert [evaluate(t) for t in ("", "(MIT", "and MIT", "is MIT", ")", "( )")] == [None] * 6
    deep = "(" * 50_000 + "MIT" + ")" * 50_000
    assert evaluate(deep)[1:] == (["mit"], 0.9)


def test_tags_are_read_in_the_text():
    text = "# SPDX-License-Identifier: MIT OR GPL-2.0-only\nLicense-Expression = \"Apache-2.0\"\nspdx license identifier is a tag: MIT-0"
    found = Scanner().scan(text.encode())[2]
    assert [f["labels"] for f in found] == [["mit", "gpl-2"], ["apache-2"]]
    assert len(TAGS) == 2


def test_query(spark, small_docs, odd_docs, no_docs):
    extra = spark.createDataFrame([(9001, noisy(random.Random(1)) + "\nSPDX-License-Identifier: ISC\n"), (9002, prose(1, 50)), (9002, prose(1, 50))], "doc_id long, text string")
    for docs in (small_docs.select("doc_id", "text").union(extra), odd_docs):
        result = report(scan(docs)).collect()
        wanted = []
        for r in docs.select("doc_id", "text").collect():
            n, places = brute(r.text)
            base = [p for p in places if p[3]]
            wanted.append((r.doc_id, n, len(base), min(base)[0] if base else None, max(base)[0] if base else None, ",".join(sorted({p[2] for p in base}))))
            assert all(set(p[2] for p in places) <= set(x.labels.split(",")) for x in result if x.doc_id == r.doc_id and x.n_words == n)
        assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in result)
        assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in result)
    by_id = {r.doc_id: r for r in report(scan(extra)).collect()}
    assert "isc" in by_id[9001].labels.split(",") and by_id[9001].expressions == "isc" and by_id[9002].permission is None
    assert report(scan(no_docs)).count() == 0
    assert op11_licenses(spark, SMALL).count() == small_docs.count()
