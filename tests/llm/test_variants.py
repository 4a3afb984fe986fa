"""Spelling variants against a comparison of all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bankpulse.llm.variants import SlicedIndex, grouped, near_words, op12_variants, roots, runs_of, variants, vocabulary
from tests.conftest import SMALL
from tests.llm.conftest import by_rows, prose


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + (len(a) >= len(b)) :] == b[at + (len(b) >= len(a)) :]


def brute(counts):
    rows = {}
    for word, n in counts.items():
        close = [(m, w) for w, m in counts.items() if near(word, w)]
        best = min(((-m, w) for m, w in close), default=(0, None))
        form = best[1] if -best[0] >= 2 * n and close else None
        rows[word] = (word, form, n, len(close), counts[form] if form else None)
    def root(word):
        while rows[word][1]:
            word = rows[word][1]
        return word
    return sorted(((w, f, root(w), n, k, m) for w, f, n, k, m in rows.values()), key=str)


def words(rng, count, letters, longest):
    made = set()
    while len(made) < count:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, longest)))
        made.add(word)
        at = rng.randrange(len(word))
        made.add(rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]]))
    return sorted(w for w in made if w)


@pytest.mark.parametrize("seed", range(12))
def test_index_finds_all_pairs_of_a_group(seed):
    rng = random.Random(seed)
    some = words(rng, rng.choice([1, 30, 63, 64, 65, 200]), "abé", rng.choice([3, 9, 70]))
    groups = np.sort(np.array([rng.randrange(3) for _ in some]))
    groups = np.unique(groups, return_inverse=True)[1]
    one, two = SlicedIndex([w.encode("latin-1") for w in some], groups).near()
    wanted = {(i, j) for i, a in enumerate(some) for j, b in enumerate(some) if groups[i] == groups[j] and near(a, b)}
    assert set(zip(one.tolist(), two.tolist(), strict=True)) == wanted and len(one) == len(wanted)


@pytest.mark.parametrize("group_words", [2, 10, 2048])
def test_no_pair_is_lost_in_groups_of_any_size(spark, group_words):
    rng = random.Random(group_words)
    counts = {w: rng.choice([3, 4, 6, 8, 9, 20, 50]) for w in words(rng, 250, "abcé", 12) + ["a" * 40, "a" * 41, "a" * 39 + "b", "z" * 3000, "z" * 2999]}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert by_rows(variants(table, group_words=group_words)) == brute(counts)
    sizes = [r["count"] for r in grouped(table, group_words).where("low >= 2").groupBy("key").count().collect()]
    assert max(sizes) <= group_words
    pairs = near_words(table, group_words)
    assert pairs.count() == pairs.distinct().count() == sum(near(a, b) for a in counts for b in counts)


def test_roots_follow_long_paths(spark):
    rows = [(f"w{i:03}", f"w{i + 1:03}") for i in range(70)] + [(f"v{i}", "w035") for i in range(200)] + [("u", "t")]
    found = dict(map(tuple, roots(spark.createDataFrame(rows, "word string, form string")).collect()))
    assert found == {**{w: "w070" for w, _ in rows}, "u": "t"}


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 3}


def test_letters():
    text = "Ébène×÷ naïveĀbc Ÿ ÿ¿Àz d'été 日本 x\U0001f600y ſtraße É"
    assert [r.decode() for r in runs_of(text.encode())] == [re.sub("[A-Z]", lambda m: m.group().lower(), r) for r in RUN.findall(text)]


def test_query(spark, small_docs, odd_docs, no_docs):
    rows = [tuple(r) for r in small_docs.select("doc_id", "text").collect()]
    assert dict(map(tuple, vocabulary(small_docs).collect())) == counted(rows)
    odd = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert by_rows(variants(vocabulary(odd_docs))) == brute(counted(odd))
    assert variants(vocabulary(no_docs)).count() == 0
    rng = random.Random(2)
    base = prose(7, 60).split()
    texts = []
    for i in range(120):
        some = [rng.choice(base) for _ in range(40)]
        texts.append((i, " ".join(w[: k % len(w)] + "é" + w[k % len(w) :] if rng.random() < 0.05 else w for k, w in enumerate(some))))
    docs = spark.createDataFrame(texts + texts[:40], "doc_id long, text string")
    wanted = brute(counted(texts + texts[:40]))
    assert by_rows(variants(vocabulary(docs))) == wanted and sum(r[1] is not None for r in wanted) > 5
    assert op12_variants(spark, SMALL).count() == len(counted(rows))
