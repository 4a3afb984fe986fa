"""Quality measures against plain Python, and thresholds that follow the group."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from bankpulse.llm.quality import (
    EVEN_ROWS, SPREADS, base_failed, keep_good, keyed, measured, op8_quality_rules, quality_report, sketches, thresholds,
)
from tests.conftest import SMALL
from tests.llm.conftest import SCHEMA, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def check(docs):
    wanted = Counter((r.doc_id, *measures(r.text)) for r in docs.select("doc_id", "text").collect())
    rows = quality_report(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == wanted
    assert not any(r.kept and r.base_failed for r in rows)
    return rows


def test_measures(odd_docs, small_docs, no_docs, spark):
    check(odd_docs)
    rows = check(small_docs)
    assert sum(r.kept for r in rows) >= 0.8 * sum(not r.base_failed for r in rows)
    assert quality_report(no_docs).count() == 0
    texts = ["a a a a a", "a b c a b c d a b", "x\nx\n \n \nx\n", "a b c", "a b c a", "q w e r t y q w e r t y u", "\n\n", "a b c d a b c d e b c d"]
    check(spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string"))


def marked(seed, every=1):
    return " ".join(w + ("&%" if i % every == 0 else "") for i, w in enumerate(prose(seed, 120).split()))


def test_limits_follow_the_corpus(spark):
    """The same texts pass where most are like them, and fail where they stand apart."""
    plain = [(i, prose(i, 120), "en", "plain", 1) for i in range(60)]
    other = [(100 + i, marked(i), "en", "marked", 1) for i in range(60)]
    few, many = plain + other[:9], plain[:9] + other
    assert {r.doc_id for r in keep_good(spark.createDataFrame(few, SCHEMA)).collect()} == {r[0] for r in plain}
    docs = spark.createDataFrame(many, SCHEMA)
    assert {r.doc_id for r in keep_good(docs).collect()} == {r[0] for r in many}
    assert keep_good(docs).columns == docs.columns


def test_values_that_go_on_without_a_gap_pass(spark):
    rows = [(i, prose(i, 120), "en", f"s{i % 4}", 1) for i in range(200)]
    rows += [(1000 + i, marked(i, every), "en", f"s{i % 4}", 1) for i, every in enumerate([60, 40, 30, 20, 12, 8, 5, 4, 3, 2, 1])]
    assert quality_report(spark.createDataFrame(rows, SCHEMA)).where("kept").count() == len(rows)


def test_sketches_add_up_and_are_near(spark):
    docs = spark.createDataFrame([(i, prose(i, 60 + i), "en", "a", 1) for i in range(200)], SCHEMA)
    stats = keyed(measured(docs)).select("lang_key", "source_key", "m", "doc_id")
    whole = Counter(map(tuple, sketches(stats).collect()))
    parts = Counter()
    for part in (stats.where("doc_id % 2 = 0"), stats.where("doc_id % 2 = 1")):
        for *key, n in sketches(part).collect():
            parts[tuple(key)] += n
    assert {(*k, n) for k, n in parts.items()} == set(whole)
    values = sorted(r[0] for r in stats.where(~base_failed(F.col("m"))).select(F.col("m.word_chars") / F.col("m.n_words")).collect())
    q1, q3 = (values[int(np.ceil(p * len(values))) - 1] for p in (0.25, 0.75))
    limit = thresholds(sketches(stats)).first()
    error = 0.02 * (1 + 2 * SPREADS) * q3
    spread = SPREADS * max(q3 - q1, 0.04 * q3)
    assert abs(limit.high_chars_per_word - (q3 + spread)) < error and abs(limit.low_chars_per_word - (q1 - spread)) < error


def levels(rows, keys):
    """Limits of symbols per word by plain Python: value lists in place of sketches."""
    groups = {}
    for row in rows:
        groups.setdefault(tuple(row[k] for k in keys), []).append(row)
    found = {}
    for key, members in groups.items():
        least = 1 / sorted(r["words"] for r in members)[(len(members) + 1) // 2 - 1]
        values = sorted(max(r["value"], least) for r in members)
        high, is_open = 2 * values[-1], True
        for v in sorted(set(values)):
            until, near = sum(x <= v for x in values), sum(v < x <= 8 * v for x in values)
            if until >= 0.5 * len(values) and near <= 0.001 * len(values) < len(values) - until - near:
                high, is_open = min(x for x in values if x > 8 * v) / 2, False
                break
        found[key] = (len(values), max(0.05, high), is_open)
    return found


def test_limits_equal_a_plain_computation(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        source, lang = rng.choice("aaaabbc"), rng.choice("xxxy")
        every = rng.choice([0, 0, 0, 0, 100, 50] + ([1, 2] if source == "a" and rng.random() < 0.4 else []) + ([1] if source == "c" else []))
        rows.append((i, marked(i, every) if every else prose(i, 60 + i % 90), lang, source, 1))
    stats = keyed(measured(spark.createDataFrame(rows, SCHEMA))).select("lang_key", "source_key", "m")
    plain = [
        {"lang_key": r.lang_key, "source_key": r.source_key, "words": r.m.n_words, "value": r.m.n_symbols / r.m.n_words}
        for r in stats.where(~base_failed(F.col("m"))).collect()
    ]
    top = levels(plain, [])[()][1]

    def drawn(own, outer):
        n, high, is_open = own
        high = max(high, outer) if is_open else high
        return min(1.5 * top, high ** (n / (n + EVEN_ROWS)) * outer ** (EVEN_ROWS / (n + EVEN_ROWS)))

    language = {k: drawn(v, top) for k, v in levels(plain, ["lang_key"]).items()}
    wanted = {k: drawn(v, language[k[:1]]) for k, v in levels(plain, ["lang_key", "source_key"]).items()}
    found = {(r.lang_key, r.source_key): r.high_symbols_per_word for r in thresholds(sketches(stats)).collect()}
    assert found.keys() == wanted.keys()
    for key, limit in wanted.items():
        assert abs(found[key] - limit) < 0.08 * limit, (key, found[key], limit)


def test_junk_does_not_set_the_limit_of_its_source(spark):
    rows = [(1000 * s + i, prose(1000 * s + i, 120), "en", f"s{s}", 1) for s in range(6) for i in range(60)]
    junk = [(10_000 + 100 * d + i, marked(100 * d + i), "en", f"dirty{d}", 1) for d, n in enumerate((12, 18, 24)) for i in range(n)]
    rows += [(20_000 + 100 * d + i, prose(100 * d + i, 120), "en", f"dirty{d}", 1) for d, n in enumerate((28, 22, 16)) for i in range(n)]
    junk += [(30_000, marked(1), "en", "single", 1), (30_001, marked(2), "xx", "alone", 1), (30_002, marked(3), None, None, 1)]
    junk += [(40_000 + i, marked(i, 2), "en", "nothing else", 1) for i in range(19)]
    junk += [(50_000 + i, marked(i), "en", "nothing else, larger", 1) for i in range(150)]
    kept = {r.doc_id for r in keep_good(spark.createDataFrame(rows + junk, SCHEMA)).collect()}
    assert kept == {r[0] for r in rows}


def test_labels(spark):
    """Labelled documents of the larger table that pass the fixed rules: bad ones go, good ones stay."""
    folder = SMALL.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op8_quality_rules(spark, folder).where("not base_failed").join(labels, "doc_id").collect()
    assert all(r.kept == (r.quality == 1) for r in rows) and len({r.kept for r in rows}) == 2
