"""Secret scan over a trigram inverted index.

Every rule's pattern is parsed into a Boolean query of trigrams that each match must contain
(literals in sequence, alternatives, optional parts; letters are folded to lower case). The
index holds, for the trigrams that the queries name, the postings (trigram, document). Postings
are intersected per clause by counting; documents that satisfy a query are verified with the
pattern itself, all others cannot match. Rules without mandatory trigrams scan every text.

Documents are identified in the index by doc_id and a hash of the text, so repeated rows share
their postings and equal rows get equal results. Null and empty texts have no spans.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import let, pick, small_side, table
from bankpulse.llm.spans import SPAN, Kind, bare, count_of, joined, occurrences
from bankpulse.operators.ordering import written

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Base kinds first, in the contract's order. A hex run is matched from 24 characters on, which
#: leaves the same spans as matching all runs and dropping the short ones.
KINDS = [
    Kind("assign", _ASSIGN, lambda x: F.length(F.regexp_extract(x, _ASSIGN, 1)) >= 6),
    Kind("access", r"AKIA[A-Z0-9]+", lambda x: F.length(x) >= 20),
    Kind("hex", r"[0-9a-f]{24,}+"),
    Kind("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Kind("forge_token", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}"),
    Kind("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
NAMES = [k.name for k in KINDS]
N_BASE = 3
#: Alternatives of a literal part that a query follows before it gives up on the part.
MOST_STRINGS = 16

Query = list[frozenset[str]]  # alternatives; each names the trigrams that must all be present


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _pieces(pattern: str) -> list[list[str]]:
    """Runs of the pattern that match one of a few literal strings, lower case; what lies
    between two runs can match anything."""
    unit = re.compile(
        r"(?P<group>\((?:\?[a-z]*:)?(?P<inner>[^()]*)\))|(?P<set>\[(?:\\.|[^\]\\])*\])|(?P<escape>\\x[0-9A-Fa-f]{2}|\\.)|(?P<char>[^\\\[(|)])"
    )
    repeat = re.compile(r"(?:[?*+]|\{\d+,?\d*\})[+?]?")
    runs: list[list[str]] = [[""]]
    at = 0
    while at < len(pattern):
        m = unit.match(pattern, at)
        if m is None:
            raise ValueError(f"cannot read {pattern!r} at {at}")
        at = m.end()
        if m["group"]:
            options = [s for branch in m["inner"].split("|") for s in (_strings(branch) or [])]
            known = all(_strings(branch) is not None for branch in m["inner"].split("|"))
        elif m["set"]:
            options, known = [], False
        elif m["escape"]:
            literal = chr(int(m["escape"][2:], 16)) if m["escape"].startswith(r"\x") else m["escape"][1:]
            options, known = [literal], m["escape"].startswith(r"\x") or not m["escape"][1:].isalnum()
        else:
            options, known = [m["char"]], m["char"] != "."
        if quantity := repeat.match(pattern, at):
            at = quantity.end()
            if quantity[0] == "?" and known:
                options = [*options, ""]
            else:
                known = False
        joined_runs = [a + b.lower() for a, b in product(runs[-1], options)] if known else []
        if known and len(joined_runs) <= MOST_STRINGS:
            runs[-1] = joined_runs
        else:
            runs.append([""])
    return runs


def _strings(branch: str) -> list[str] | None:
    """All strings that a branch without groups matches, if they are few."""
    runs = _pieces(branch) if branch else [[""]]
    return runs[0] if len(runs) == 1 else None


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigram sets of which every match contains one whole; [] if a match
    need not contain any trigram."""
    clauses: Query = []
    for run in _pieces(pattern):
        options = {trigrams(s) for s in run}
        if frozenset() in options:
            continue  # this run asks for nothing
        clauses = [a | b for a, b in product(clauses, options)] if clauses else list(options)
        if len(clauses) > MOST_STRINGS:
            break
    return sorted(set(clauses), key=sorted)


def candidates(index: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """(doc_id, text_key, rules): documents whose postings satisfy a rule's query."""
    clauses = [(t, rule, i, len(c)) for rule, q in queries.items() for i, c in enumerate(q) for t in sorted(c)]
    wanted = index.sparkSession.createDataFrame(clauses, "trigram string, rule int, clause int, needed long")
    return (
        index.distinct().join(F.broadcast(wanted), "trigram")  # as many rows as the rules name trigrams
        .groupBy("doc_id", "text_key", "rule", "clause", "needed").agg(F.count("*").alias("n"))
        .where(F.col("n") == F.col("needed"))
        .groupBy("doc_id", "text_key").agg(F.collect_set("rule").alias("rules"))
    )


def scan(docs: DataFrame, kinds: list[Kind] = KINDS) -> DataFrame:
    """doc_id, and all spans by kind number, a row per document."""
    queries = {i: q for i, k in enumerate(kinds) if (q := trigram_query(k.pattern))}
    vocabulary = sorted({t for q in queries.values() for c in q for t in c})
    texts = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    full = [bare(occurrences(F.col("text"), k, i)) for i, k in enumerate(kinds) if i not in queries]
    present = let(F.lower("text"), lambda folded: F.filter(F.array(*map(F.lit, vocabulary)), lambda t: F.contains(folded, t)))
    rows = written(texts.select(
        "doc_id", "text_key", F.concat(F.array().cast(SPAN), *full).alias("scanned"), present.alias("trigrams")
    ))
    index = rows.select(F.explode("trigrams").alias("trigram"), "doc_id", "text_key")
    chosen = small_side(written(candidates(index, queries)))
    same = lambda a, b: a.doc_id.eqNullSafe(b.doc_id) & (a.text_key == b.text_key)
    looked = texts.join(chosen, same(texts, chosen)).select(
        texts.doc_id, texts.text_key, F.flatten(F.array(*[
            F.when(F.array_contains("rules", i), bare(occurrences(F.col("text"), kinds[i], i))).otherwise(F.array().cast(SPAN))
            for i in queries
        ])).alias("verified"),
    )
    looked = small_side(written(looked.where(F.size("verified") > 0).dropDuplicates(["doc_id", "text_key"])))
    return rows.join(looked, same(rows, looked), "left").select(
        rows.doc_id, F.concat("scanned", F.coalesce("verified", F.array().cast(SPAN))).alias("spans")
    )


def report(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s.kind < N_BASE)
    return found.select(
        "doc_id",
        *[count_of(F.col("spans"), i).alias(f"n_{NAMES[i]}") for i in range(N_BASE)],
        F.sha2(joined(base, NAMES).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans"), NAMES).alias("spans"),
    )


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return report(scan(table(spark, folder, "documents")))
