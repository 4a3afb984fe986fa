"""Licence scan: Aho-Corasick over words for notices and tags, a shunting-yard for expressions.

A text is lower-cased (A-Z) and reduced to its words, one space between them. One automaton
holds all notice phrases and the identifier tags and finds every place of each in a single pass,
overlapping ones too; its work does not grow with the number of phrases. A tag that a colon or
equals sign follows is read on in the original text to the end of the line: the shunting-yard
takes ``with`` before ``and`` before ``or``, and parentheses. The longest start that is a whole
expression counts; what follows it (a comment's end, prose) is left.

An expression has the labels of all its licences and a grade of permission from 0 to 1: ``or``
is the better choice, ``and`` the stricter duty, ``with`` a known exception that softens a
copyleft. The permission of a document is the least of its notices and expressions; the score
is how sure it is that the document states a licence: the best confidence of a place.

Null and empty texts have no words, no labels, score 0 and no permission (null). Rows are kept
one for one: repeated rows and ties give equal rows, an empty table none, a null doc_id stays
null. Other columns of the input, whatever their names, are ignored. A text is read whole; the
memory for it is a few times its size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import chunks, pick, table


@dataclass(frozen=True)
class Notice:
    """A phrase (words in lower case) that gives a label; ``base`` ones are counted by place."""

    phrase: str
    label: str
    base: bool = False
    confidence: float = 0.9


# The phrases and labels every scan has.
BASE = (
    Notice("under the mit license", "mit", True, 1.0),
    Notice("apache license version 2", "apache-2", True, 1.0),
    Notice("cc by nc", "cc-by-nc", True, 1.0),
)
NOTICES = (
    *BASE,
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    Notice("the mit license mit", "mit"),
    Notice("licensed under apache 2 0", "apache-2"),
    Notice("gnu general public license version 2", "gpl-2"),
    Notice("gnu general public license version 3", "gpl-3"),
    Notice("gnu general public license v2", "gpl-2"),
    Notice("gnu general public license v3", "gpl-3"),
    Notice("gnu lesser general public license version 2 1", "lgpl-2.1"),
    Notice("gnu lesser general public license version 3", "lgpl-3"),
    Notice("gnu affero general public license version 3", "agpl-3"),
    Notice("mozilla public license version 2", "mpl-2"),
    Notice("mozilla public license v 2 0", "mpl-2"),
    Notice("eclipse public license version 2", "epl-2"),
    Notice("eclipse public license v 2 0", "epl-2"),
    Notice("boost software license version 1", "bsl-1"),
    Notice("redistribution and use in source and binary forms", "bsd"),
    Notice("bsd 2 clause license", "bsd-2-clause"),
    Notice("bsd 3 clause license", "bsd-3-clause"),
    Notice("under the isc license", "isc"),
    Notice("under the zlib license", "zlib"),
    Notice("cc by sa", "cc-by-sa"),
    Notice("cc by nd", "cc-by-nd"),
    Notice("cc by nc sa", "cc-by-nc-sa"),
    Notice("cc by nc nd", "cc-by-nc-nd"),
    Notice("creative commons attribution noncommercial", "cc-by-nc"),
    Notice("creative commons attribution sharealike", "cc-by-sa"),
    Notice("creative commons zero", "cc0"),
    Notice("released into the public domain", "public-domain"),
    Notice("dedicated to the public domain", "public-domain"),
    Notice("all rights reserved", "all-rights-reserved", confidence=0.5),
)
TAGS = ("spdx license identifier", "license expression")
TAG_CONFIDENCE = 1.0

#: label -> permission. Labels without one (unknown licences) have 0: nothing may be assumed.
GRADES = {
    **dict.fromkeys(("public-domain", "cc0", "unlicense", "0bsd"), 1.0),
    **dict.fromkeys(("mit", "apache-2", "bsd", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "bsl-1", "cc-by"), 0.9),
    **dict.fromkeys(("mpl-2", "lgpl-2.1", "lgpl-3", "epl-2", "cc-by-sa"), 0.6),
    **dict.fromkeys(("gpl-2", "gpl-3", "agpl-3"), 0.4),
    **dict.fromkeys(("cc-by-nd", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd"), 0.2),
    "all-rights-reserved": 0.0,
}
#: Exceptions that let a copyleft work be linked: the grade becomes that of weak copyleft.
EXCEPTIONS = ("classpath-exception", "gcc-exception", "llvm-exception", "linux-syscall-note", "font-exception")
LINKABLE = 0.6
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_AFTER_TAG = re.compile(rb"[ \t]*[:=][ \t]*[\"']?([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*|\S")


def label_of(identifier: str) -> str:
    """The label of an identifier: lower case, without "only", "or later", a closing ".0", and
    without any version for Creative Commons."""
    name = identifier.lower().removesuffix("+").removesuffix("-only").removesuffix("-or-later")
    if name.startswith("cc"):
        return re.sub(r"-[0-9.]+$", "", name)
    return name.removesuffix(".0")


def is_identifier(token: str) -> bool:
    """Known, or written like an identifier and unlike a word of prose."""
    return bool(re.match("[A-Za-z0-9]", token)) and (label_of(token) in GRADES or bool(re.search("[0-9-]", token)))


def evaluate(text: str) -> tuple[str, list[str], float] | None:
    """(expression, labels in order, permission) of the longest start of ``text`` that is a
    whole expression, or None."""
    tokens, whole, depth, operand, exception = [], 0, 0, True, False
    for token in _TOKEN.findall(text):
        word = token.lower()
        if operand and word == "(" and not exception:
            depth += 1
        elif operand and word not in PRECEDENCE and is_identifier(token):
            # the right side of "with" is one exception, its left side one licence
            operand, exception = False, False
        elif not operand and word == ")" and depth:
            depth -= 1
        elif not operand and word in PRECEDENCE:
            if word == "with" and (tokens[-1] == ")" or tokens[-2:-1] == ["with"]):
                break
            operand, exception = True, word == "with"
        else:
            break
        tokens.append(word)
        if not operand and not depth:
            whole = len(tokens)
    tokens = tokens[:whole]
    if not tokens:
        return None

    values: list[tuple[str | None, float]] = []  # name of a single licence, grade
    waiting: list[str] = []
    labels: dict[str, None] = {}

    def apply(operator: str) -> None:
        (right, high), (left, low) = values.pop(), values.pop()
        if operator == "with":
            soft = any(right.startswith(e) for e in EXCEPTIONS)
            values.append((None, max(low, LINKABLE) if soft and low > 0.2 else low))
        else:
            values.append((None, (min if operator == "and" else max)(low, high)))

    for at, token in enumerate(tokens):
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                apply(waiting.pop())
            waiting.pop()
        elif token in PRECEDENCE:
            while waiting and PRECEDENCE.get(waiting[-1], 0) >= PRECEDENCE[token]:
                apply(waiting.pop())
            waiting.append(token)
        elif tokens[at - 1 : at] == ["with"]:
            values.append((token, 0.0))
        else:
            label = label_of(token)
            values.append((label, GRADES.get(label, 0.0)))
            labels[f"{label}-with-{tokens[at + 2]}" if tokens[at + 1 : at + 2] == ["with"] else label] = None
    while waiting:
        apply(waiting.pop())
    return " ".join(tokens).replace("( ", "(").replace(" )", ")"), list(labels), values[0][1]


class Scanner:
    """The automaton of the phrases and tags; made once in each task."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES) -> None:
        # several notices may have one phrase
        self.automaton = ahocorasick.Automaton()
        for number, notice in enumerate(notices):
            self._add(notice.phrase, number)
        for tag in TAGS:
            self._add(tag, -1)
        self.automaton.make_automaton()
        self.notices = notices

    def _add(self, phrase: str, number: int) -> None:
        key = f" {phrase} ".encode().decode("latin-1")
        known = self.automaton.get(key, (len(key), len(phrase.split()), ()))
        self.automaton.add_word(key, (*known[:2], (*known[2], number)))

    def scan(self, text: bytes) -> tuple[int, list[dict], list[dict]]:
        """Words; places of notices in order; expressions in order."""
        plain = text.translate(_WORDS)
        words = plain.split(b" ")
        words = [w for w in words if w] if b"" in words else words
        spaced = b" " + b" ".join(words) + b" "
        places, after = [], []
        at = counted = 0
        for end, (length, size, numbers) in self.automaton.iter(spaced.decode("latin-1")):
            # places end in order, so words are counted on from the last one
            at += spaced.count(b" ", counted, end)
            counted = end
            start = at - size
            for number in numbers:
                if number < 0:
                    after.append(start + size)
                else:
                    notice = self.notices[number]
                    places.append({"label": notice.label, "start": start, "words": size, "base": notice.base, "confidence": notice.confidence})
        return len(words), sorted(places, key=lambda p: (p["start"], p["words"], p["label"])), self._expressions(text, plain, after)

    @staticmethod
    def _expressions(text: bytes, plain: bytes, after: list[int]) -> list[dict]:
        if not after:
            return []
        found, wanted = [], set(after)
        for number, word in enumerate(re.finditer(rb"[^ ]+", plain), start=1):
            if number in wanted and (line := _AFTER_TAG.match(text, word.end())):
                read = evaluate(line.group(1).decode("utf-8", "replace"))
                if read:
                    found.append({"expression": read[0], "labels": read[1], "permission": read[2]})
        return found


PLACES = "array<struct<label:string,start:long,words:int,base:boolean,confidence:double>>"
EXPRESSIONS = "array<struct<expression:string,labels:array<string>,permission:double>>"


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """doc_id, n_words, places (of notices), expressions (after tags): a row per document."""
    schema = f"doc_id long, n_words long, places {PLACES}, expressions {EXPRESSIONS}"
    places = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int32()), ("base", pa.bool_()), ("confidence", pa.float64())]))
    expressions = pa.list_(pa.struct([("expression", pa.string()), ("labels", pa.list_(pa.string())), ("permission", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for chunk in chunks(batches):
            found = [scanner.scan(t or b"") for t in chunk.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"), pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], places), pa.array([f[2] for f in found], expressions),
                ],
                ["doc_id", "n_words", "places", "expressions"],
            )

    return pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("binary")).mapInArrow(run, schema)


def report(found: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Digest columns of scanned rows."""
    base = F.filter("places", lambda p: p.base)
    grades = F.create_map(*[F.lit(x) for pair in GRADES.items() for x in pair])
    tagged = F.flatten(F.col("expressions.labels"))
    names = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    sure = F.concat(F.col("places.confidence"), F.transform("expressions", lambda e: F.lit(TAG_CONFIDENCE)))
    allowed = F.concat(
        F.transform("places", lambda p: F.coalesce(F.element_at(grades, p.label), F.lit(0.0))), F.col("expressions.permission")
    )
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p.start)).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p.start)).alias("last_word"),
        names(F.transform(base, lambda p: p.label)).alias("base_labels"),
        names(F.concat(F.col("places.label"), tagged)).alias("labels"),
        F.coalesce(F.array_max(sure), F.lit(0.0)).alias("score"),
        F.array_min(allowed).alias("permission"),
        F.array_join(F.col("expressions.expression"), "; ").alias("expressions"),
    )


def op11_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return report(scan(table(spark, folder, "documents")))
