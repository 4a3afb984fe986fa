"""Spans of pattern matches as column expressions: code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankpulse.llm.common import let

SPAN = "array<struct<start:int,kind:int,end:int>>"
FOUND = "array<struct<start:int,kind:int,end:int,found:string,before:string,glued:boolean>>"
BLOCK = 64
#: Characters, then matches, that are looked back for the words before a match.
CONTEXT = 64
LOOK_BACK = [0, 2, 16, 128, 1024, 1 << 30]
TWO_WORDS = r"(\S++\s++\S++)\s*+$"


@dataclass(frozen=True)
class Kind:
    """A named pattern; ``gate`` is a quick necessary test of the text, ``valid`` drops matches."""

    name: str
    pattern: str
    valid: Callable[[Column], Column] | None = None
    gate: Callable[[Column], Column] | None = None


def before_each(lengths: Column) -> Column:
    """Sums of the lengths before each place. Blocks are summed first, so the work is
    ``BLOCK`` steps a place and not the whole array."""
    number = lambda n: F.sequence(F.lit(0), n - 1)
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def of_blocks(blocks: Column) -> Column:
        return let(F.transform(blocks, add), lambda sums: let(
            F.transform(sums, lambda _, b: add(F.slice(sums, F.lit(1), b))),
            lambda bases: F.transform(lengths, lambda _, i: (
                F.get(bases, (i / BLOCK).cast("int"))
                + add(F.slice(F.get(blocks, (i / BLOCK).cast("int")), F.lit(1), i % BLOCK))
            )),
        ))

    count = F.ceil(F.size(lengths) / BLOCK).cast("int")
    blocks = F.transform(number(count), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(let(blocks, of_blocks))


def words_before(gaps: Column, units: Column, i: Column) -> Column:
    """The two words before match ``i``, or empty; a part of a word counts that the match ends.
    ``units`` are gap and match in turn. Only as much text is put together as it takes."""
    def within(text: Column) -> Column:
        return F.nullif(F.regexp_extract(text, rf"(?<=\s){TWO_WORDS}", 1), F.lit(""))

    gap = F.get(gaps, i)
    tries = [within(F.right(gap, F.lit(CONTEXT)))]
    for back in LOOK_BACK:
        count = F.least(i, F.lit(back))
        text = F.concat(F.array_join(F.slice(units, i - count + 1, count), ""), gap)
        tries.append(F.when(i <= back, F.regexp_extract(text, rf"(?<!\S){TWO_WORDS}", 1)).otherwise(within(text)))
    return F.coalesce(*tries)


def occurrences(text: Column, kind: Kind, number: int, words: bool = False) -> Column:
    """All valid matches, with the text found and, if asked, the two words just before it
    (``before``, spaced as there; empty if there are not two). The pattern splits the text into
    gaps; gaps and matches in turn give the places. Texts without a match cost one search, or
    the gate alone."""
    pattern = F.lit(kind.pattern)

    def located(gaps: Column, found: Column) -> Column:
        steps = F.transform(found, lambda x, i: F.length(F.get(gaps, i)) + F.length(x))
        units = F.transform(found, lambda x, i: F.concat(F.get(gaps, i), x)) if words else F.lit(None)
        return let(F.struct(steps.alias("s"), units.alias("u")), lambda c: let(before_each(c.s), lambda starts: F.transform(found, lambda x, i: F.struct(
            (F.get(starts, i) + F.length(F.get(gaps, i))).alias("start"),
            F.lit(number).alias("kind"),
            (F.get(starts, i) + F.get(c.s, i)).alias("end"),
            x.alias("found"),
            (words_before(gaps, c.u, i) if words else F.lit(None).cast("string")).alias("before"),
            (F.get(gaps, i).rlike(r"\S$") | ((F.get(gaps, i) == "") & (i > 0))).alias("glued"),
        ))))

    every = let(F.split(text, kind.pattern, -1), lambda gaps: let(
        F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: located(gaps, found)
    ))
    if kind.valid is not None:
        every = F.filter(every, lambda x: kind.valid(x.found))
    there = F.regexp_like(text, pattern)
    if kind.gate is not None:
        there = kind.gate(text) & there
    return F.when(there, every).otherwise(F.array().cast(FOUND)).cast(FOUND)


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ","
    )


def bare(found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.end.alias("end")))


def count_of(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == number)).cast("long")


def masked(text: Column, spans: Column, kinds: list[str]) -> Column:
    """The text with every span as ``<KIND>``; overlapping spans get the mark of the first."""
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in kinds])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s.start >= done.at
        kept = F.when(fresh, F.concat(F.substring(text, done.at + 1, s.start - done.at), F.get(marks, s.kind))).otherwise("")
        return F.struct(F.greatest(done.at, s.end).alias("at"), F.concat(done.out, kept).alias("out"))

    done = F.aggregate(
        F.sort_array(spans), start, step,
        lambda d: F.concat(d.out, F.substring(text, d.at + 1, F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(done)
