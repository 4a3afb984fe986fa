"""Personal data: fixed patterns, and bootstrapped contextual extraction of further identifiers.

Matches of the fixed patterns are seeds. A lexical pattern is the two words before an
identifier; an instance is an identifier-like token (a digit or @, 6 to 64 characters without
spaces, or groups of digits, dots, dashes and brackets joined by single spaces, of which one in
two neighbours at least is shorter than 6 characters). The confidence of a pattern for a kind is the share of seeds of that kind among its uses, whatever
follows, and among the distinct identifiers after it; the lesser counts, so copies do not help.
Patterns with enough distinct seeds and a confidence at the limit discover: tokens after them
that no base span touches become spans of that kind, and the same tokens count as seeds for all
other patterns, until no pattern is added. A pattern never learns from what it alone discovers.

Edges are counted once per distinct pair before they move, so a frequent pattern or a group of
copies adds few rows. Uses followed by plain words are counted in the texts, for those patterns
only that the identifiers alone would let through. Null and empty texts have no spans. Rows are kept one for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import documents, let, pick, small_side, table
from bankpulse.llm.spans import SPAN, Kind, bare, count_of, joined, masked, occurrences
from bankpulse.operators.ordering import written

MIN_SEEDS = 3
MIN_CONFIDENCE = 0.8

_LOCAL = r"[A-Za-z0-9._%+-]"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _card(found: Column) -> Column:
    digits = _digits(found)
    return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)


_PART = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: The contract's patterns. Searches start at the start of a run only, and repeats that nothing
#: follows are possessive: the same matches in time linear in the text.
KINDS = [
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", gate=lambda t: t.contains("@")),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda x: x.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", _card),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: F.length(_digits(x)).between(9, 15), lambda t: t.contains("+")),
]
NAMES = [k.name for k in KINDS]
_SHORT = r"(?:[(\[][0-9][0-9().\[\]/-]{0,3}|[0-9][0-9().\[\]/-]{0,4})"
_GROUP = r"[(\[]?[0-9][0-9().\[\]/-]{0,15}"
#: Groups that end before a space or a mark, else one run without spaces.
_GROUPS = rf"(?=\S+\x20[(\[]?[0-9])(?:{_GROUP}\x20)?{_SHORT}(?:\x20{_SHORT}){{0,4}}(?:\x20{_GROUP})?(?![^\s,;:!?])"
TOKEN = Kind("token", rf"(?<!\S)(?:{_GROUPS}|(?=\S{{0,63}}[0-9@])\S{{6,64}}(?!\S))", lambda x: F.length(x) >= 6)


def context(before: Column) -> Column:
    """The two words, lower case; null if there are not two."""
    return F.nullif(F.lower(F.regexp_replace(before, r"\s+", " ")), F.lit(""))


def found(docs: DataFrame) -> DataFrame:
    """Add ``base`` (spans with what was found and the words before) and ``tokens``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.flatten(F.array(*[occurrences(text, k, i, words=True) for i, k in enumerate(KINDS)]))
    return docs.withColumn("base", base).withColumn("tokens", occurrences(text, TOKEN, 0, words=True))


def narrow(rows: DataFrame) -> DataFrame:
    """With a row number, written once."""
    return written(rows.withColumn("row", F.monotonically_increasing_id()))


def uses(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern -> followed: how often a word follows the two words, for the given patterns."""
    def pairs(words: Column) -> Column:
        return F.when(F.size(words) > 2, F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.lower(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))),
        ))

    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(r"\S+"), F.lit(0))
    every = docs.select(F.explode(let(words, pairs)).alias("pattern"))
    return every.join(small_side(patterns), "pattern").groupBy("pattern").agg(F.count("*").alias("followed"))


def discovered(rows: DataFrame, docs: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """row -> added: spans that the patterns discover; ``docs`` has the texts of the rows."""
    seeds = written(
        rows.select(F.explode("base").alias("x"))
        .select(context(F.col("x.before")).alias("pattern"), F.col("x.found").alias("instance"), F.col("x.kind").alias("kind"), "x.glued")
        .where(F.col("pattern").isNotNull())
        .groupBy("pattern", "instance", "kind").agg(F.count("*").alias("n"), F.count_if("glued").alias("glued"))
    )
    # a token belongs to the graph unless a base span touches it: that one is there as a seed
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b.start < t.end) & (t.start < b.end)))
    loose = rows.select("row", F.explode(free).alias("t")).select(
        "row", "t.start", "t.end", context(F.col("t.before")).alias("pattern"), F.col("t.found").alias("instance")
    ).where(F.col("pattern").isNotNull())
    loose = written(loose)
    edges = written(loose.groupBy("pattern", "instance").agg(F.count("*").alias("n")))
    size = (
        seeds.select("pattern", "instance", "n", "glued").union(edges.withColumn("glued", F.lit(0)))
        .groupBy("pattern", "instance").agg(F.sum("n").alias("n"), F.sum("glued").alias("glued"))
        .groupBy("pattern").agg(F.count("*").alias("instances"), F.sum("n").alias("uses"), F.sum("glued").alias("glued"))
    )

    def trusted(size: DataFrame, known: DataFrame | None = None) -> DataFrame:
        evidence = seeds.select("pattern", "kind", "n")
        if known is not None:
            votes = edges.join(known, "pattern").groupBy("instance", "kind").agg(
                F.count("*").alias("votes"), F.min("pattern").alias("voter")
            )
            learnt = edges.join(votes, "instance").where((F.col("votes") > 1) | (F.col("voter") != F.col("pattern")))
            evidence = evidence.union(learnt.select("pattern", "kind", "n"))
        mass = evidence.groupBy("pattern", "kind").agg(F.sum("n").alias("mass"), F.count("*").alias("seeds"))
        share = F.least(F.col("mass") / F.col("uses"), F.col("seeds") / F.col("instances"))
        return mass.where(F.col("seeds") >= min_seeds).join(size, "pattern").withColumn("confidence", share).where(
            F.col("confidence") >= min_confidence
        ).select("pattern", "kind", "confidence")

    def all_trusted(size: DataFrame) -> DataFrame:
        """Evidence only grows, so the patterns do, until a round adds none."""
        known = written(trusted(size))
        count, last = known.count(), 0
        while count > last:
            known, last = written(trusted(size, known.select("pattern", "kind"))), count
            count = known.count()
        return known

    # whatever the other uses are, only these can be at the limit
    size = written(size.join(edges.select("pattern"), "pattern", "left_semi"))
    able = written(size.join(all_trusted(size).select("pattern"), "pattern", "left_semi"))
    known = able.select("pattern", F.lit(0).alias("kind"), F.lit(0.0).alias("confidence"))
    if not able.isEmpty():
        counted = uses(docs, able.select("pattern"))
        known = all_trusted(written(able.join(counted, "pattern", "left").withColumn(
            "uses", F.greatest("uses", F.coalesce("followed", F.lit(0)) + F.col("glued"))
        )))
    best = known.groupBy("pattern").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
    return loose.join(best, "pattern").groupBy("row").agg(
        F.collect_list(F.struct("start", "kind", "end")).cast(SPAN).alias("added")
    )


def report(rows: DataFrame) -> DataFrame:
    """Digest columns of narrow rows that have ``base`` (bare spans) and ``added``."""
    base, every = F.col("base"), F.array_distinct(F.concat("base", F.coalesce("added", F.array().cast(SPAN))))
    return rows.select(
        "doc_id",
        *[count_of(base, i).alias(f"n_{name}") for i, name in enumerate(NAMES)],
        F.sha2(joined(base, NAMES).cast("binary"), 256).alias("base_sha256"),
        joined(every, NAMES).alias("spans"),
    )


def extract(docs: DataFrame) -> DataFrame:
    texts = pick(docs, "doc_id", "text")
    rows = narrow(found(texts).drop("text"))
    added = written(discovered(rows, texts))
    return report(rows.select("row", "doc_id", bare(F.col("base")).alias("base")).join(small_side(added), "row", "left"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with all spans masked in the text. Texts are written once beside their
    spans: finding those costs far more, and the graph reads the spans alone."""
    keep = documents(docs).columns
    rows = narrow(found(documents(docs)))
    added = small_side(written(discovered(rows.select("row", "base", "tokens"), rows.select("text"))))
    spans = F.concat(bare(F.col("base")), F.coalesce("added", F.array().cast(SPAN)))
    return rows.join(added, "row", "left").withColumn("text", masked(F.col("text"), spans, NAMES)).select(*keep)


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "documents"))
