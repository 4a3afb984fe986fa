"""Quality rules with thresholds that follow the corpus, the language and the source.

Fixed rules come first: fewer than 50 words, or more than half of the words in 3-word windows
that occur again. The other measures get their limits from the corpus: per language and source
a quantile sketch counts values in buckets of geometric width (2 % relative error). Buckets
add up, so tasks sketch their rows, Spark adds the counts, and the sketches of languages and of
the corpus are sums of those of their parts.

Measures that are zero for most documents have no spread to go by. Their limit is set by a gap:
the bulk starts at zero (or less than one in a document of median length) and goes on as long as
rows follow within three octaves. What lies beyond such a gap, if it is more than stray rows, is
another kind of text, and the limit is half of where it starts. Without a gap the rule is open
(twice the largest value). Letters per word have a spread in every text: limits lie ten
quartile distances beyond the quartiles.

Own limits of few rows mean little, so a language is drawn towards the corpus and a source
towards its language by its number of rows. No source may excuse more than half as much again as
the corpus allows: as limits are half of where the other kind starts, a source that is nothing
but junk is rejected whatever its size, unless such text is half of the corpus. The limits are
joined to the documents and all rules are applied together.

Null texts have no words and fail. Null languages and sources form groups of their own.
Rows are kept one for one; repeated rows get equal verdicts, ties at a limit pass, an empty table
gives none, a null doc_id is kept as it is, and further columns are ignored. A text is measured
whole, however long.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bankpulse.llm.common import SPACE, WORD, documents, let, pick, small_side, table
from bankpulse.operators.ordering import written

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Widths of the sketch: values are counted in buckets (g^(k-1), g^k], g = (1 + e) / (1 - e).
RELATIVE_ERROR = 0.02
GROWTH = math.log((1 + RELATIVE_ERROR) / (1 - RELATIVE_ERROR))
SMALLEST = 1e-6
#: Measures whose limit is set by a gap, and those with limits on both sides of the quartiles.
GAPPED = ("symbols_per_word", "dup_lines_per_word", "repeated_share")
FENCED = ("chars_per_word",)
UPPER, LOWER = GAPPED + FENCED, FENCED
#: A gap: so many buckets (three octaves) with no more than stray rows, beyond half of all rows.
GAP = round(math.log(8) / GROWTH)
BULK, STRAY = 0.5, 0.001
#: No rule rejects for less than a twentieth of the words.
FLOOR = 0.05
SPREADS = 10.0
#: Rows at which a group's own limit weighs as much as that of the level above: a thousand, of
#: which one row is the stray share.
EVEN_ROWS = 1000
#: What a group may allow, in limits of the corpus; below 2, so nothing beyond its gap.
EXCUSE = 1.5
STRATUM = ["lang_key", "source_key"]


def windows(words: Column) -> Column:
    """A hash of every 3-word window."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )


def covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: positions are sorted by hash, those
    beside an equal hash stay, and each adds the words up to the next one, three at most."""
    def stays(pairs: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(pairs, lambda p, i: p.h.eqNullSafe(F.get(pairs, i - 1).h) | p.h.eqNullSafe(F.get(pairs, i + 1).h)),
            lambda p: p.i,
        ))

    def width(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(pairs, lambda p: let(stays(p), width))


def measured(docs: DataFrame) -> DataFrame:
    """Add struct ``m``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(rf"[^{SPACE}]"))

    def of_words(words: Column) -> Column:
        repeated = F.when(F.size(words) < 4, F.lit(0)).otherwise(let(
            windows(words),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
        ))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated.cast("long").alias("n_repeat_words"),
        )

    return docs.withColumn("m", let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words))


def measures(m: Column) -> dict[str, Column]:
    words = F.greatest(m.n_words, F.lit(1))
    return {
        "symbols_per_word": m.n_symbols / words,
        "dup_lines_per_word": m.n_dup_lines / words,
        "repeated_share": m.n_repeat_words / words,
        "chars_per_word": m.word_chars / words,
    }


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "lang_key": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")),
        "source_key": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
    })


def base_failed(m: Column) -> Column:
    return (m.n_words < MIN_WORDS) | (100 * m.n_repeat_words > MAX_REPEATED_PERCENT * m.n_words)


def sketches(stats: DataFrame) -> DataFrame:
    """lang_key, source_key, measure, bucket, rows: counts that add up over any split of the rows."""
    m = F.col("m")
    values = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), value.alias("value"))
        for name, value in {**measures(m), "n_words": m.n_words.cast("double")}.items()
    ]))
    value = F.col("x.value")
    bucket = F.when(value <= SMALLEST, F.lit(None)).otherwise(F.ceil(F.log(value) / GROWTH)).cast("int")
    return (
        stats.where(~base_failed(m)).select(*STRATUM, values.alias("x"))
        .groupBy(*STRATUM, F.col("x.measure").alias("measure"), bucket.alias("bucket"))
        .agg(F.count("*").alias("rows"))
    )


def value_of(bucket: Column) -> Column:
    return 2 * F.exp(bucket * GROWTH) / (F.exp(F.lit(GROWTH)) + 1)


def own_limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys`` and measure: all (rows), high and low limits, and whether high is open."""
    group = [*keys, "measure"]
    # one in a document of median length is the least that a share can mean
    words = sketch.where("measure = 'n_words'").groupBy(*keys, "bucket").agg(F.sum("rows").alias("rows"))
    order = W.partitionBy(*keys).orderBy("bucket")
    words = words.withColumns({
        "until": F.sum("rows").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)),
        "all": F.sum("rows").over(W.partitionBy(*keys)),
    }).where("2 * until >= all").groupBy(*keys).agg((-F.min("bucket")).alias("least"))
    counted = sketch.where("measure <> 'n_words'")
    with_least = counted.join(words, keys) if keys else counted.crossJoin(words)  # the right side is one row
    share = F.col("measure").isin(*GAPPED)
    bucket = F.when(share, F.greatest("bucket", "least")).otherwise(F.col("bucket"))  # greatest skips nulls
    ranked = with_least.groupBy(*group, bucket.alias("bucket")).agg(F.sum("rows").alias("rows"))
    order = W.partitionBy(*group).orderBy("bucket")
    ranked = ranked.withColumns({
        "until": F.sum("rows").over(order.rangeBetween(W.unboundedPreceding, W.currentRow)),
        "near": F.coalesce(F.sum("rows").over(order.rangeBetween(1, GAP)), F.lit(0)),
        "next": F.min("bucket").over(order.rangeBetween(GAP + 1, W.unboundedFollowing)),
        "all": F.sum("rows").over(W.partitionBy(*group)),
    })
    stray = STRAY * F.col("all")
    gap = (F.col("until") >= BULK * F.col("all")) & (F.col("near") <= stray) & (
        F.col("all") - F.col("until") - F.col("near") > stray
    )
    cuts = ranked.groupBy(*group).agg(
        F.first("all").alias("all"), F.max("bucket").alias("most"), F.min(F.when(gap, F.col("next"))).alias("far"),
        *[value_of(F.min(F.when(F.col("until") >= F.col("all") * q, F.col("bucket")))).alias(n) for n, q in (("q1", 0.25), ("q3", 0.75))],
    )
    # less spread than the sketch can tell apart counts as that
    spread = SPREADS * F.greatest(F.col("q3") - F.col("q1"), 2 * RELATIVE_ERROR * F.col("q3"))
    gapped = F.greatest(F.lit(FLOOR), F.coalesce(value_of(F.col("far")) / 2, 2 * value_of(F.col("most"))))
    return cuts.select(
        *group, "all", (share & F.col("far").isNull()).alias("open"),
        F.when(share, gapped).otherwise(F.col("q3") + spread).alias("high"),
        F.when(~share, F.col("q1") - spread).alias("low"),
    )


def below(own: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """``own`` limits drawn towards those of the level ``above`` (joined by ``keys``), which has
    the corpus limit ``top`` as well: high on a scale of ratios, low on one of differences."""
    outer = above.select(*keys, F.col("high").alias("outer_high"), F.col("low").alias("outer_low"), "top", "bottom")
    weight = F.col("all") / (F.col("all") + EVEN_ROWS)
    # an open rule says only that nothing stands out, not that less should be allowed
    mine = F.when(F.col("open"), F.greatest("high", "outer_high")).otherwise(F.col("high"))
    high = F.exp(weight * F.log(mine) + (1 - weight) * F.log("outer_high"))
    return own.join(outer, keys).withColumns({
        "high": F.least(high, EXCUSE * F.col("top")),
        "low": F.greatest(weight * F.col("low") + (1 - weight) * F.col("outer_low"), F.col("bottom") / EXCUSE),
    }).drop("outer_high", "outer_low")


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per language and source: columns high_ and low_ with the limit of each measure."""
    corpus = own_limits(sketch, []).withColumns({"top": F.col("high"), "bottom": F.col("low")})
    language = below(own_limits(sketch, STRATUM[:1]), corpus, ["measure"])
    limits = below(own_limits(sketch, STRATUM), language, [*STRATUM[:1], "measure"])
    return limits.groupBy(*STRATUM).agg(*[
        F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{side}_{name}")
        for side, names in (("high", UPPER), ("low", LOWER)) for name in names
    ])


def broken(m: Column) -> dict[str, Column]:
    """rule -> whether the measures are past the limit; a limit that no row set is open."""
    values = measures(m)
    over = {n: F.coalesce(values[n] > F.col(f"high_{n}"), F.lit(False)) for n in UPPER}
    under = {f"low_{n}": F.coalesce(values[n] < F.col(f"low_{n}"), F.lit(False)) for n in LOWER}
    return {"base": base_failed(m), **over, **under}


def judged(rows: DataFrame) -> DataFrame:
    """Written rows with ``m`` and the keys, with the rules each breaks and ``kept``."""
    limits = small_side(written(thresholds(written(sketches(rows)))))
    rules = F.filter(F.array(*[F.when(broke, F.lit(name)) for name, broke in broken(F.col("m")).items()]), lambda x: x.isNotNull())
    return rows.join(limits, STRATUM, "left").withColumn("rules", rules).withColumn("kept", F.size("rules") == 0)


def quality_report(docs: DataFrame) -> DataFrame:
    stats = written(keyed(measured(pick(docs, "doc_id", "text", "lang", "source"))).drop("text", "lang", "source"))
    return judged(stats).select("doc_id", "m.*", base_failed(F.col("m")).alias("base_failed"), "kept", F.array_join("rules", ",").alias("rules"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass. Texts are written once beside their measures, which cost far more
    than that; the sketches then read the measures alone."""
    rows = documents(docs)
    stats = written(keyed(measured(rows)))
    return judged(stats).where("kept").select(*rows.columns)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(table(spark, folder, "documents"))
