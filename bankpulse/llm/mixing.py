"""Mixing of sources to target weights by Efraimidis-Spirakis sampling.

Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share all words; a target
stops at ``max_epochs`` times its source, and what is over is shared again by weight. A source
is taken in complete epochs as often as its target holds it. For the rest each document draws
an exponential key divided by its quality weight; in key order, documents are taken whole
until their words are as near to the rest as a whole document allows.

The draw is a digest of seed and doc_id: reruns agree. Prefix sums are cut by a range shuffle
over (source, key), so a source of any size is spread. Documents without words take 0 and
change nothing; a source without words has target 0; repeated rows are drawn alike and told
apart by their place in the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bankpulse.llm.common import BROADCAST_IDS, WORD, documents, pick, small_side, table
from bankpulse.operators.ordering import running_totals, written

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 7
DRAW_HEX = 12
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def quality(text: Column) -> Column:
    """Weight from 0.05 to 1 that falls with the share of symbols among the characters."""
    text = F.coalesce(text, F.lit(""))
    clean = F.length(F.translate(text, SYMBOLS, ""))
    share = (F.length(text) - clean) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.05), 1 - 5 * share)


def draw(doc_id: Column, seed: int) -> Column:
    """Uniform in (0, 1) from a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, DRAW_HEX), 16, 10).cast("long") + 0.5) / float(16**DRAW_HEX)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """stratum, source_size -> target. One row per source, so one task orders them: sources
    are capped in order of cap over weight until the share of the others is under their cap."""
    by_name = W.orderBy(F.col("stratum") == "", "stratum")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ordered = W.orderBy("ratio", "stratum")
    until, rest = ordered.rowsBetween(W.unboundedPreceding, W.currentRow), ordered.rowsBetween(W.currentRow, W.unboundedFollowing)
    cap = F.col("source_size") * max_epochs
    return (
        sizes.withColumn("weight", weight).withColumn("ratio", cap / F.col("weight"))
        # the share per weight if all sources before this one are capped
        .withColumn("level", (F.sum("source_size").over(W.partitionBy()) - (F.sum(cap).over(until) - cap)) / F.sum("weight").over(rest))
        .withColumn("free", F.col("level") <= F.col("ratio"))
        .withColumn("level", F.min(F.struct(~F.col("free"), "ratio", "stratum", "level")).over(W.partitionBy()))
        .withColumn("level", F.when(F.col("level.col1"), F.lit(None)).otherwise(F.col("level.level")))
        .withColumn("target", F.least(cap.cast("double"), F.coalesce(F.col("level") * F.col("weight"), cap.cast("double"))))
        .select("stratum", "source_size", "target")
    )


def mix(
    docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, extra: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies (how often the document is taken), and
    the ``extra`` columns of the input."""
    rows = written(
        pick(docs, "doc_id", "text", "source", *extra).select(
            "doc_id", *extra,
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum"),
            words(F.col("text")).alias("size"),
            (-F.log(draw(F.col("doc_id"), seed)) / quality(F.col("text"))).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    sizes = rows.groupBy("stratum").agg(F.sum("size").alias("source_size"))
    shares = written(targets(sizes, weights, max_epochs))
    summed = running_totals(rows, "stratum", [F.col("key"), F.col("doc_id"), F.col("row")], "size", "until")
    whole = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long")
    rest = F.col("target") - whole * F.col("source_size")
    more = (F.col("size") > 0) & (F.col("until") - F.col("size") / 2 < rest)
    copies = whole + more.cast("long")
    return summed.join(small_side(shares), "stratum").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * copies).alias("taken"),
        F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).alias("copies"), *extra,
    )


def repeat_mixed(docs: DataFrame) -> DataFrame:
    """The documents, each as often as the mix takes it; those taken 0 times go. Rows equal in
    doc_id and text are taken alike, as often as the most taken of them."""
    rows = documents(docs)
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    taken = mix(keyed, extra=("text_key",)).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("hashed"))
    times = small_side(written(taken.agg(F.max("copies").alias("copies")).where("copies > 0")), BROADCAST_IDS)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("hashed"))
    return keyed.join(times, same).withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*rows.columns)


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).drop("copies")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS stratum, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS size,
    -ln(((('0x' || md5(concat_ws(':', '{SEED}', doc_id::VARCHAR))[1:{DRAW_HEX}])::BIGINT) + 0.5::DOUBLE) / {float(16**DRAW_HEX)}::DOUBLE)
      / greatest(0.05::DOUBLE, 1 - 5 * ((length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{SYMBOLS}', '')))::DOUBLE
                                        / greatest(length(coalesce(text, '')), 1))) AS key
  FROM documents
), s AS (SELECT stratum, sum(size)::BIGINT AS source_size FROM d GROUP BY 1
), w AS (SELECT *, (row_number() OVER (ORDER BY stratum = '', stratum) - 1) % 3 + 1 AS weight FROM s
), o AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / weight, stratum) AS k FROM w
), l AS (
  SELECT o.*, ((SELECT sum(source_size) FROM o)::BIGINT - coalesce((SELECT sum(cap) FROM o b WHERE b.k < o.k), 0)::BIGINT)::DOUBLE
    / (SELECT sum(weight) FROM o b WHERE b.k >= o.k)::DOUBLE AS level FROM o
), f AS (SELECT min_by(level, k) AS level FROM l WHERE level <= cap::DOUBLE / weight
), t AS (SELECT stratum, source_size, least(cap::DOUBLE, coalesce(f.level * weight, cap::DOUBLE)) AS target FROM o, f
), c AS (
  SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY stratum ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS until,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM d JOIN t USING (stratum)
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN size > 0 AND until - size / 2.0::DOUBLE < target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
