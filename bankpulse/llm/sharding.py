"""Proportional stratified interleaving of documents over shards.

Rows of a source are shuffled by a seeded digest and ranked; rank r of n has the fractional
rank (r - 1/2) / n. All rows sorted by fractional rank form a sequence in which any stretch
has the sources in their overall shares; it is cut into shards whose counts differ by one at
most (law ``rows``). Both rankings are range shuffles of narrow rows with one offset per
piece, so a source of any size is spread; the text itself is not shuffled.

Null sources are a stratum of their own; null texts have size 1 and the checksum of no bytes.
Repeated rows are told apart by their place in the input. With fewer rows than shards, some
shards stay empty. Equal texts are not held together: shards follow the mixture, not content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import pick, table
from bankpulse.operators.ordering import numbered, running_totals, written

SHARDS = 16
SEED = 11


def narrow_rows(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, stratum, size, text_crc32, the shuffling digest and a row number, written once."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return written(
        pick(docs, "doc_id", "text", "source").select(
            "doc_id",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary")).alias("shuffled"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    rows = narrow_rows(docs, seed).withColumn("one", F.lit(1))
    order = [F.col(c) for c in ("shuffled", "text_crc32", "row")]
    ranked = running_totals(rows, "stratum", order, "one", "rank")
    strata = rows.groupBy("stratum").agg(F.count("*").alias("n"))
    placed = numbered(
        ranked.join(strata, "stratum").withColumn("fraction", (F.col("rank") - 0.5) / F.col("n")),
        *[F.col(c) for c in ("fraction", "stratum", "shuffled", "text_crc32", "row")],
    )
    at = F.col("rn") - 1
    number = F.expr(f"((rn * {shards} - 1) div n_rows)")
    first = F.call_function("div", F.col("shard") * F.col("n_rows"), F.lit(shards))
    return placed.withColumn("shard", number.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (at - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(table(spark, folder, "documents"))


# The checksum has no DuckDB function: a list of the 256 byte remainders is made and folded over the bytes.
ORACLE = f"""
WITH crc AS (
  SELECT list(r ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM range(256) x(b))
), d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS stratum,
         md5(concat_ws(':', '{SEED}', doc_id::VARCHAR)) AS shuffled FROM documents
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY shuffled) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS fraction FROM d
), g AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, shuffled) AS rn, count(*) OVER () AS n FROM r
), s AS (SELECT *, (rn * {SHARDS} - 1) // n AS shard, hex(encode(text)) AS h FROM g)
SELECT doc_id, strlen(text) + 1 AS size,
       xor(list_reduce(
         list_prepend(4294967295::BIGINT, list_transform(range(strlen(text)), lambda i: (16 * (instr('0123456789ABCDEF', array_extract(h, 2 * i + 1)) - 1) + instr('0123456789ABCDEF', array_extract(h, 2 * i + 2)) - 1)::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
       'rows' AS law, shard::INT AS shard, (rn - 1 - shard * n // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
FROM s, crc
"""
