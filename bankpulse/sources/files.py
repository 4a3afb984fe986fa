"""Reading and writing the delimited files of the pipeline.

Columns are found by name in the header of each file, so files of a folder may order them
differently. A line that cannot be read does not stop the job: ``rejected_lines`` returns it,
and accepted and rejected lines together are all lines of the files.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankpulse import schemas

MOMENT_FORMAT = "yyyy-MM-dd HH:mm:ss"
#: A quote inside a quoted field is doubled.
QUOTING = {"quote": '"', "escape": '"'}
#: Why a line is rejected: another number of fields than its header, or a field not of its type.
WRONG_LENGTH, WRONG_TYPE = "WRONG_LENGTH", "WRONG_TYPE"
Paths = str | list[str]


def _headers(spark: SparkSession, paths: Paths) -> dict[tuple[str, ...], list[str]]:
    """Column names -> files that have them, in this order. One row per file reaches the driver,
    which holds the list of files anyway; lines are only looked at, not parsed."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    files = defaultdict(list)
    for row in first.collect():
        files[row.header].append(unquote(row.file))
    return files


def _parsed(spark: SparkSession, paths: Paths, separator: str, columns: list[str], line_breaks: bool) -> DataFrame:
    """The named columns as text, ``_file``, and ``_line``: the whole line if its length is wrong."""
    parts = []
    for header, files in sorted(_headers(spark, paths).items()):
        names = next(csv.reader([header.removeprefix("\ufeff")], delimiter=separator), [])
        if missing := [c for c in columns if c not in names]:
            raise ValueError(f"no column {missing} in the header of {files[0]}")
        schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))]).add("_line", "string")
        raw = (
            spark.read.schema(schema).options(**QUOTING).option("sep", separator).option("header", True)
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
            .option("columnPruning", False).option("multiLine", line_breaks).csv(files)
        )
        # always true; Spark refuses queries that ask for nothing but the corrupt line
        parts.append(raw.where(F.coalesce(F.length("_0"), F.lit(0)) >= 0).select(
            *[F.col(f"_{names.index(c)}").alias(c) for c in columns], F.col("_metadata.file_path").alias("_file"), "_line"
        ))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, "_file", "_line"]))
    return reduce(DataFrame.union, parts)


def read_crm_csv(spark: SparkSession, paths: Paths) -> DataFrame:
    """The CRM export: ';', header, all text, quoted fields may hold line breaks. Spark reads an
    empty field as NULL; cleaning tells 'empty' from 'unknown', so empty comes back as ''."""
    raw = _parsed(spark, paths, ";", schemas.STAGING_COLUMNS, True).where("_line is null")
    return raw.select(schemas.STAGING_COLUMNS).fillna("")


def rejected_crm_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """file, reason, line of the lines that ``read_crm_csv`` leaves out."""
    raw = _parsed(spark, paths, ";", schemas.STAGING_COLUMNS, True).where("_line is not null")
    return raw.select(F.col("_file").alias("file"), F.lit(WRONG_LENGTH).alias("reason"), F.col("_line").alias("line"))


def write_crm_csv(staging: DataFrame, path: str) -> None:
    (
        staging.select(schemas.STAGING_COLUMNS).write.mode("overwrite").options(**QUOTING)
        .option("sep", ";").option("header", True).option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _typed(spark: SparkSession, paths: Paths, schema: str, line_breaks: bool) -> tuple[DataFrame, list[T.StructField], Column]:
    declared = T.StructType.fromDDL(schema).fields
    names = [f.name for f in declared]
    wrong = [F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in declared]
    reason = F.when(F.col("_line").isNotNull(), WRONG_LENGTH).when(reduce(Column.__or__, wrong), WRONG_TYPE)
    return _parsed(spark, paths, ",", names, line_breaks), declared, reason


def read_typed_csv(spark: SparkSession, paths: Paths, schema: str, line_breaks: bool = False) -> DataFrame:
    """Comma-separated with a header; empty fields are NULL. Large files are read in pieces, so
    quoted line breaks have to be asked for."""
    raw, declared, reason = _typed(spark, paths, schema, line_breaks)
    return raw.where(reason.isNull()).select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in declared])


def rejected_lines(spark: SparkSession, paths: Paths, schema: str, line_breaks: bool = False) -> DataFrame:
    """file, reason, line of the lines that ``read_typed_csv`` leaves out; a line of the right
    length is put together again from the declared columns."""
    raw, declared, reason = _typed(spark, paths, schema, line_breaks)
    again = F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in declared]), QUOTING)
    return raw.withColumn("reason", reason).where("reason is not null").select(
        F.col("_file").alias("file"), "reason", F.coalesce("_line", again).alias("line")
    )


def write_typed_csv(frame: DataFrame, path: str) -> None:
    (
        frame.write.mode("overwrite").options(**QUOTING)
        .option("header", True).option("timestampNTZFormat", MOMENT_FORMAT).csv(path)
    )


def stamped(staging: DataFrame) -> DataFrame:
    """Staging lines carry the moment they were loaded."""
    return staging.withColumn("loaded_at", F.localtimestamp())
