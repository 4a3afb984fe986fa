"""The bank tables as a parquet layer, and the sinks of the analysis.

A run holds its tables, what its months add up to (``bankpulse.operators.states``), and which run
each month is read from: a delivery of some months writes these, and the rest stays where it is.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from datetime import date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.functions.dates import month_of
from bankpulse.operators.star import Star
from bankpulse.operators.states import ACCOUNT_MONTHS, MONEY_MONTHS, account_months, money_months
from bankpulse.params import timestamp
from bankpulse.sources.files import read_typed_csv, stamped, write_typed_csv
from bankpulse.tables import COUNTED, BankTables, Kept, counted_operations, counted_transactions

LOGS = ("operation_log", "transactions")
#: Log rows per bucket of the counts by operation, whose rows are a quarter as wide.
BUCKET_ROWS = 1 << 24
#: An operation with more than this share of a log is counted before its rows move.
FREQUENT = 0.002
_CODEC = "zstd"
_COUNTS = {
    "operation_counts": "operation_id bigint, status string, event_type string, amount_requested decimal(12,2), ops bigint",
    "transaction_counts": "operation_id bigint, txn_type string, amount decimal(12,2), txns bigint",
}
_SPAN = "first_at timestamp_ntz, last_at timestamp_ntz"
_MONTHS = f"month date, run string, {_SPAN}"

_PUBLISHED = "seq bigint, run string"


def published_runs(spark: SparkSession, folder: str) -> list[str]:
    """The runs that were published, the current one first."""
    try:
        rows = spark.read.schema(_PUBLISHED).parquet(f"{folder}/published").collect()  # a row per run
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [r.run for r in sorted(rows, key=lambda r: (r.seq, r.run), reverse=True)]


def publish(spark: SparkSession, folder: str, run: str) -> None:
    """Make a written run the one that readers see. The step is the appearance of one file, so
    there is no moment without a whole layer."""
    before = spark.read.schema(_PUBLISHED).parquet(f"{folder}/published") if published_runs(spark, folder) else None
    seq = 1 + (before.agg(F.max("seq")).first()[0] if before else 0)
    spark.createDataFrame([(seq, run)], _PUBLISHED).coalesce(1).write.mode("append").parquet(f"{folder}/published")


def retire(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Remove the tables of all but the latest runs, and of the runs that these take months from;
    readers of the one before can end."""
    runs = published_runs(spark, folder)
    needed = {row.run for run in runs[:keep] for row in _months(spark, folder, run)}
    for run in runs[keep:]:
        if run not in needed:
            for name in _COUNTS:
                spark.sql(f"DROP TABLE IF EXISTS {_table(run, name)}")
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{run}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _months(spark: SparkSession, folder: str, run: str) -> list[Row]:
    """The months of a run, which run each is read from, and its first and last moment."""
    return spark.read.schema(_MONTHS).parquet(f"{folder}/{run}/months").collect()  # a row per calendar month


def _in(months: list[date | None]) -> Column:
    listed = F.col("month").isin([m for m in months if m is not None])
    return listed | F.col("month").isNull() if None in months else listed


def _table(run: str, name: str) -> str:
    return f"{name}_{run.replace('-', '_')}"


def _absolute(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


class LayerTables(BankTables):
    """Reads the published run of a folder, or the given one. As-of reads skip whole month
    folders. The run is chosen once, so a reader sees one state throughout."""

    def __init__(self, spark: SparkSession, folder: str, run: str | None = None, months: list[Row] | None = None) -> None:
        super().__init__(spark)
        self.layer = folder.rstrip("/")
        if run is None:
            runs = published_runs(spark, self.layer)
            if not runs:
                raise FileNotFoundError(f"nothing is published in {folder}")
            run = runs[0]
        self.run, self.folder = run, f"{self.layer}/{run}"
        self.months = _months(spark, self.layer, run) if months is None else months

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def _by_month(self, name: str, schema: str, months: list[Row]) -> DataFrame:
        """Rows of the given months, each from the run that holds it. There are at most as many
        parts as deliveries since the last full load."""
        of_run = defaultdict(list)
        for row in months:
            of_run[row.run].append(row.month)
        schema = f"{schema}, month date"
        parts = [self.spark.read.schema(schema).parquet(f"{self.layer}/{run}/{name}").where(_in(of_run[run])) for run in sorted(of_run)]
        return reduce(DataFrame.union, parts) if parts else self.spark.createDataFrame([], schema)

    def _log(self, name: str, schema: str, until: datetime | None) -> DataFrame:
        log = self._by_month(name, schema, self.months)
        if until is not None:
            log = log.where((F.col("month") <= F.lit(until.date())) & (F.col("created_at") <= timestamp(until)))
        return log.drop("month")

    def kept(self, until: datetime, cut: datetime | None = None) -> Kept | None:
        """Months whose moments lie on one side of both bounds come from their sums, so at most
        two months are read from the logs."""

        def whole(row: Row) -> bool:
            return row.last_at <= until and (cut is None or row.first_at > cut or row.last_at <= cut)

        begun = [row for row in self.months if row.first_at is not None and row.first_at <= until]
        sums = [row for row in begun if whole(row)]
        return Kept(
            self._by_month("account_months", ACCOUNT_MONTHS, sums).withColumnRenamed("month", "month_start"),
            self._by_month("money_months", MONEY_MONTHS, sums).withColumnRenamed("month", "month_start"),
            LayerTables(self.spark, self.layer, self.run, [row for row in begun if not whole(row)]),
        )

    def _counts(self, name: str) -> DataFrame | None:
        """Counts in buckets by operation. Spark knows buckets of tables only, so the files are
        declared as one; None where the run has none."""
        try:
            buckets = self.spark.read.schema("buckets int").parquet(f"{self.folder}/buckets").first()[0]
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_table(self.run, name)} ({_COUNTS[name]}) USING parquet "
            f"CLUSTERED BY (operation_id) INTO {buckets} BUCKETS LOCATION '{_absolute(self.spark, f'{self.folder}/{name}')}'"
        )
        return self.spark.table(_table(self.run, name))

    def _kept_counts(self, name: str) -> DataFrame | None:
        return self.define(name, lambda: self._counts(name))

    def operation_counts(self) -> DataFrame:
        kept = self._kept_counts("operation_counts")
        return super().operation_counts() if kept is None else kept

    def transaction_counts(self) -> DataFrame:
        kept = self._kept_counts("transaction_counts")
        return super().transaction_counts() if kept is None else kept

    def operation_keys(self) -> DataFrame:
        kept = self._kept_counts("operation_counts")
        return super().operation_keys() if kept is None else kept.select("operation_id", "ops")

    def transaction_keys(self) -> DataFrame:
        kept = self._kept_counts("transaction_counts")
        return super().transaction_keys() if kept is None else kept.select("operation_id", "txns")

    def staging(self) -> DataFrame:
        return self._read("stg_customers_raw", schemas.STAGING)

    def customers(self) -> DataFrame:
        return self._read("customers", schemas.CUSTOMERS)

    def accounts(self) -> DataFrame:
        return self.accounts_with_balance().drop("balance")

    def accounts_with_balance(self) -> DataFrame:
        return self._read("accounts", schemas.ACCOUNTS)

    def operation_log(self, until: datetime | None = None) -> DataFrame:
        return self._log("operation_log", schemas.OPERATION_LOG, until)

    def transactions(self, until: datetime | None = None) -> DataFrame:
        return self._log("transactions", schemas.TRANSACTIONS, until)


def _counted(frame: DataFrame, name: str, write) -> tuple[str, int]:
    """Write and return the row count seen on the way, without reading back."""
    seen = Observation(name)
    write(frame.observe(seen, F.count(F.lit(1)).alias("rows")))
    return name, seen.get["rows"]


def _monthly(frame: DataFrame, path: str, *order: str | Column) -> None:
    """To month folders. Inside a month rows are range-partitioned, so files carry narrow ranges and
    a busy month or account is split over tasks."""
    frame.repartitionByRange("month", *order).write.option("compression", _CODEC).partitionBy("month").parquet(path)


def stage_layer(tables: BankTables, folder: str, onto: str | None = None) -> tuple[str, dict[str, int]]:
    """Write the tables in key order as a new run that no reader sees yet; its name and the rows
    per table. The two logs go to month folders by account and time; from there each is read
    once more for the sums of its months, and for the counts by operation once and its ids once.

    With ``onto``, an earlier run, the logs of ``tables`` hold some months, each of them whole: these
    replace the months of that run in both logs, and its other months are read from where they are
    (rows without a moment count as a month). Such a run has no counts by operation: its checks count the logs.
    """
    spark, folder = tables.spark, folder.rstrip("/")
    run = f"run-{uuid.uuid4().hex}"
    path = f"{folder}/{run}"

    def rows(frame: DataFrame, name: str) -> tuple[str, int]:
        return name, spark.read.schema(frame.schema).parquet(f"{path}/{name}").count()  # from the footers

    def plain(frame: DataFrame, name: str):
        frame.write.parquet(f"{path}/{name}")
        return rows(frame, name)

    def by_month(frame: DataFrame, name: str, account: str | Column):
        _monthly(frame.withColumn("month", month_of(F.col("created_at"))), f"{path}/{name}", account, "created_at", "operation_id")
        return rows(frame, name)

    holder = F.coalesce("from_account_id", "to_account_id")
    counts = dict([
        plain(stamped(tables.staging()), "stg_customers_raw"),
        plain(tables.categories(), "ref_merchant_categories"),
        plain(tables.customers(), "customers"),
        plain(tables.accounts_with_balance(), "accounts"),
        by_month(tables.operation_log(), "operation_log", "account_id"),
        by_month(tables.transactions(), "transactions", holder),
    ])
    log, transactions = (
        spark.read.schema(schema).parquet(f"{path}/{name}")
        for name, schema in zip(LOGS, (schemas.OPERATION_LOG, schemas.TRANSACTIONS), strict=True)
    )
    # in the tasks that made the sums, in order of months, which the pages of the files carry
    sums = account_months(log, transactions).sortWithinPartitions("month", "account_id")
    sums.write.option("compression", _CODEC).parquet(f"{path}/account_months")
    money_months(transactions).write.partitionBy("month").parquet(f"{path}/money_months")
    spans = [spark.read.schema(f"{_SPAN}, month date").parquet(f"{path}/{name}") for name in ("account_months", "money_months")]
    delivered = spans[0].union(spans[1]).groupBy("month").agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    months = delivered.select("month", F.lit(run).alias("run"), "first_at", "last_at")
    if onto is not None:
        before = spark.createDataFrame(_months(spark, folder, onto), _MONTHS)
        kept = before.join(months.select(F.col("month").alias("_new")), F.col("month").eqNullSafe(F.col("_new")), "left_anti")
        months = months.unionByName(kept)
    months.coalesce(1).write.parquet(f"{path}/months")
    if onto is None:
        _write_counts(LayerTables(spark, folder, run), max(counts[name] for name in LOGS))
    return run, counts


def _frequent(log: DataFrame) -> Column:
    """Whether a row has no operation, or one that may stand for more than ``FREQUENT`` of the rows:
    Spark's frequent items miss none, and are at most 1 / ``FREQUENT`` ids."""
    key = F.col("operation_id")
    items = log.select(key).where(key.isNotNull()).stat.freqItems(["operation_id"], FREQUENT).first()[0]
    return key.isNull() | key.isin(items) if items else key.isNull()


def _write_counts(tables: LayerTables, rows: int) -> None:
    """Both counts in the same buckets by operation, a file each, and one more for some. The rows move to
    their bucket once and are counted there; an id that is repeated, or missing, in a large part of a log
    is counted before, so that it is a few rows."""
    spark = tables.spark
    buckets = max(spark.sparkContext.defaultParallelism, math.ceil(rows / BUCKET_ROWS))
    for name, log, counted in (
        ("operation_counts", tables.operation_log(), counted_operations), ("transaction_counts", tables.transactions(), counted_transactions),
    ):
        narrow = log.select(*COUNTED[name])
        frequent = _frequent(log)
        spread = counted(narrow.where(~frequent).repartition(buckets, "operation_id"))
        few = counted(narrow.where(frequent))
        placed = spread.union(few).write.option("compression", _CODEC).bucketBy(buckets, "operation_id")
        placed.option("path", _absolute(spark, f"{tables.folder}/{name}")).format("parquet").saveAsTable(_table(tables.run, name))
    spark.range(1).select(F.lit(buckets).cast("int").alias("buckets")).coalesce(1).write.parquet(f"{tables.folder}/buckets")


def write_layer(tables: BankTables, folder: str, onto: str | None = None) -> dict[str, int]:
    """Write and publish at once; rows per table."""
    run, counts = stage_layer(tables, folder, onto)
    publish(tables.spark, folder, run)
    return counts


def write_star(star: Star, folder: str) -> dict[str, int]:
    """Every dimension and fact as CSV with a header; returns rows per table. All tables are
    made from the same written steps, so each log is read twice in all."""
    star = star.with_steps()
    return dict(
        _counted(getattr(star, name), name, lambda f, name=name: write_typed_csv(f, f"{folder}/{name}"))
        for name in schemas.STAR
    )


def read_star(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_typed_csv(spark, f"{folder}/{name}", schemas.STAR[name])


def write_csv(frame: DataFrame, folder: str, name: str) -> tuple[str, int]:
    return _counted(frame, name, lambda f: write_typed_csv(f, f"{folder}/{name}"))
