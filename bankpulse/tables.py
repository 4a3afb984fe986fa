"""Lazy access to the bank tables an operator reads."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Hashable
from dataclasses import dataclass
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.params import timestamp
from bankpulse.vocabulary import CATEGORIES


@dataclass(frozen=True)
class Kept:
    """Sums kept per account and month, and per month (``bankpulse.operators.states``), of the months
    that no bound of a reading cuts; ``rest`` has the log rows of the months that one cuts."""

    accounts: DataFrame
    money: DataFrame
    rest: BankTables


class BankTables(ABC):
    """Each method returns a fresh, unexecuted DataFrame.

    ``until`` asks for rows with ``created_at <= until``; implementations turn it
    into whatever their files can skip on.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._definitions: dict[Hashable, DataFrame] = {}

    def define(self, key: Hashable, build: Callable[[], DataFrame]) -> DataFrame:
        """Build a DataFrame definition once; like a view, it holds a plan and no data."""
        if key not in self._definitions:
            self._definitions[key] = build()
        return self._definitions[key]

    @abstractmethod
    def staging(self) -> DataFrame: ...

    @abstractmethod
    def accounts(self) -> DataFrame:
        """All account columns except ``balance``."""

    @abstractmethod
    def accounts_with_balance(self) -> DataFrame: ...

    @abstractmethod
    def operation_log(self, until: datetime | None = None) -> DataFrame: ...

    @abstractmethod
    def transactions(self, until: datetime | None = None) -> DataFrame: ...

    def kept(self, until: datetime, cut: datetime | None = None) -> Kept | None:
        """Kept sums for a reading up to ``until`` that tells rows after ``cut`` from those before;
        None where nothing is kept, and the logs are to be read."""
        return None

    def operation_keys(self) -> DataFrame:
        """``operation_id``, and ``ops``: how many logged operations a row stands for."""
        return self.operation_log().select("operation_id", F.lit(1).cast("bigint").alias("ops"))

    def transaction_keys(self) -> DataFrame:
        """``operation_id``, and ``txns``: how many transactions a row stands for."""
        return self.transactions().select("operation_id", F.lit(1).cast("bigint").alias("txns"))

    def operation_counts(self) -> DataFrame:
        """Logged operations counted by id and by what is compared with their transaction: one row
        per id and value set, however often an id is repeated."""
        return counted_operations(self.operation_log())

    def transaction_counts(self) -> DataFrame:
        return counted_transactions(self.transactions())

    def customers(self) -> DataFrame:
        from bankpulse.operators.cleaning import customers_clean

        return self.define("customers", lambda: customers_clean(self.staging()))

    def categories(self) -> DataFrame:
        return self.spark.createDataFrame(CATEGORIES, schemas.CATEGORIES)


#: What the counts by operation tell apart, the operation first.
COUNTED = {
    "operation_counts": ("operation_id", "status", "event_type", "amount_requested"),
    "transaction_counts": ("operation_id", "txn_type", "amount"),
}


def counted_operations(log: DataFrame) -> DataFrame:
    return log.groupBy(*COUNTED["operation_counts"]).agg(F.count("*").alias("ops"))


def counted_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(*COUNTED["transaction_counts"]).agg(F.count("*").alias("txns"))


def defined_once(job):
    """For jobs of (tables, params) that many others build on."""

    @wraps(job)
    def definition(tables: BankTables, params) -> DataFrame:
        return tables.define((job.__name__, params), lambda: job(tables, params))

    return definition


class FrameTables(BankTables):
    """Bank tables given as ready DataFrames (tests, notebooks, other catalogs)."""

    def __init__(self, spark: SparkSession, **frames: DataFrame) -> None:
        super().__init__(spark)
        self._frames = frames

    def staging(self) -> DataFrame:
        return self._frames["staging"]

    def customers(self) -> DataFrame:
        return self._frames["customers"] if "customers" in self._frames else super().customers()

    def accounts(self) -> DataFrame:
        return self._frames["accounts"].drop("balance")

    def accounts_with_balance(self) -> DataFrame:
        return self._frames["accounts"]

    def operation_log(self, until: datetime | None = None) -> DataFrame:
        return _up_to(self._frames["operation_log"], until)

    def transactions(self, until: datetime | None = None) -> DataFrame:
        return _up_to(self._frames["transactions"], until)


def _up_to(log: DataFrame, until: datetime | None) -> DataFrame:
    return log if until is None else log.where(F.col("created_at") <= timestamp(until))
