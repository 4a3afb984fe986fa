"""The logs added up per account and month, to be kept.

The sums of a month hold until the month is delivered again, so a delivery writes those of its
own months, and a reading adds up what is kept: rows per account and month in place of log rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.dates import month_of
from bankpulse.functions.numbers import MONEY, one_if
from bankpulse.operators import activity, monthly

_COUNTERS = [*activity.COUNTERS, "customer_operations", *[n for n in monthly.COUNTERS if n not in activity.COUNTERS]]
_SUMS = [*activity.AMOUNTS, "balance_at_period_end"]
ACCOUNT_MONTHS = (
    "account_id bigint, operations bigint, legs bigint, first_at timestamp_ntz, last_at timestamp_ntz, "
    "first_deposit_at timestamp_ntz, last_activity_at timestamp_ntz, "
    + ", ".join(f"{name} bigint" for name in _COUNTERS) + ", " + ", ".join(f"{name} {MONEY}" for name in _SUMS)
)
MONEY_MONTHS = "first_at timestamp_ntz, last_at timestamp_ntz, " + ", ".join(f"{name} {MONEY}" for name in monthly.AMOUNTS)


def _span() -> list[Column]:
    return [F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at")]


def account_months(log: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per account and ``month`` with an operation or a movement; operations without an
    account are a row of the null account, rows without a moment are of the null month. Both
    logs are read once and share one exchange, of a row per account, month and task."""
    counts = {name: one_if(what) for name, what in monthly.month_counts().items() if name not in activity.COUNTERS}
    one = F.lit(1).cast("bigint")
    operations = activity.operation_adds(log, operations=one, **counts)
    legs = activity.money_adds(transactions).withColumn("legs", one)
    rows = operations.unionByName(legs, allowMissingColumns=True).withColumn("month", month_of(F.col("created_at")))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
    return rows.groupBy("account_id", "month").agg(
        total("operations"), total("legs"), *_span(),
        F.min("first_deposit_at").alias("first_deposit_at"), F.max("last_activity_at").alias("last_activity_at"),
        *[total(name) for name in _COUNTERS], *[F.sum(name).cast(MONEY).alias(name) for name in _SUMS],
    )


def money_months(transactions: DataFrame) -> DataFrame:
    """One row per ``month`` with a transaction."""
    return monthly.month_money(transactions, *_span()).withColumnRenamed("month_start", "month")
