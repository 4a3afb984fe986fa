"""Month-level view on a dense month spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.activity import app_attempt, customer_activity, failed, is_event
from bankpulse.functions.bitsets import bit_of, word_of
from bankpulse.functions.dates import month_of
from bankpulse.functions.numbers import money, pct, sum_where
from bankpulse.operators.distinct import count_bits
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables, defined_once

AMOUNTS = {
    "deposits_amount": "DEPOSIT",
    "card_spend_amount": "CARD_PAYMENT",
    "transfers_amount": "TRANSFER",
    "withdrawals_amount": "WITHDRAWAL",
}
COUNTERS = [
    "new_accounts", "closed_accounts", "app_attempts", "app_failures", "card_payment_attempts", "declined_card_payments",
]


def month_spine(tables: BankTables, params: AnalysisParams) -> DataFrame:
    first, last = F.lit(params.first_month), F.lit(params.period_end.date())
    months = F.explode(F.sequence(first, last, F.expr("interval 1 month")))
    return tables.spark.range(1).select(months.alias("month_start"))


def month_counts() -> dict[str, Column]:
    """What is counted per month. Openings and closings count attempts whatever their status."""
    card = is_event("CARD_PAYMENT")
    conditions = [
        is_event("CREATE_ACCOUNT"), is_event("CLOSE_ACCOUNT"), app_attempt(), app_attempt() & failed(), card, card & failed(),
    ]
    return dict(zip(COUNTERS, conditions, strict=True))


def monthly_ops(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Active accounts are the bits of words of accounts, which carry the counts along: the log
    meets one exchange, of a row per task, month and 64 accounts. Whole months are added up
    from the sums kept per account, if there are any."""
    kept, account, counted = tables.kept(params.period_end), F.col("account_id"), month_counts()
    logged = (
        (kept.rest if kept else tables).operation_log(until=params.period_end)
        .groupBy(month_of(F.col("created_at")).alias("month_start"), word_of(account).alias("word"))
        .agg(
            F.bit_or(F.when(customer_activity(), bit_of(account))).alias("bits"),
            *[F.count_if(condition).alias(name) for name, condition in counted.items()],
        )
        .groupBy("month_start")
        .agg(count_bits().alias("active_accounts"), *[F.sum(name).alias(name) for name in counted])
    )
    if kept is None:
        return logged
    sums = kept.accounts.where("operations > 0").groupBy("month_start").agg(
        F.count_if(account.isNotNull() & (F.col("customer_operations") > 0)).alias("active_accounts"),
        *[F.sum(name).alias(name) for name in counted],
    )
    return logged.unionByName(sums)


def month_money(transactions: DataFrame, *more: Column) -> DataFrame:
    totals = [
        money(sum_where(F.col("txn_type") == txn_type, F.col("amount"))).alias(name) for name, txn_type in AMOUNTS.items()
    ]
    return transactions.groupBy(month_of(F.col("created_at")).alias("month_start")).agg(*totals, *more)


def monthly_money(tables: BankTables, params: AnalysisParams) -> DataFrame:
    kept = tables.kept(params.period_end)
    moved = month_money((kept.rest if kept else tables).transactions(until=params.period_end))
    return moved if kept is None else moved.unionByName(kept.money.select(moved.columns))


@defined_once
def v_monthly_kpis(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """All sides have at most one row per calendar month, hence the broadcasts."""
    joined = (
        month_spine(tables, params)
        .join(F.broadcast(monthly_ops(tables, params)), "month_start", "left")
        .join(F.broadcast(monthly_money(tables, params)), "month_start", "left")
    )

    def count(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return joined.select(
        "month_start",
        *[count(name) for name in ("new_accounts", "closed_accounts", "active_accounts")],
        *[money(F.col(name)).alias(name) for name in AMOUNTS],
        count("card_payment_attempts"),
        pct(F.col("app_failures"), F.col("app_attempts"), 2).alias("app_failure_rate_pct"),
        pct(F.col("declined_card_payments"), F.col("card_payment_attempts"), 2).alias("card_decline_rate_pct"),
    )
