"""Account-level view: profile, activation, activity, money flows and lifecycle status."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.activity import customer_activity, failed, is_event, succeeded
from bankpulse.functions.dates import complete_days, complete_years, month_of
from bankpulse.functions.numbers import MONEY, money, one_if
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables, Kept, defined_once
from bankpulse.vocabulary import UNKNOWN_AGE

RECENT_DAYS = 180

COUNTERS = ["logins", "card_payments", "declined_card_payments", "failed_operations"]
AMOUNTS = ["total_deposits", "transfers_received", "transfers_sent", "card_spend", "withdrawals"]
VIEW_COLUMNS = [
    "account_id", "customer_id", "signup_channel", "city", "age_at_opening", "age_band", "opened_at",
    "cohort_month", "closed_at", "first_deposit_at", "days_to_first_deposit", "last_activity_at",
    "days_since_last_activity", *COUNTERS, *AMOUNTS, "balance_at_period_end", "lifecycle_status",
]


def movements(transactions: DataFrame) -> DataFrame:
    """Every transaction as up to two signed legs, from a single scan."""
    nothing = F.lit(0).cast("decimal(12,2)")
    legs = F.array(
        F.struct(
            F.col("to_account_id").alias("account_id"), F.col("amount").alias("amount_in"), nothing.alias("amount_out")
        ),
        F.struct(
            F.col("from_account_id").alias("account_id"), nothing.alias("amount_in"), F.col("amount").alias("amount_out")
        ),
    )
    return (
        transactions.select("operation_id", "txn_type", "created_at", F.inline(legs))
        .where(F.col("account_id").isNotNull())
        .select("account_id", "txn_type", "amount_in", "amount_out", "created_at", "operation_id")
    )


def operation_adds(log: DataFrame, **more: Column) -> DataFrame:
    """Per log row, what it adds to its account."""
    at, card, active = F.col("created_at"), is_event("CARD_PAYMENT"), customer_activity()
    return log.select(
        "account_id",
        "created_at",
        F.when(is_event("DEPOSIT") & succeeded(), at).alias("first_deposit_at"),
        F.when(active, at).alias("last_activity_at"),
        one_if(is_event("LOGIN") & succeeded()).alias("logins"),
        one_if(card & succeeded()).alias("card_payments"),
        one_if(card & failed()).alias("declined_card_payments"),
        one_if(failed()).alias("failed_operations"),
        one_if(active).alias("customer_operations"),
        *[value.alias(name) for name, value in more.items()],
    )


def money_adds(transactions: DataFrame) -> DataFrame:
    """Per movement leg, what it adds to its account."""

    def only(txn_type: str, amount: str) -> Column:
        return F.when(F.col("txn_type") == txn_type, F.col(amount))

    return movements(transactions).select(
        "account_id",
        "created_at",
        only("DEPOSIT", "amount_in").alias("total_deposits"),
        only("TRANSFER", "amount_in").alias("transfers_received"),
        only("TRANSFER", "amount_out").alias("transfers_sent"),
        only("CARD_PAYMENT", "amount_out").alias("card_spend"),
        only("WITHDRAWAL", "amount_out").alias("withdrawals"),
        (F.col("amount_in") - F.col("amount_out")).alias("balance_at_period_end"),
    )


def _kept(tables: BankTables, params: AnalysisParams) -> Kept | None:
    return tables.kept(params.period_end, params.period_end - timedelta(days=RECENT_DAYS))


def _with_kept(rows: DataFrame, kept: Kept | None, count: str) -> DataFrame:
    """The rows, and the kept sums of other months. A kept month lies on one side of the bound
    of recent rows, so its first moment stands for all."""
    if kept is None:
        return rows
    sums = kept.accounts.where(F.col(count) > 0).withColumnRenamed("first_at", "created_at")
    return rows.unionByName(sums.select(rows.columns))


def _operation_facts(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """What log rows, or the kept sums of whole months, add to their account."""
    kept = _kept(tables, params)
    log = (kept.rest if kept else tables).operation_log(until=params.period_end)
    rows = _with_kept(operation_adds(log), kept, "operations").where(F.col("account_id").isNotNull())
    recent = F.col("created_at") > params.end_minus(RECENT_DAYS)
    return rows.select(
        "account_id", "first_deposit_at", "last_activity_at", *COUNTERS,
        F.when(recent, F.col("customer_operations")).otherwise(0).alias("frequency_180d"),
    )


def _money_facts(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """What movement legs, or the kept sums of whole months, add to their account."""
    kept = _kept(tables, params)
    transactions = (kept.rest if kept else tables).transactions(until=params.period_end)
    rows = _with_kept(money_adds(transactions), kept, "legs")
    recent = F.col("created_at") > params.end_minus(RECENT_DAYS)
    return rows.select("account_id", *AMOUNTS, "balance_at_period_end", F.when(recent, F.col("card_spend")).alias("card_spend_180d"))


def _operation_totals() -> list[Column]:
    sums = [F.sum(name).cast("bigint").alias(name) for name in [*COUNTERS, "frequency_180d"]]
    return [
        F.min("first_deposit_at").alias("first_deposit_at"),
        F.max("last_activity_at").alias("last_activity_at"),
        *sums,
    ]


def _money_totals() -> list[Column]:
    names = [*AMOUNTS, "balance_at_period_end", "card_spend_180d"]
    return [F.sum(name).cast(MONEY).alias(name) for name in names]


def account_ops(tables: BankTables, params: AnalysisParams) -> DataFrame:
    totals = _operation_facts(tables, params).groupBy("account_id").agg(*_operation_totals())
    return totals.drop("frequency_180d")


def account_movements(tables: BankTables, params: AnalysisParams) -> DataFrame:
    legs = movements(tables.transactions(until=params.period_end))
    return legs.select("account_id", "txn_type", "amount_in", "amount_out")


def account_money(tables: BankTables, params: AnalysisParams) -> DataFrame:
    totals = _money_facts(tables, params).groupBy("account_id").agg(*_money_totals())
    filled = [money(F.col(name)).alias(name) for name in [*AMOUNTS, "balance_at_period_end"]]
    return totals.select("account_id", *filled)


@defined_once
def account_profile(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Accounts opened by the period end, with their holder; reads no log."""
    holders = tables.customers().select("customer_id", "signup_channel", "city", "birth_date")
    age = complete_years(F.col("birth_date"), F.col("opened_at"))
    return (
        tables.accounts()
        .where(F.col("opened_at") <= params.end)
        .join(holders, "customer_id")
        .select(
            "account_id", "customer_id", "signup_channel", "city",
            age.cast("bigint").alias("age_at_opening"),
            _age_band(age).alias("age_band"),
            "opened_at",
            month_of(F.col("opened_at")).alias("cohort_month"),
            F.when(F.col("closed_at") <= params.end, F.col("closed_at")).alias("closed_at"),
        )
    )


def _age_band(age: Column) -> Column:
    return (
        F.when(age.isNull(), UNKNOWN_AGE).when(age < 25, "18-24").when(age < 35, "25-34")
        .when(age < 45, "35-44").when(age < 55, "45-54").otherwise("55+")
    )


@defined_once
def account_measures(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Profile plus every log-derived measure.

    Both logs are projected to the same shape and summed by one grouping, so they
    share one exchange and are reduced before it; a hot account shuffles one partial
    row per task.
    """
    facts = _operation_facts(tables, params).unionByName(_money_facts(tables, params), allowMissingColumns=True)
    totals = facts.groupBy("account_id").agg(*_operation_totals(), *_money_totals())
    counts = [F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name) for name in [*COUNTERS, "frequency_180d"]]
    amounts = [money(F.col(name)).alias(name) for name in [*AMOUNTS, "balance_at_period_end", "card_spend_180d"]]
    profile = account_profile(tables, params)
    return profile.join(totals, "account_id", "left").select(
        *profile.columns,
        "first_deposit_at",
        complete_days(F.col("opened_at"), F.col("first_deposit_at")).cast("bigint").alias("days_to_first_deposit"),
        "last_activity_at",
        complete_days(F.col("last_activity_at"), params.end).cast("bigint").alias("days_since_last_activity"),
        *counts,
        *amounts,
        _lifecycle(params).alias("lifecycle_status"),
    )


def _lifecycle(params: AnalysisParams) -> Column:
    """First match wins; an account funded but never active is dormant."""
    return (
        F.when(F.col("closed_at") <= params.end, "CLOSED")
        .when(F.col("first_deposit_at").isNull(), "NEVER_FUNDED")
        .when(F.col("last_activity_at") >= params.end_minus(params.dormancy_days), "ACTIVE")
        .otherwise("DORMANT")
    )


def v_account_activity(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return account_measures(tables, params).select(*VIEW_COLUMNS)


def age_band(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return account_profile(tables, params).select("account_id", "age_at_opening", "age_band")


def cohort_month(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return account_profile(tables, params).select("account_id", "cohort_month")


def account_delays(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return account_measures(tables, params).select("account_id", "days_to_first_deposit", "days_since_last_activity")


def lifecycle_status(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return account_measures(tables, params).select("account_id", "lifecycle_status")
