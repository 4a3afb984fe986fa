"""The named business questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bankpulse.functions.activity import customer_activity, failed, is_event
from bankpulse.functions.bitsets import bit_of, members, word_of
from bankpulse.functions.dates import month_number
from bankpulse.functions.numbers import (
    MONEY, cents, grand_total, money, money_mean, money_pct, pct, rounded_ratio, sum_where,
)
from bankpulse.operators.activity import account_measures, account_profile, v_account_activity
from bankpulse.operators.monthly import v_monthly_kpis
from bankpulse.operators.ordering import written
from bankpulse.operators.selection import group_ends, passed, rows_at
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables

ELIGIBLE_DAYS = 30
WATCH_DAYS = 45


def _status(name: str) -> Column:
    return F.col("lifecycle_status") == name


def _funded_within(days: int) -> Column:
    return F.coalesce(F.col("days_to_first_deposit") <= days, F.lit(False))


def _eligible(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Accounts old enough for their activation to be judged."""
    return v_account_activity(tables, params).where(F.col("opened_at") <= params.end_minus(ELIGIBLE_DAYS))


def _mean_where(condition: Column, amount: str, scale: int) -> Column:
    return money_mean(F.sum(F.when(condition, F.col(amount))), F.count(F.when(condition, F.col(amount))), scale)


def global_kpis(tables: BankTables, params: AnalysisParams) -> DataFrame:
    active = _status("ACTIVE")
    return v_account_activity(tables, params).agg(
        F.countDistinct("customer_id").alias("customers"),
        F.count("*").alias("accounts"),
        F.count_if(active).alias("active_accounts"),
        F.count_if(_status("DORMANT")).alias("dormant_accounts"),
        F.count_if(_status("NEVER_FUNDED")).alias("never_funded_accounts"),
        F.count_if(_status("CLOSED")).alias("closed_accounts"),
        pct(F.count_if(active), F.count("*")).alias("active_rate_pct"),
        F.sum("balance_at_period_end").cast(MONEY).alias("total_balances"),
        money(sum_where(_status("DORMANT"), F.col("balance_at_period_end"))).alias("dormant_balances"),
        F.sum("total_deposits").cast(MONEY).alias("total_deposits"),
        F.sum("card_spend").cast(MONEY).alias("total_card_spend"),
        _mean_where(active, "balance_at_period_end", 2).alias("avg_balance_active_account"),
    )


def monthly_trend(tables: BankTables, params: AnalysisParams) -> DataFrame:
    by_month = W.orderBy("month_start")  # one row per calendar month
    active = F.col("active_accounts")
    previous = F.lag("active_accounts").over(by_month)
    return v_monthly_kpis(tables, params).select(
        "month_start",
        "new_accounts",
        F.sum("new_accounts").over(by_month).alias("cumulative_accounts"),
        "active_accounts",
        pct(active - previous, previous).alias("active_accounts_mom_pct"),
        "closed_accounts",
        "deposits_amount",
        "card_spend_amount",
        money_mean(F.col("card_spend_amount"), active).alias("card_spend_per_active_account"),
        "app_failure_rate_pct",
        "card_decline_rate_pct",
    ).orderBy("month_start")


def activation_by_channel(tables: BankTables, params: AnalysisParams) -> DataFrame:
    total = F.count("*")
    return (
        _eligible(tables, params)
        .groupBy("signup_channel")
        .agg(
            total.alias("accounts"),
            F.count("first_deposit_at").alias("funded_accounts"),
            pct(F.count_if(_funded_within(7)), total).alias("funded_within_7_days_pct"),
            pct(F.count_if(_funded_within(30)), total).alias("funded_within_30_days_pct"),
            rounded_ratio(F.sum("days_to_first_deposit"), F.count("days_to_first_deposit"), 1)
            .alias("avg_days_to_first_deposit"),
            pct(F.count_if(_status("ACTIVE")), total).alias("active_rate_pct"),
            pct(F.count_if(_status("NEVER_FUNDED")), total).alias("never_funded_pct"),
        )
        .orderBy(F.desc("active_rate_pct"), "signup_channel")
    )


def activation_detail(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return _eligible(tables, params).select(
        "account_id", "signup_channel", "days_to_first_deposit",
        _funded_within(30).alias("funded_within_30_days"), "lifecycle_status",
    )


def lifecycle_by_age_band(tables: BankTables, params: AnalysisParams) -> DataFrame:
    total = F.count("*")
    shares = {
        "active_pct": "ACTIVE", "dormant_pct": "DORMANT",
        "never_funded_pct": "NEVER_FUNDED", "closed_pct": "CLOSED",
    }
    return (
        v_account_activity(tables, params)
        .groupBy("age_band")
        .agg(
            total.alias("accounts"),
            *[pct(F.count_if(_status(code)), total).alias(name) for name, code in shares.items()],
            _mean_where(_status("ACTIVE"), "balance_at_period_end", 0).alias("avg_balance_active"),
            _mean_where(F.col("first_deposit_at").isNotNull(), "card_spend", 0).alias("avg_card_spend_funded"),
        )
        .orderBy("age_band")
    )


def activity_months(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """The months with customer activity of each account, as words of months."""
    active = tables.operation_log(until=params.period_end).where(customer_activity() & F.col("account_id").isNotNull())
    return month_words(active, F.col("created_at"))


def month_words(rows: DataFrame, day: Column) -> DataFrame:
    """One row per account and 64 months, so one partial row per account and task is shuffled
    for a log of up to five years, however many months and operations it has."""
    month = month_number(day)
    return rows.groupBy("account_id", word_of(month).alias("word")).agg(F.bit_or(bit_of(month)).alias("bits"))


def cohort_cells(tables: BankTables, params: AnalysisParams, *by: str, months: DataFrame | None = None) -> DataFrame:
    """Active accounts per cohort key and month since opening, with the cohort size.

    Only the account profile is read next to the log, or next to ``months`` (words) if these are known.
    Words become months after the join, where they are counted at once. Cohort sizes have one row
    per calendar month (and channel), so they are safe to broadcast.
    """
    profile = account_profile(tables, params).select("account_id", *by)
    sizes = profile.groupBy(*by).agg(F.count("*").alias("cohort_size"))
    elapsed = (F.col("month") - month_number(F.col("cohort_month"))).cast("int")
    return (
        profile.join(activity_months(tables, params) if months is None else months, "account_id")
        .select(*by, F.explode(members(F.col("word"), F.col("bits"))).alias("month"))
        .groupBy(*by, elapsed.alias("months_since_opening"))
        .agg(F.count("*").alias("active_accounts"))
        .join(F.broadcast(sizes), list(by))
    )


def cohort_retention(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return (
        cohort_cells(tables, params, "cohort_month")
        .select(
            "cohort_month", "cohort_size", "months_since_opening", "active_accounts",
            pct(F.col("active_accounts"), F.col("cohort_size")).alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since_opening")
    )


def balance_concentration(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Ten equal groups of open accounts by falling balance, ties by account. The last account of
    each group is selected by rank; no row is sorted."""
    open_accounts = written(
        v_account_activity(tables, params).where(~_status("CLOSED"))
        .select("account_id", F.col("balance_at_period_end").alias("balance"))
    )
    falling, account = -cents(F.col("balance")).cast("bigint"), F.col("account_id")
    ends = rows_at(open_accounts, [falling], account, {0: lambda n: {str(i): end for i, end in enumerate(group_ends(n, 10))}})
    decile = sum([passed(falling, account, end).cast("int") for end in ends.values()], F.lit(1))
    deciles = open_accounts.groupBy(decile.alias("balance_decile")).agg(
        F.count("*").alias("accounts"),
        F.min("balance").cast(MONEY).alias("min_balance"),
        F.sum("balance").cast(MONEY).alias("total_balance"),
    )
    running = F.sum("total_balance").over(W.orderBy("balance_decile"))
    total = grand_total("total_balance")
    return deciles.select(
        "*",
        money_pct(F.col("total_balance"), total).alias("share_pct"),
        money_pct(running, total).alias("cumulative_share_pct"),
    ).orderBy("balance_decile")


def card_spend_by_category(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Payments are summed per category code before the nine labels are looked up."""
    per_code = (
        tables.transactions(until=params.period_end)
        .where(F.col("txn_type") == "CARD_PAYMENT")
        .groupBy(F.col("merchant_category").alias("category_code"))
        .agg(F.count("*").alias("payments"), F.sum("amount").cast(MONEY).alias("total_spend"))
    )
    total = F.col("total_spend")
    return (
        per_code.join(F.broadcast(tables.categories()), "category_code")
        .select(
            F.col("label_fr").alias("category"), "is_essential", "payments", "total_spend",
            money_mean(total, F.col("payments")).alias("avg_ticket"),
            money_pct(total, grand_total("total_spend")).alias("spend_share_pct"),
            F.rank().over(W.orderBy(total.desc())).alias("spend_rank"),
        )
        .orderBy("spend_rank", "category")
    )


def failures_by_reason(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """One pass: outcomes per event, then attempts as a sum over each event's few rows."""
    outcomes = (
        tables.operation_log(until=params.period_end)
        .groupBy("event_type", "status", "failure_reason")
        .agg(F.count("*").alias("failures"), F.sum("amount_requested").cast(MONEY).alias("amount_refused"))
        .withColumn("attempts", F.sum("failures").over(W.partitionBy("event_type")))
        .where(failed())
    )
    every_failure = grand_total("failures")
    return outcomes.select(
        "event_type", "failure_reason", "failures", "attempts",
        pct(F.col("failures"), F.col("attempts"), 2).alias("failure_rate_pct"),
        pct(F.col("failures"), every_failure).alias("share_of_all_failures_pct"),
        "amount_refused",
    ).orderBy(F.desc("failures"), "event_type", "failure_reason")


def card_number_errors(tables: BankTables, params: AnalysisParams) -> DataFrame:
    caught = F.count_if(F.col("failure_reason") == "INVALID_CARD_NUMBER")
    return (
        tables.operation_log(until=params.period_end)
        .where(is_event("LOGIN", "TRANSFER") & F.col("failure_reason").isin("INVALID_CARD_NUMBER", "UNKNOWN_CARD"))
        .groupBy("event_type")
        .agg(
            caught.alias("stopped_by_luhn_check"),
            F.count_if(F.col("failure_reason") == "UNKNOWN_CARD").alias("reached_database_lookup"),
            F.count("*").alias("card_number_errors"),
            pct(caught, F.count("*")).alias("luhn_interception_pct"),
        )
    )


def declined_payments_concentration(tables: BankTables, params: AnalysisParams) -> DataFrame:
    declines = F.col("declined_card_payments")
    band = (
        F.when(declines == 0, "0 refus").when(declines <= 2, "1 à 2 refus")
        .when(declines <= 9, "3 à 9 refus").otherwise("10 refus ou plus")
    )
    bands = (
        v_account_activity(tables, params)
        .where(F.col("card_payments") + declines > 0)
        .groupBy(band.alias("declines_band"))
        .agg(
            F.count("*").alias("accounts"),
            F.sum(declines).alias("declined_payments"),
            F.min(declines).alias("fewest"),
        )
    )
    return (
        bands.select(
            "declines_band", "accounts",
            pct(F.col("accounts"), grand_total("accounts")).alias("accounts_pct"),
            "declined_payments",
            pct(F.col("declined_payments"), grand_total("declined_payments")).alias("declines_pct"),
            "fewest",
        )
        .orderBy("fewest")
        .drop("fewest")
    )


def dormancy_watchlist(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return (
        v_account_activity(tables, params)
        .where(_status("ACTIVE") & (F.col("days_since_last_activity") >= WATCH_DAYS))
        .select(
            "account_id", "customer_id", "signup_channel", "age_band", "last_activity_at",
            "days_since_last_activity", "balance_at_period_end", "card_payments",
        )
        .orderBy(F.desc("balance_at_period_end"), "account_id")
    )


def rfm_base(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Recency, frequency and spend of funded open accounts, from one pass over the logs."""
    return funded_open(account_measures(tables, params))


def funded_open(measures: DataFrame) -> DataFrame:
    return measures.where(F.col("lifecycle_status").isin("ACTIVE", "DORMANT")).select(
        "account_id", "signup_channel", "age_band", "lifecycle_status",
        F.col("days_since_last_activity").alias("recency_days"),
        "frequency_180d", "card_spend_180d", "balance_at_period_end",
    )
