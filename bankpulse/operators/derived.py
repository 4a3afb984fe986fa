"""Figures the analysis derives from the named questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.numbers import MONEY, grand_total, money_pct, pct, rounded_ratio
from bankpulse.functions.text import labelled
from bankpulse.operators import business
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables
from bankpulse.vocabulary import EVENT_LABELS, REASON_LABELS

STATUS_COUNTS = {
    "ACTIVE": "active_accounts", "DORMANT": "dormant_accounts",
    "NEVER_FUNDED": "never_funded_accounts", "CLOSED": "closed_accounts",
}
RETENTION_MONTHS = [1, 3, 6, 12]


def status_shares(tables: BankTables, params: AnalysisParams) -> DataFrame:
    pairs = [
        F.struct(F.lit(code).alias("lifecycle_status"), F.col(name).alias("accounts"))
        for code, name in STATUS_COUNTS.items()
    ]
    rows = business.global_kpis(tables, params).select(F.inline(F.array(*pairs)))
    return rows.withColumn("share_pct", pct(F.col("accounts"), grand_total("accounts")))


def peak_month(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Month with most openings, the earliest on a tie."""
    trend = business.v_monthly_kpis(tables, params).select("month_start", "new_accounts")
    return trend.orderBy(F.desc("new_accounts"), "month_start").limit(1)


def last_month(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return business.monthly_trend(tables, params).orderBy(F.desc("month_start")).limit(1)


def activation_crosstab(tables: BankTables, params: AnalysisParams) -> DataFrame:
    counts = (
        business.activation_detail(tables, params)
        .groupBy("signup_channel").pivot("funded_within_30_days", [False, True]).agg(F.count("account_id"))
    )
    return counts.select(
        "signup_channel",
        F.coalesce(F.col("false"), F.lit(0)).alias("not_funded"),
        F.coalesce(F.col("true"), F.lit(0)).alias("funded"),
    )


def _last_elapsed(params: AnalysisParams) -> int:
    start, end = params.period_start, params.period_end
    return (end.year - start.year) * 12 + end.month - start.month


def _listed(month: Column, value: Column, inside: Column) -> Column:
    """The cells as 'month:value' in month order; a row has one per month of the data at most."""
    cells = F.sort_array(F.collect_list(F.when(inside, F.struct(month.alias("m"), value.alias("v")))))
    texts = F.transform(cells, lambda c: F.concat_ws(":", c.m.cast("string"), c.v.cast("string")))
    return F.nullif(F.array_join(texts, " "), F.lit(""))


def matrix_columns(params: AnalysisParams, month: Column, value: Column) -> list[Column]:
    """One column per month of the period, so no pass is spent on discovering them; cells of
    other months are listed in ``before_opening`` and ``after_period``."""
    last = _last_elapsed(params)
    return [
        *[F.max(F.when(month == m, value)).alias(f"m{m:02d}") for m in range(last + 1)],
        _listed(month, value, month < 0).alias("before_opening"),
        _listed(month, value, month > last).alias("after_period"),
    ]


def retention_matrix(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Cohort by month since opening; empty cells stay NULL."""
    rate = pct(F.col("active_accounts"), F.col("cohort_size"))
    return (
        business.cohort_cells(tables, params, "cohort_month")
        .groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort"))
        .agg(*matrix_columns(params, F.col("months_since_opening"), rate))
        .orderBy("cohort")
    )


def retention_mean(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Plain mean over cohorts of their rounded retention rate."""
    rates = business.cohort_retention(tables, params).where(F.col("months_since_opening").isin(RETENTION_MONTHS))
    tenths = (F.col("retention_pct") * 10).cast("bigint")
    return rates.groupBy("months_since_opening").agg(
        F.count("*").alias("cohorts"),
        rounded_ratio(F.sum(tenths), F.count("*") * 10, 2).alias("mean_retention_pct"),
    )


def concentration_curve(tables: BankTables, params: AnalysisParams) -> DataFrame:
    deciles = business.balance_concentration(tables, params).select(
        (F.col("balance_decile") * 10).cast("int").alias("accounts_pct"),
        F.col("cumulative_share_pct").alias("balance_pct"),
    )
    origin = tables.spark.range(1).select(
        F.lit(0).alias("accounts_pct"), F.lit(0).cast("decimal(18,1)").alias("balance_pct")
    )
    return origin.unionByName(deciles)


def top_failures(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """The six most frequent failures, with labels."""
    label = F.concat(
        labelled(F.col("event_type"), EVENT_LABELS), F.lit(" : "), labelled(F.col("failure_reason"), REASON_LABELS)
    )
    return (
        business.failures_by_reason(tables, params)
        .orderBy(F.desc("failures"), "event_type", "failure_reason")
        .limit(6)
        .select(label.alias("label"), "failures", "failure_rate_pct")
    )


def watchlist_summary(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return business.dormancy_watchlist(tables, params).agg(
        F.count("*").alias("accounts"),
        F.coalesce(F.sum("balance_at_period_end"), F.lit(0)).cast(MONEY).alias("balance"),
    )


def watchlist_top10(tables: BankTables, params: AnalysisParams) -> DataFrame:
    watchlist = business.dormancy_watchlist(tables, params)
    return watchlist.orderBy(F.desc("balance_at_period_end"), "account_id").limit(10)


def essential_share(tables: BankTables, params: AnalysisParams) -> DataFrame:
    split = business.card_spend_by_category(tables, params).groupBy("is_essential").agg(
        F.sum("total_spend").cast(MONEY).alias("total_spend")
    )
    share = money_pct(F.col("total_spend"), grand_total("total_spend"))
    return split.withColumn("share_pct", share)
