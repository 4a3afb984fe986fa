"""Recency / frequency / monetary scoring and segments."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.numbers import MONEY, cents, grand_total, money_mean, money_pct, pct, rounded_ratio
from bankpulse.operators.business import rfm_base
from bankpulse.operators.ordering import written
from bankpulse.operators.selection import passed, rows_at
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables
from bankpulse.vocabulary import SEGMENTS

def recency_score() -> Column:
    """Business thresholds; an account that was never active scores lowest."""
    days = F.col("recency_days")
    return (
        F.when(days <= 7, 5).when(days <= 30, 4).when(days <= 60, 3).when(days <= 90, 2).otherwise(1)
    )


@dataclass(frozen=True)
class Cuts:
    """Where the scores change: the last (value, account) of quintiles 1 to 4 of frequency and
    spend (in cents), and four times the 75th percentile of balances in cents, which keeps the
    interpolated value whole. Nothing is known without accounts."""

    frequency: list[tuple[int, int] | None]
    spend: list[tuple[int, int] | None]
    high_balance_times_4: int | None


def _scored() -> list[Column]:
    return [F.col("frequency_180d"), *[cents(F.col(name)).cast("bigint") for name in ("card_spend_180d", "balance_at_period_end")]]


def cut_points(base: DataFrame) -> Cuts:
    """The cut points are selected by rank, all three columns in the same rounds; no row is sorted."""

    def quintiles(prefix: str):
        # last rank whose quintile is ``step``: rank - 1 <= step * (n - 1) / 5
        return lambda n: {f"{prefix}{step}": (n - 1) * step // 5 + 1 for step in range(1, 5)}

    def quarter(n: int) -> dict[str, int]:
        below = (n - 1) * 3 // 4 + 1
        quarters[0] = (n - 1) * 3 % 4
        return {"below": below, "above": min(below + 1, n)}

    quarters = [0]
    at = rows_at(base, _scored(), F.col("account_id"), {0: quintiles("f"), 1: quintiles("m"), 2: quarter})
    steps = range(1, 5)
    high = None
    if at:
        (below, _), (above, _) = at["below"], at["above"]
        high = below * 4 + (above - below) * quarters[0]
    return Cuts([at.get(f"f{step}") for step in steps], [at.get(f"m{step}") for step in steps], high)


def _quintile(value: Column, ends: list[tuple[int, int] | None]) -> Column:
    after = [passed(value, F.col("account_id"), end).cast("int") for end in ends]
    return F.lit(1) + after[0] + after[1] + after[2] + after[3]


def with_scores(frame: DataFrame, cuts: Cuts) -> DataFrame:
    """R, F, M and the segment next to the columns of ``frame``.

    Quintiles equal cutting first-come ranks at interpolated quantiles, ties broken by
    account. The first matching rule names the segment.
    """
    frequency, spend, balance = _scored()
    scored = frame.select(
        *frame.columns,
        recency_score().alias("R"),
        _quintile(frequency, cuts.frequency).alias("F"),
        _quintile(spend, cuts.spend).alias("M"),
        (balance * 4 >= F.lit(cuts.high_balance_times_4).cast("bigint")).alias("high_balance"),
    )
    champions, regulars, savers, occasional, at_risk, asleep = SEGMENTS
    r, f, m = F.col("R"), F.col("F"), F.col("M")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), champions)
        .when((f <= 2) & F.col("high_balance"), savers)
        .when(r == 1, asleep)
        .when(r <= 3, at_risk)
        .when(f >= 3, regulars)
        .otherwise(occasional)
    )
    return scored.withColumn("segment", segment).drop("high_balance")


def segment_rfm(base: DataFrame) -> DataFrame:
    """Score a base and name each account's segment. It is read several times, so written once."""
    base = written(base)
    return with_scores(base, cut_points(base))


def rfm_segments(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return segment_rfm(rfm_base(tables, params))


def rfm_recency(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return rfm_base(tables, params).select("account_id", "recency_days", recency_score().alias("R"))


def rfm_frequency(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return rfm_segments(tables, params).select("account_id", "frequency_180d", "F")


def rfm_monetary(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return rfm_segments(tables, params).select("account_id", "card_spend_180d", "M")


def rfm_high_balance(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """The 75th percentile of balances, interpolated, to four decimals."""
    high = cut_points(written(rfm_base(tables, params))).high_balance_times_4
    return tables.spark.createDataFrame([(None if high is None else Decimal(high) / 400,)], "high_balance decimal(18,4)")


def segment_profile(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """One row per segment in fixed order, also for segments nobody is in."""
    grouped = rfm_segments(tables, params).groupBy("segment").agg(
        F.count("account_id").alias("comptes"),
        rounded_ratio(F.sum("recency_days"), F.count("recency_days"), 1).alias("recence_moy_jours"),
        rounded_ratio(F.sum("frequency_180d"), F.count("*"), 1).alias("operations_180j"),
        money_mean(F.sum("card_spend_180d"), F.count("*"), 1).alias("depenses_carte_180j"),
        money_mean(F.sum("balance_at_period_end"), F.count("*"), 1).alias("solde_moyen"),
        F.sum("balance_at_period_end").cast(MONEY).alias("encours"),
    )
    order = tables.spark.createDataFrame([(name, i) for i, name in enumerate(SEGMENTS, 1)], "segment string, ordre int")
    return (
        order.join(F.broadcast(grouped), "segment", "left")
        .select(
            "*",
            pct(F.col("comptes"), grand_total("comptes")).alias("part_comptes_pct"),
            money_pct(F.col("encours"), grand_total("encours")).alias("part_encours_pct"),
        )
        .orderBy("ordre")
    )
