"""Chi-square test of independence between signup channel and early funding."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bankpulse.functions.numbers import grand_total
from bankpulse.operators.business import activation_detail
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables

TAIL_DEPTH = 80


def upper_tail(chi2: Column, dof: Column) -> Column:
    """P(X >= chi2) for any number of degrees of freedom: the regularised incomplete gamma
    function at halves, as a finite sum.

    An even number is a sum of Poisson terms; an odd one starts from erfc: the power series of
    erf near zero, else the continued fraction of erfc, both to a fixed depth. Terms are added
    up from their logarithms, so none overflows.
    """
    x = F.sqrt(chi2 / 2)

    def next_term(done: Column, k: Column) -> Column:
        term = done.term * 2 * x * x / (2 * k + 1)
        return F.struct(term.alias("term"), (done.total + term).alias("total"))

    depth = F.sequence(F.lit(1), F.lit(TAIL_DEPTH))
    series = F.aggregate(depth, F.struct(x.alias("term"), x.alias("total")), next_term, lambda done: done.total)
    fraction = F.aggregate(F.reverse(depth), x, lambda inner, k: x + k / 2 / inner)
    near = 1 - 2 / math.sqrt(math.pi) * F.exp(-chi2 / 2) * series
    far = F.exp(-chi2 / 2) / (F.lit(math.sqrt(math.pi)) * fraction)
    one = F.when(x < 2, near).otherwise(far)
    half, odd = chi2 / 2, dof % 2 == 1

    def add(done: Column, k: Column) -> Column:
        log = done.log + F.log(half) - F.log(k + F.when(odd, 0.5).otherwise(0.0))
        return F.struct(log.alias("log"), (done.total + F.exp(log)).alias("total"))

    # the first term is that of k = 0, for an odd number that of k = 1
    log = F.when(odd, F.log(half) / 2 - half - math.log(math.sqrt(math.pi) / 2)).otherwise(-half)
    first = F.struct(log.alias("log"), F.exp(log).alias("total"))
    terms = F.call_function("div", dof - F.when(odd, 1).otherwise(0), F.lit(2)).cast("int")
    more = F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(more, first, add, lambda done: done.total)
    return (
        F.when((dof <= 0) | (chi2 <= 0), 1.0).when(dof == 1, one)
        .otherwise(F.least(F.lit(1.0), total + F.when(odd, one).otherwise(0.0)))
    )


def independence_test(detail: DataFrame) -> DataFrame:
    """chi2, degrees of freedom, p-value and Cramer's V of a channel x funded table.

    A 2x2 table gets the continuity correction: each |observed - expected| shrinks by
    0.5, but not below zero.
    """
    funded = F.col("funded_within_30_days")
    outcomes = F.array(
        F.struct(F.lit(True).alias("outcome"), F.col("funded").alias("observed")),
        F.struct(F.lit(False).alias("outcome"), F.col("not_funded").alias("observed")),
    )
    by_channel, by_outcome = W.partitionBy("signup_channel"), W.partitionBy("outcome")
    table = (  # two rows per channel from here on
        detail.groupBy("signup_channel")
        .agg(F.count_if(funded).alias("funded"), F.count_if(~funded).alias("not_funded"))
        .select("signup_channel", F.inline(outcomes))
        .withColumn("outcome_total", F.sum("observed").over(by_outcome))
        .where(F.col("outcome_total") > 0)
        .select(
            "observed",
            (F.sum("observed").over(by_channel).cast("double") * F.col("outcome_total")
             / grand_total("observed")).alias("expected"),
            F.count("*").over(by_outcome).alias("n_channels"),
            F.count("*").over(by_channel).alias("n_outcomes"),
        )
        .withColumn("dof", ((F.col("n_channels") - 1) * (F.col("n_outcomes") - 1)).cast("int"))
        .withColumn("gap", F.abs(F.col("observed") - F.col("expected")))
    )
    gap = F.col("gap") - F.when(F.col("dof") == 1, F.least(F.lit(0.5), F.col("gap"))).otherwise(F.lit(0.0))
    totals = table.agg(
        F.sum(gap * gap / F.col("expected")).alias("chi2"),
        F.max("dof").alias("dof"),
        F.sum("observed").alias("n"),
        (F.least(F.max("n_channels"), F.max("n_outcomes")) - 1).alias("smaller"),
    )
    strength = F.sqrt(F.col("chi2") / F.nullif(F.col("n") * F.col("smaller"), F.lit(0)))

    def six(value):
        return F.round(value, 6).cast("decimal(18,6)")

    return totals.select(
        "n", six(F.col("chi2")).alias("chi2"), "dof",
        six(upper_tail(F.col("chi2"), F.col("dof"))).alias("p_value"), six(strength).alias("cramers_v"),
    )


def chi2_channels(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return independence_test(activation_detail(tables, params))


def chi2_mobile_web(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return independence_test(activation_detail(tables, params).where(F.col("signup_channel") != "PARTNER"))
