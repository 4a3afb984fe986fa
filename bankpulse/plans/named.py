"""Named queries: ``run_query(name, tables, params)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from bankpulse.operators import business, integrity, profiling, star
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables

Job = Callable[[BankTables, AnalysisParams], DataFrame]

NAMED: dict[str, Job] = {
    "crm_profiling": lambda t, p: profiling.crm_profiling(t),
    "integrity_checks": lambda t, p: integrity.integrity_checks(t),
    "q01_global_kpis": business.global_kpis,
    "q02_monthly_trend": business.monthly_trend,
    "q03_activation_by_channel": business.activation_by_channel,
    "q03b_activation_detail": business.activation_detail,
    "q04_lifecycle_by_age_band": business.lifecycle_by_age_band,
    "q05_cohort_retention": business.cohort_retention,
    "q06_balance_concentration": business.balance_concentration,
    "q07_card_spend_by_category": business.card_spend_by_category,
    "q08_failures_by_reason": business.failures_by_reason,
    "q09_card_number_errors": business.card_number_errors,
    "q10_declined_payments_concentration": business.declined_payments_concentration,
    "q11_dormancy_watchlist": business.dormancy_watchlist,
    "q12_rfm_base": business.rfm_base,
    "pbi_dim_account": star.account_dimension,
    "pbi_fact_account_month": lambda t, p: star.account_month_fact(star.operation_rows(t, p), star.money_rows(t, p)),
    "pbi_fact_operations": lambda t, p: star.operations_fact(t, star.operation_rows(t, p)),
    "pbi_fact_card_spend": lambda t, p: star.card_spend_fact(t, star.money_rows(t, p)),
    "pbi_fact_retention": lambda t, p: star.retention_fact(t, p, star.operation_rows(t, p)),
}


def run_query(name: str, tables: BankTables, params: AnalysisParams) -> DataFrame:
    if name not in NAMED:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(sorted(NAMED))}")
    return NAMED[name](tables, params)
