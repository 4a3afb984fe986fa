"""The shape of the physical plans: what may not creep in."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registry
from bankpulse.sources.fixture import PARAMS, open_fixture
from tests.conftest import SMALL

# windows over everything are allowed on rows that were grouped down to a handful before
PYTHON_ALLOWED = {"ledger_replay", "ledger_replay_stream", "ascii_slug"}
ACCOUNT_SIZED = [
    "v_account_activity", "customers_clean", "dedup_latest", "q03b_activation_detail", "q11_dormancy_watchlist", "q12_rfm_base",
    "pbi_dim_account", "pbi_fact_account_month", "running_balance", "account_money", "account_ops",
]
SAMPLE = [
    *ACCOUNT_SIZED, "q01_global_kpis", "q05_cohort_retention", "q07_card_spend_by_category", "q08_failures_by_reason",
    "v_monthly_kpis", "pbi_fact_operations", "pbi_fact_card_spend", "pbi_fact_retention", "integrity_checks",
    "crm_profiling", "chi2_channels", "chi2_mobile_web", "classify_logins", "classify_transfers", "cst_foreign_keys", "fait_operations",
]


def plan(spark, name):
    return registry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SAMPLE)
def test_no_all_pairs_joins_and_no_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text) or name in PYTHON_ALLOWED


@pytest.mark.parametrize("name", ACCOUNT_SIZED)
def test_account_sized_rows_are_never_put_in_one_partition(spark, name):
    assert "SinglePartition" not in plan(spark, name)


def test_as_of_bound_reaches_the_scan(spark):
    text = plan(spark, "account_ops")
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(l_shipdate", text)
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(o_orderdate", text)
    assert "l_extendedprice" not in text  # amounts are not read for counts


def test_both_logs_share_one_exchange_by_account(spark):
    text = plan(spark, "account_money")
    assert text.count("Exchange hashpartitioning(account_id") == 1
    whole = plan(spark, "v_account_activity")
    assert whole.count("partial_min(first_deposit_at") == 1  # one grouping for operations and money


def test_retention_reads_no_money(spark):
    assert "l_extendedprice" not in plan(spark, "q05_cohort_retention")


@pytest.mark.parametrize("name", ["cst_primary_keys", "prof_distinct_ids", "chk_card_duplicates", "m_comptes_actifs_du_mois", "monthly_ops"])
def test_distinct_counts_exchange_words(spark, name):
    """Ids are combined to words of 64 before they move; none is exchanged by itself."""
    text = plan(spark, name)
    assert "partial_bit_or(" in text and "Expand" not in text
    assert not re.search(r"Exchange hashpartitioning\([^)]*\b(operation_id|transaction_id|crm_customer_id|card_number)#", text)


@pytest.mark.parametrize("name", ["q05_cohort_retention", "pbi_fact_retention"])
def test_months_of_an_account_travel_as_one_word(spark, name):
    text = plan(spark, name)
    assert text.count("partial_bit_or(") == 1
    assert not re.search(r"hashpartitioning\([^)]*(activity_month|month_start)", text)


@pytest.mark.parametrize("name", ["rfm_segments", "rfm_frequency", "dim_compte"])
def test_scores_need_no_sort_of_the_accounts(spark, name):
    text = plan(spark, name)
    assert "rangepartitioning" not in text and "Window" not in text and "NestedLoop" not in text


def test_sources_of_the_logs_stay_below_the_methods_the_jvm_compiles(spark, capsys):
    """A generated method above 8000 bytes is interpreted for every row; transactions had 8264."""
    tables = open_fixture(spark, SMALL)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for until in (None, PARAMS.period_end):
            for log in (tables.operation_log(until), tables.transactions(until)):
                log.explain("codegen")
                sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
                assert sizes and max(sizes) < 6000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
