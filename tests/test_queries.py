"""Every registered query against its DuckDB check, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from bankpulse.plans.catalog import catalog
from bankpulse.sources.fixture import open_fixture
from oracle import checks
from oracle.compare import connect, difference
from tests.conftest import SMALL

CHECKS = checks()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_check():
    assert set(catalog()) == set(CHECKS)
    assert set(CHECKS) <= set(registry.oracle_sql()) and set(CHECKS) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, duck, name):
    assert difference(registry.queries()[name](spark, SMALL), duck, CHECKS[name]) is None


@pytest.mark.parametrize("name", ["rfm_segments", "q06_balance_concentration", "customers_clean", "running_balance"])
def test_results_do_not_depend_on_the_number_of_partitions(spark, name):
    query = registry.queries()[name]
    first = sorted(map(str, query(spark, SMALL).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert sorted(map(str, query(spark, SMALL).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry(spark):
    assert registry.entry(spark).first().accounts > 0


def test_matrices_lose_no_cell(spark):
    queries = registry.queries()
    cells = queries["q05_cohort_retention"](spark, SMALL).count()
    filled = 0
    for row in queries["retention_matrix"](spark, SMALL).collect():
        values = row.asDict()
        listed = [values.pop(name) for name in ("before_opening", "after_period")]
        filled += sum(v is not None for name, v in values.items() if name != "cohort") + sum(len((t or "").split()) for t in listed)
    assert filled == cells


def test_every_input_row_becomes_an_event(spark):
    tables = open_fixture(spark, SMALL)
    customers = tables.raw("customer")
    invented = customers.count() + customers.where("c_custkey % 19 = 0").count() + customers.where("c_custkey % 5 < 3 and c_custkey % 11 <> 0").count()
    events = invented + tables.raw("orders").count() + tables.raw("lineitem").count()
    assert tables.operation_log().count() == events
    lines = tables.staging().count()
    normal = tables.staging().where("trim(crm_customer_id) rlike '^[0-9]+$' and signup_channel <> 'fax' and updated_at <> 'soon'")
    rejected = registry.queries()["rejected_customers"](spark, SMALL).count()
    assert rejected == lines - normal.count() > 0


def test_every_account_is_posted(spark):
    assert registry.queries()["apply_balances"](spark, SMALL).count() == open_fixture(spark, SMALL).accounts().count()
