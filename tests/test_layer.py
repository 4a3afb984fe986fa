"""Months delivered onto a layer, the sums kept of them, and the counts in buckets by operation."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankpulse import AnalysisParams, FrameTables, schemas
from bankpulse.operators.activity import account_measures, account_money, account_ops, v_account_activity
from bankpulse.operators.constraints import foreign_keys
from bankpulse.operators.integrity import integrity_check, integrity_checks
from bankpulse.operators.monthly import monthly_money, monthly_ops, v_monthly_kpis
from bankpulse.operators.star import Star
from bankpulse.plans import pipeline
from bankpulse.sources.files import write_crm_csv, write_typed_csv
from bankpulse.sources.layer import LayerTables, publish, retire, stage_layer, write_layer
from bankpulse.tables import counted_operations
from tests.conftest import Journey, at

JOBS = [account_ops, account_money, account_measures, monthly_ops, monthly_money, v_monthly_kpis]


def rows(frame):
    return sorted(map(str, frame.collect()))


def frames(spark, journey, operations, transactions):
    return FrameTables(
        spark,
        staging=spark.createDataFrame(journey.staging, schemas.STAGING),
        accounts=spark.createDataFrame(journey.accounts, schemas.ACCOUNTS),
        operation_log=spark.createDataFrame(operations, schemas.OPERATION_LOG),
        transactions=spark.createDataFrame(transactions, schemas.TRANSACTIONS),
    )


def busy_journey() -> Journey:
    """Operations of every fifth day of the year, of any outcome, with what they move; some have no
    account, no moment or no amount."""
    journey = Journey()
    kinds = ["DEPOSIT", "CARD_PAYMENT", "LOGIN", "TRANSFER", "WITHDRAWAL"]
    for i in range(73):
        moment, account = at("2025-01-05") + timedelta(days=5 * i, minutes=i), (1, 2, 3, None)[i % 4]
        if i % 36 == 17:
            moment = None
        kind, good = kinds[i % 5], i % 3 > 0
        amount = None if i % 29 == 7 else Decimal(i)
        channel = "CARD_NETWORK" if kind == "CARD_PAYMENT" else "APP"
        journey.operations.append((100 + i, account, kind, "SUCCESS" if good else "FAILED", None if good else "WRONG_PIN", channel, amount, moment))
        if good and kind != "LOGIN":
            source, target = (None, account) if kind == "DEPOSIT" else (account, 1 if kind == "TRANSFER" else None)
            journey.transactions.append((100 + i, 100 + i, kind, source, target, amount, "GROCERIES" if kind == "CARD_PAYMENT" else None, moment))
    return journey


@pytest.fixture
def busy():
    return busy_journey()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Tables, and the layer written of them."""
    tables, layer = busy_journey().tables(spark), str(tmp_path_factory.mktemp("loaded"))
    write_layer(tables, layer)
    return tables, layer


@pytest.mark.parametrize("end", [
    "2025-12-31 23:59:59", "2025-12-12 10:03:00", "2025-07-14 12:00:00", "2025-01-05 10:00:00", "2024-12-31 23:59:59", "2026-03-01 00:00:00",
])
def test_kept_sums_give_the_rows_of_the_logs(spark, loaded, end):
    plain, layer = loaded
    params = AnalysisParams(datetime(2024, 1, 1), datetime.fromisoformat(end), 90)
    for job in JOBS:
        assert rows(job(LayerTables(spark, layer), params)) == rows(job(plain, params)), job.__name__


def split(busy, delivered):
    of = lambda table: [r for r in table if r[7] is not None and r[7].strftime("%m") in delivered]
    return of(busy.operations), of(busy.transactions)


def test_a_delivery_of_months_equals_the_full_rebuild(spark, busy, params, tmp_path):
    """One month is new, one replaces other rows, one comes without transactions."""
    layer, months = str(tmp_path / "layer"), {"03", "11", "12"}
    new_operations, new_transactions = split(busy, months)
    busy.transactions = [r for r in busy.transactions if r[7] is None or r[7].month != 3]
    new_transactions = [r for r in new_transactions if r[7].month != 3]
    wrong = (900, 3, "LOGIN", "SUCCESS", None, "APP", None, at("2025-03-03"))
    wrong_money = (900, 900, "DEPOSIT", None, 3, Decimal(7), None, at("2025-03-03"))
    old = [[r for r in table if r not in new] for table, new in ((busy.operations, new_operations), (busy.transactions, new_transactions))]
    write_layer(frames(spark, busy, [*old[0], wrong], [*old[1], wrong_money]), layer)
    before = LayerTables(spark, layer)
    write_layer(frames(spark, busy, new_operations, new_transactions), layer, before.run)
    after, full = LayerTables(spark, layer), frames(spark, busy, busy.operations, busy.transactions)
    for job in JOBS:
        assert rows(job(after, params)) == rows(job(full, params)), job.__name__
    for log in ("operation_log", "transactions"):
        assert rows(getattr(after, log)()) == rows(getattr(full, log)())
    assert rows(integrity_checks(after)) == rows(integrity_checks(full)) and rows(foreign_keys(after)) == rows(foreign_keys(full))
    for name in ("fait_operations", "dim_mois", "fait_retention_cohortes"):
        assert rows(getattr(Star(after, params), name)) == rows(getattr(Star(full, params), name))
    assert wrong[0] in {r.operation_id for r in before.operation_log().collect()}  # its reader keeps its state
    retire(spark, layer, keep=1)
    assert rows(v_account_activity(LayerTables(spark, layer), params)) == rows(v_account_activity(full, params))


def test_a_second_delivery_lets_go_of_runs_without_months(spark, busy, tmp_path):
    layer = str(tmp_path / "layer")
    write_layer(busy.tables(spark), layer)
    for _ in range(2):
        write_layer(frames(spark, busy, *split(busy, {"11"})), layer, LayerTables(spark, layer).run)
    retire(spark, layer, keep=1)
    held = {f.name for f in (tmp_path / "layer").iterdir() if f.name.startswith("run-") and (f / "operation_log").exists()}
    tables = LayerTables(spark, layer)
    assert held == {row.run for row in tables.months} and len(held) == 2
    assert tables.operation_log().count() == len(busy.operations)


def scans(frame):
    """Log folders that the plan reads."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"/(operation_log|transactions|account_months|money_months)\]", text), text


def test_a_reading_after_a_delivery_reads_no_old_log(spark, busy, tmp_path):
    layer = str(tmp_path / "layer")
    write_layer(busy.tables(spark), layer)
    write_layer(frames(spark, busy, *split(busy, {"12"})), layer, LayerTables(spark, layer).run)
    tables = LayerTables(spark, layer)
    whole = AnalysisParams(datetime(2025, 1, 1), datetime(2025, 12, 31, 23, 59, 59), 90)
    kept = tables.kept(whole.period_end, whole.period_end - timedelta(days=180))
    assert [str(row.month) for row in kept.rest.months] == ["2025-07-01"]  # the bound of recent rows cuts July
    assert not tables.kept(whole.period_end).rest.months
    read, text = scans(monthly_ops(tables, whole))
    assert set(read) == {"account_months"}
    read, text = scans(account_measures(tables, whole))
    assert read.count("operation_log") == read.count("transactions") == 1 and text.count("2025-07-01") >= 2


def test_pairs_in_buckets_are_joined_without_an_exchange(spark, busy, tmp_path):
    layer = str(tmp_path / "layer")
    busy.operations += [(101, 1, "DEPOSIT", "SUCCESS", None, "APP", Decimal(1), at("2025-02-02"))] * 3
    busy.operations.append((None, 1, "DEPOSIT", "SUCCESS", None, "APP", Decimal(1), at("2025-02-02")))
    busy.transactions += [(990, 9999, "DEPOSIT", None, 1, Decimal(1), None, at("2025-02-02"))] * 2
    busy.transactions.append((991, None, "DEPOSIT", None, 1, Decimal(1), None, at("2025-02-02")))
    plain = busy.tables(spark)
    write_layer(plain, layer)
    tables = LayerTables(spark, layer)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for key in ("chk_txn_vs_operation", "chk_op_without_txn"):
            checked = integrity_check(tables, key)
            text = checked._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in text and text.count("Bucketed: true") == 2
            assert rows(checked) == rows(integrity_check(plain, key)) and checked.first().failing_rows > 0
        links = foreign_keys(tables)
        text = links._jdf.queryExecution().executedPlan().toString()
        assert text.count("Bucketed: true") == 2 and "hashpartitioning(operation_id" not in text
        assert rows(links) == rows(foreign_keys(plain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # another session has no such table and declares it over the same files
    spark.sql(f"DROP TABLE operation_counts_{tables.run.replace('-', '_')}")
    assert rows(LayerTables(spark, layer).operation_counts()) == rows(plain.operation_counts())


def test_counts_move_the_rows_to_their_bucket_once(spark, busy, tmp_path, monkeypatch):
    """One exchange by operation besides that of frequent ids, which are counted before they move."""
    busy.operations += [(101, 1, "DEPOSIT", "SUCCESS", None, "APP", Decimal(1), at("2025-02-02"))] * 30
    busy.operations += [(None, 1, "DEPOSIT", "SUCCESS", None, "APP", Decimal(1), at("2025-02-02"))] * 20
    plain, layer, moved = busy.tables(spark), str(tmp_path / "layer"), []
    monkeypatch.setattr("bankpulse.sources.layer.FREQUENT", 0.05)
    monkeypatch.setattr("bankpulse.sources.layer.counted_operations", lambda rows: moved.append(rows) or counted_operations(rows))
    write_layer(plain, layer)
    spread, few = moved
    assert spread.where("operation_id = 101 OR operation_id IS NULL").isEmpty()
    assert few.where("operation_id = 101").count() >= 30 and few.where("operation_id IS NULL").count() == 20
    text = counted_operations(spread)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(operation_id") == 1
    assert rows(LayerTables(spark, layer).operation_counts()) == rows(plain.operation_counts())


def test_sums_are_written_where_they_were_made(spark, busy, tmp_path):
    """No range shuffle of the sums; as-of reads skip months by the order inside the files."""
    layer = str(tmp_path / "layer")
    write_layer(busy.tables(spark), layer)
    tables = LayerTables(spark, layer)
    folder = tmp_path / "layer" / tables.run / "account_months"
    assert not [f for f in folder.iterdir() if f.is_dir()]
    for part in folder.glob("*.parquet"):
        months = [r.month for r in spark.read.parquet(str(part)).select("month").coalesce(1).collect() if r.month]
        assert months == sorted(months)


def test_empty_logs(spark, journey, params, tmp_path):
    layer = str(tmp_path / "layer")
    empty = frames(spark, journey, [], [])
    write_layer(empty, layer)
    for job in JOBS:
        assert rows(job(LayerTables(spark, layer), params)) == rows(job(empty, params)), job.__name__
    assert rows(integrity_checks(LayerTables(spark, layer))) == rows(integrity_checks(empty))


def test_an_unpublished_delivery_changes_nothing(spark, busy, tmp_path):
    layer = str(tmp_path / "layer")
    write_layer(busy.tables(spark), layer)
    run, counts = stage_layer(frames(spark, busy, *split(busy, {"11"})), layer, LayerTables(spark, layer).run)
    assert LayerTables(spark, layer).run != run and counts["operation_log"] == len(split(busy, {"11"})[0])
    publish(spark, layer, run)
    assert LayerTables(spark, layer).run == run


def test_the_batch_takes_months(spark, journey, params, tmp_path):
    delivery, layer = str(tmp_path / "in"), str(tmp_path / "layer")

    def deliver(tables):
        write_crm_csv(tables.staging(), f"{delivery}/customers_crm_export.csv")
        write_typed_csv(tables.accounts_with_balance(), f"{delivery}/accounts.csv")
        write_typed_csv(tables.operation_log(), f"{delivery}/operation_log.csv")
        write_typed_csv(tables.transactions(), f"{delivery}/transactions.csv")

    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, "months", delivery, layer, "", params)
    deliver(journey.tables(spark))
    pipeline.run(spark, "load", delivery, layer, "", params)
    december = [[r for r in table if r[7].month == 12] for table in (journey.operations, journey.transactions)]
    december[0].append((80, 1, "LOGIN", "SUCCESS", None, "APP", None, at("2025-12-30")))
    deliver(frames(spark, journey, *december))
    counts = pipeline.run(spark, "months", delivery, layer, "", params)
    assert counts["operation_log"] == len(december[0])
    view = v_account_activity(LayerTables(spark, layer), params).where(F.col("account_id") == 1).first()
    assert (view.logins, str(view.last_activity_at)) == (1, "2025-12-30 10:00:00")
