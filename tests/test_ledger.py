from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.operators.ledger import (
    apply_balances, decide, ledger_replay, opening_balances, outcome_of, renumber_chronologically, renumber_operations,
    replay_input, replay_output, running_balance, upsert_by_email, walk,
)
from bankpulse.operators.ordering import in_pieces
from bankpulse.streaming import ledger_stream
from bankpulse.streaming.ledger_stream import decided, feed, late_attempts, ledger_replay_stream

START = datetime(2025, 1, 1)


def attempts(n=600, hot=1):
    """Account ``hot`` makes most of the attempts; ids do not follow time."""
    rng = random.Random(3)
    ids = rng.sample(range(10 * n), n)
    rows = []
    for i in ids:
        account = hot if rng.random() < 0.7 else rng.randint(2, 6)
        event = rng.choice(["DEPOSIT", "WITHDRAWAL", "CARD_PAYMENT"])
        moment = START + timedelta(seconds=rng.randint(0, 300) * 1000)
        rows.append((i, account, event, Decimal(rng.randint(-2, 90)) / 2, moment))
    return rows


def brute_force(rows):
    balances, outcome = {}, {}
    for op, account, event, amount, _ in sorted(rows, key=lambda r: (r[4], r[0])):
        reason, balances[account] = decide(balances.get(account, 0), event == "DEPOSIT", int(amount * 100))
        outcome[op] = (account, reason or None, balances[account])
    return outcome


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "operation_id bigint, account_id bigint, event_type string, amount decimal(12,2), created_at timestamp_ntz"
    ).repartition(5)


def as_outcome(replayed):
    return {r.operation_id: (r.account_id, r.failure_reason, int(r.balance_after * 100)) for r in replayed.collect()}


def test_replay_equals_brute_force(spark):
    rows = attempts()
    assert as_outcome(ledger_replay(frame(spark, rows))) == brute_force(rows)


def test_one_account_with_most_rows_in_many_batches(spark):
    rows = attempts(3000)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
        assert as_outcome(ledger_replay(frame(spark, rows))) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.fixture
def many_pieces(spark):
    """Small inputs are cut as large ones are."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("n", [700, 3000])
def test_an_account_in_many_pieces(spark, many_pieces, n):
    rows = attempts(n)
    pieces = in_pieces(replay_input(frame(spark, rows)), "account_id", "created_at", "operation_id")
    assert pieces.where("account_id = 1").select("_part").distinct().count() > 4
    openings = opening_balances(pieces)
    assert len(openings) > 4 and {account for account, _ in openings} >= {1}
    for long_account in (0, n // 2, n):  # all are cut, the hot one is, none is
        assert as_outcome(ledger_replay(frame(spark, rows), long_account)) == brute_force(rows)


@pytest.mark.parametrize("amounts", ["only credits", "all refused", "all equal"])
def test_pieces_of_one_sided_accounts(spark, many_pieces, amounts):
    events = {"only credits": ["DEPOSIT"], "all refused": ["WITHDRAWAL"], "all equal": ["DEPOSIT", "WITHDRAWAL", "WITHDRAWAL"]}[amounts]
    rows = [(i, 1, events[i % len(events)], Decimal("3.00"), None if i % 50 == 0 else START) for i in range(400)]
    found = as_outcome(ledger_replay(frame(spark, rows), long_account=100))
    ordered = [(op, a, e, m, t or datetime(1, 1, 1)) for op, a, e, m, t in rows]
    assert found == brute_force(ordered)


def test_an_outcome_holds_exactly_as_far_as_its_decisions(spark):
    rng = random.Random(8)
    for _ in range(60):
        chunk = [(rng.random() < 0.4, rng.randint(-1, 9)) for _ in range(rng.randint(0, 12))]

        def decisions(opening, chunk=chunk):
            reasons, balance = [], opening
            for credit, amount in chunk:
                reason, balance = decide(balance, credit, amount)
                reasons.append(reason)
            return reasons, balance - opening

        opening = rng.randint(0, 20)
        found = outcome_of((1, 0), opening, chunk)
        for other in range(40):
            assert found.holds(other) == (decisions(other)[0] == decisions(opening)[0])
            if found.holds(other):
                assert found.net == decisions(other)[1]


def test_openings_are_final_when_every_outcome_holds():
    rng = random.Random(2)
    chunks = {(a, p): [(rng.random() < 0.45, rng.randint(1, 30)) for _ in range(8)] for a in (1, 2) for p in range(12)}
    known, rounds = {}, 0
    openings, pending = walk(list(chunks), known)
    while pending:
        rounds += 1
        for key in pending:
            known.setdefault(key, []).append(outcome_of(key, openings[key], chunks[key]))
        openings, pending = walk(list(chunks), known)
    for account in (1, 2):
        balance = 0
        for part in range(12):
            assert openings[account, part] == balance
            for attempt in chunks[account, part]:
                balance = decide(balance, *attempt)[1]
    assert rounds <= 12


def test_received_transfers_are_credits(spark):
    rows = [(1, 1, "DEPOSIT", Decimal("10.00"), START), (2, 1, "TRANSFER", Decimal("4.00"), START + timedelta(1)),
            (2, 2, "TRANSFER_IN", Decimal("4.00"), START + timedelta(1)), (3, 2, "TRANSFER", Decimal("4.01"), START + timedelta(2)),
            (4, 2, "WITHDRAWAL", None, START + timedelta(3))]
    found = sorted((r.operation_id, r.account_id, r.failure_reason, r.balance_after) for r in ledger_replay(frame(spark, rows)).collect())
    assert found == [(1, 1, None, 10), (2, 1, None, 6), (2, 2, None, 4), (3, 2, "INSUFFICIENT_FUNDS", 4), (4, 2, "INVALID_AMOUNT", 4)]


def test_running_balance_of_an_account_with_most_rows(spark):
    rng = random.Random(9)
    rows = [(i, i, "DEPOSIT", None, 1 if i % 3 else 2, Decimal(rng.randint(1, 9)), None, START + timedelta(seconds=i // 5)) for i in range(2000)]
    found = {r.operation_id: r.balance_after for r in running_balance(spark.createDataFrame(rows, schemas.TRANSACTIONS)).collect()}
    balances, wanted = {1: 0, 2: 0}, {}
    for i, _, _, _, account, amount, _, _ in rows:
        balances[account] += amount
        wanted[i] = balances[account]
    assert found == wanted


def test_the_stream_gives_the_same_ledger(spark):
    rows = attempts(200)
    cuts = ["2025-01-02 00:00:00", "2025-01-03 12:00:00"]
    assert as_outcome(ledger_replay_stream(frame(spark, rows), cuts)) == brute_force(rows)


def test_attempts_without_a_moment_are_decided_first(spark):
    rows = attempts(60) + [(10_000 + i, 1, "DEPOSIT", Decimal("5.00"), None) for i in range(3)]
    found = as_outcome(ledger_replay_stream(frame(spark, rows), ["2025-01-02 00:00:00"]))
    assert found == as_outcome(ledger_replay(frame(spark, rows))) and len(found) == 63


def test_accounts_share_keys_of_the_state(spark, tmp_path, monkeypatch):
    """A call for a key costs milliseconds: with a key per account the time followed the accounts."""
    monkeypatch.setattr(ledger_stream, "BUCKETS", 8)
    rows = replay_input(frame(spark, [(i, i, "DEPOSIT", Decimal(1), START) for i in range(300)]))
    rows.write.parquet(f"{tmp_path}/input")
    query = ledger_stream.start(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/input"), str(tmp_path))
    query.awaitTermination()
    kept = query.lastProgress.stateOperators[0].numRowsTotal
    assert 0 < kept <= 3 * 8 and decided(spark, str(tmp_path)).count() == 300


def test_unknown_accounts_and_kinds_stream_as_in_the_batch(spark, tmp_path):
    """Several accounts of a bucket, a missing account and a missing kind, over two arrivals with a delay."""
    hour = lambda h: START + timedelta(hours=h)
    rows = [(i, None if i % 7 == 0 else i % 5, ("DEPOSIT", "WITHDRAWAL", None)[i % 3], Decimal(i % 11), hour(i)) for i in range(1, 80)]
    feed(replay_input(frame(spark, rows)), [F.col("operation_id") <= 40, F.col("operation_id") > 40], str(tmp_path))
    found = as_outcome(replay_output(decided(spark, str(tmp_path))))
    assert found == brute_force(rows) and len(found) == 79


def test_late_attempts_are_listed_and_change_nothing(spark, tmp_path):
    hour = lambda h: START + timedelta(hours=h)
    rows = [(1, 1, "DEPOSIT", Decimal("9.00"), hour(1)), (2, 1, "WITHDRAWAL", Decimal("8.00"), hour(5)), (3, 2, "DEPOSIT", Decimal("1.00"), hour(9)),
            (4, 1, "WITHDRAWAL", Decimal("7.00"), hour(2)), (5, 1, "WITHDRAWAL", Decimal("1.00"), hour(12)), (6, 3, "DEPOSIT", None, hour(12))]
    arrivals = [F.col("operation_id") <= 3, F.col("operation_id") > 3]
    feed(replay_input(frame(spark, rows)), arrivals, str(tmp_path))
    assert [r.operation_id for r in late_attempts(spark, str(tmp_path)).collect()] == [4]
    found = {r.operation_id: (r.reason, r.balance_cents, r.created_at) for r in decided(spark, str(tmp_path)).collect()}
    assert found == {1: ("", 900, hour(1)), 2: ("", 100, hour(5)), 3: ("", 100, hour(9)), 5: ("", 0, hour(12)), 6: ("INVALID_AMOUNT", 0, hour(12))}


def test_replayed_balances_never_go_below_zero(spark):
    assert ledger_replay(frame(spark, attempts())).where(F.col("balance_after") < 0).count() == 0


def test_running_balance(spark, journey):
    rows = {
        (r.account_id, r.operation_id): r.balance_after
        for r in running_balance(journey.tables(spark).transactions()).collect()
    }
    assert rows == {(1, 5): 250, (1, 6): 150, (2, 6): 100, (2, 8): 0}


def test_posting_movements(spark):
    balances = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("5.00"))], "account_id bigint, balance decimal(12,2)")
    legs = spark.createDataFrame(
        [(1, Decimal("3.00"), Decimal("0.00")), (1, Decimal("0.00"), Decimal("1.50")), (9, Decimal("7.00"), Decimal("0.00"))],
        "account_id bigint, amount_in decimal(12,2), amount_out decimal(12,2)",
    )
    found = {r.account_id: (r.delta, r.balance) for r in apply_balances(balances, legs).collect()}
    assert found == {1: (Decimal("1.50"), Decimal("11.50")), 2: (Decimal("0.00"), Decimal("5.00"))}


def test_upsert_adds_each_unknown_email_once(spark, journey):
    customers = journey.tables(spark).customers()
    incoming = spark.createDataFrame(
        [("jean-paul", "le goff", " JP@example.com", "2025-01-02"), ("other", "name", "jp@example.com", "2025-01-03"),
         ("alice", "again", "Alice@example.com ", "2025-01-01"), ("zoé", "o'neil", "zoe@example.com", "2025-01-01")],
        "first_name string, last_name string, email string, arrived_at string",
    )
    new = [r for r in upsert_by_email(customers, incoming).collect() if r.is_new]
    assert sorted((r.customer_id, r.first_name, r.last_name, r.email) for r in new) == [
        (104, "Jean-Paul", "Le Goff", "jp@example.com"), (105, "Zoé", "O'Neil", "zoe@example.com"),
    ]


def test_renumbering_is_dense_and_chronological(spark):
    moments = [START + timedelta(hours=h) for h in (5, 1, 1, 3)]
    operations = spark.createDataFrame(
        [(i, 1, "DEPOSIT", "SUCCESS", None, "APP", Decimal(1), m) for i, m in zip((40, 30, 20, 10), moments)],
        schemas.OPERATION_LOG)
    transactions = spark.createDataFrame(
        [(1, 40, "DEPOSIT", None, 1, Decimal(1), None, moments[0]), (2, 30, "DEPOSIT", None, 1, Decimal(1), None, moments[1])],
        schemas.TRANSACTIONS)
    transactions = transactions.union(spark.createDataFrame(
        [(3, 99, "DEPOSIT", None, 1, Decimal(1), None, moments[0])], schemas.TRANSACTIONS))
    found = {r.operation_id: (r.new_operation_id, r.new_transaction_id)
             for r in renumber_chronologically(operations, transactions).collect()}
    assert found == {30: (2, 1), 40: (4, 2), 99: (None, 3)}
    whole = renumber_operations(operations)
    assert whole.columns == [*operations.columns, "new_operation_id"]
    assert {r.operation_id: r.new_operation_id for r in whole.collect()} == {20: 1, 30: 2, 10: 3, 40: 4}
