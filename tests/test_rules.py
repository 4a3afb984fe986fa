from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import CARDS

from bankpulse import schemas
from bankpulse.operators.attempts import classify_logins, classify_transfers
from bankpulse.operators.ledger import decide


def accounts(spark):
    rows = [
        (1, 101, CARDS[0], "x", Decimal("100.00"), "ACTIVE", None, None),
        (2, 102, CARDS[1], "x", Decimal("0.00"), "ACTIVE", None, None),
        (3, 103, CARDS[2], "x", Decimal("0.00"), "CLOSED", None, None),
        (4, 104, CARDS[1], "x", Decimal("0.00"), "CLOSED", None, None),  # repeats the card of account 2
    ]
    return spark.createDataFrame(rows, schemas.ACCOUNTS)


def test_transfer_reasons_in_order(spark):
    cases = [
        ("4000004938320895", "50", "INVALID_CARD_NUMBER"), ("400000493832089", "50", "INVALID_CARD_NUMBER"),
        (CARDS[0], "50", "SAME_ACCOUNT"), ("4000000000000002", "50", "UNKNOWN_CARD"), (CARDS[2], "50", "ACCOUNT_CLOSED"),
        (CARDS[1], "0", "INVALID_AMOUNT"), (CARDS[1], "101", "INSUFFICIENT_FUNDS"), (CARDS[1], "50", None),
        (None, "50", "INVALID_CARD_NUMBER"),
    ]
    rows = [(i, 1, card, Decimal(amount)) for i, (card, amount, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, "attempt_id bigint, sender_id bigint, card_input string, amount decimal(12,2)")
    found = {row.attempt_id: row for row in classify_transfers(frame, accounts(spark)).collect()}
    assert len(found) == len(cases)
    for i, (_, _, reason) in enumerate(cases):
        assert found[i].failure_reason == reason
        assert found[i].status == ("FAILED" if reason else "SUCCESS")
    assert found[7].account_id == 2 and found[4].account_id == 3 and found[2].account_id is None


def test_login_reasons_in_order(spark):
    rows = [(0, CARDS[0], True), (1, CARDS[0], False), (2, CARDS[2], True), (3, "1234", True), (4, "4000000000000002", True),
            (5, CARDS[0], None), (6, None, True)]
    frame = spark.createDataFrame(rows, "attempt_id bigint, card_input string, pin_ok boolean")
    found = {row.attempt_id: row.failure_reason for row in classify_logins(frame, accounts(spark)).collect()}
    assert found == {0: None, 1: "WRONG_PIN", 2: "ACCOUNT_CLOSED", 3: "INVALID_CARD_NUMBER", 4: "UNKNOWN_CARD",
                     5: "WRONG_PIN", 6: "INVALID_CARD_NUMBER"}


def test_what_is_unknown_refuses(spark):
    rows = [(0, 99, CARDS[1], Decimal(1)), (1, 1, CARDS[1], None), (2, None, CARDS[1], Decimal(1)), (3, 5, CARDS[1], Decimal(1)),
            (4, 1, CARDS[2], Decimal(1))]
    frame = spark.createDataFrame(rows, "attempt_id bigint, sender_id bigint, card_input string, amount decimal(12,2)")
    known = accounts(spark).withColumn("balance", F.expr("if(account_id = 3, null, balance)")).union(
        accounts(spark).where("account_id = 1").selectExpr("5", "customer_id", "'x'", "pin_hash", "null", "status", "opened_at", "closed_at"))
    known = known.withColumn("status", F.expr("if(account_id = 3, null, status)"))
    found = {r.attempt_id: r.failure_reason for r in classify_transfers(frame, known).collect()}
    assert found == {0: "INSUFFICIENT_FUNDS", 1: "INVALID_AMOUNT", 2: "INSUFFICIENT_FUNDS", 3: "INSUFFICIENT_FUNDS", 4: "ACCOUNT_CLOSED"}


def test_debit_boundaries():
    assert decide(10_000, False, 10_000) == ("", 0)
    assert decide(10_000, False, 10_001) == ("INSUFFICIENT_FUNDS", 10_000)
    assert decide(10_000, False, -500) == ("INVALID_AMOUNT", 10_000)
    assert decide(10_000, True, 0) == ("INVALID_AMOUNT", 10_000)
    assert decide(10_000, True, 1) == ("", 10_001)
