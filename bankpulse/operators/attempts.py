"""Ordered acceptance rules for logins and transfers, and card-number columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.cards import check_digit, passes_luhn, valid_card_input


def card_lookup(accounts: DataFrame) -> DataFrame:
    """One row per card number: the lowest account holding it."""
    return (
        accounts.groupBy("card_number")
        .agg(F.min(F.struct("account_id", "status")).alias("holder"))
        .select(
            F.col("card_number").alias("card_input"),
            F.col("holder.account_id").alias("account_id"),
            F.coalesce(F.col("holder.status") == "ACTIVE", F.lit(False)).alias("is_active"),
        )
    )


def _resolved(attempts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Attempts with their account looked up, in one pass. Numbers that fail the cheap format
    and check-digit test get a key of their own, which spreads them and matches no card."""
    tested = attempts.withColumn("well_formed", F.coalesce(valid_card_input(F.col("card_input")), F.lit(False)))
    key = F.when(F.col("well_formed"), F.col("card_input")).otherwise(F.concat(F.lit("-"), "attempt_id"))
    cards = card_lookup(accounts).withColumnRenamed("card_input", "looked_up")
    return tested.withColumn("looked_up", key).join(cards, "looked_up", "left").drop("looked_up")


def classify_logins(attempts: DataFrame, accounts: DataFrame) -> DataFrame:
    """``attempts``: attempt_id, card_input, pin_ok. An unknown PIN result counts as wrong."""
    reason = (
        F.when(~F.col("well_formed"), "INVALID_CARD_NUMBER")
        .when(F.col("account_id").isNull(), "UNKNOWN_CARD")
        .when(~F.col("is_active"), "ACCOUNT_CLOSED")
        .when(~F.coalesce("pin_ok", F.lit(False)), "WRONG_PIN")
    )
    return _outcome(_resolved(attempts, accounts), reason)


def classify_transfers(attempts: DataFrame, accounts: DataFrame) -> DataFrame:
    """``attempts``: attempt_id, sender_id, card_input, amount; the sender's card and
    balance come from ``accounts``. What is unknown refuses: a missing amount is invalid, and
    an unknown sender or balance has no funds. Every attempt has an outcome."""
    senders = accounts.select(
        F.col("account_id").alias("sender_id"), F.col("card_number").alias("sender_card"),
        F.col("balance").alias("sender_balance"),
    )
    with_sender = attempts.join(senders, "sender_id", "left")
    reason = (
        F.when(~F.col("well_formed"), "INVALID_CARD_NUMBER")
        .when(F.col("card_input") == F.col("sender_card"), "SAME_ACCOUNT")
        .when(F.col("account_id").isNull(), "UNKNOWN_CARD")
        .when(~F.col("is_active"), "ACCOUNT_CLOSED")
        .when(~F.coalesce(F.col("amount") > 0, F.lit(False)), "INVALID_AMOUNT")
        .when(~F.coalesce(F.col("amount") <= F.col("sender_balance"), F.lit(False)), "INSUFFICIENT_FUNDS")
    )
    return _outcome(_resolved(with_sender, accounts), reason)


def _outcome(resolved: DataFrame, reason) -> DataFrame:
    unresolved = F.col("failure_reason").isin("INVALID_CARD_NUMBER", "SAME_ACCOUNT", "UNKNOWN_CARD")
    return resolved.withColumn("failure_reason", reason).select(
        "attempt_id",
        F.when(F.coalesce(unresolved, F.lit(False)), None).otherwise(F.col("account_id")).alias("account_id"),
        F.when(F.col("failure_reason").isNull(), "SUCCESS").otherwise("FAILED").alias("status"),
        "failure_reason",
    )


def luhn_valid(attempts: DataFrame) -> DataFrame:
    return attempts.select("attempt_id", "card_input", passes_luhn(F.col("card_input")).alias("is_valid"))


def luhn_check_digit(accounts: DataFrame) -> DataFrame:
    body = F.substring("card_number", 1, 15)
    return accounts.select("account_id", body.alias("body"), check_digit(body).cast("int").alias("check_digit"))
