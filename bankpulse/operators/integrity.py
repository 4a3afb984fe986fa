"""Ten blocking integrity checks over the full history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.activity import moves_money, succeeded
from bankpulse.functions.cards import passes_luhn
from bankpulse.operators.activity import movements
from bankpulse.operators.distinct import count_bits, distinct_words
from bankpulse.tables import BankTables
from bankpulse.vocabulary import CHECK_LABELS


class QualityGateError(RuntimeError):
    """Raised when at least one integrity check fails."""


def _rows(frame: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """(check_name, failing_rows) rows from a single aggregation."""
    totals = frame.agg(*[F.coalesce(value, F.lit(0)).cast("bigint").alias(key) for key, value in counts.items()])
    pairs = [
        F.struct(F.lit(CHECK_LABELS[key]).alias("check_name"), F.col(key).alias("failing_rows")) for key in counts
    ]
    return totals.select(F.inline(F.array(*pairs)))


def _on_cards() -> dict[str, Column]:
    return {"chk_luhn": F.sum("invalid"), "chk_card_duplicates": F.sum("n_rows") - count_bits()}


def _on_balances() -> dict[str, Column]:
    return {
        "chk_balance_vs_flows": F.count_if(F.col("balance") != F.coalesce("net", F.lit(0))),
        "chk_negative_balance": F.count_if(F.col("balance") < 0),
        "chk_closed_with_balance": F.count_if((F.col("status") == "CLOSED") & (F.col("balance") != 0)),
    }


def _on_operations() -> dict[str, Column]:
    at = F.col("created_at")
    return {
        "chk_op_before_opening": F.count_if(at < F.col("opened_at")),
        "chk_success_after_close": F.count_if(succeeded() & (at > F.col("closed_at"))),
    }


def _balances_with_flows(tables: BankTables) -> DataFrame:
    flows = (
        movements(tables.transactions())
        .groupBy("account_id")
        .agg(F.sum(F.col("amount_in") - F.col("amount_out")).alias("net"))
    )
    return tables.accounts_with_balance().select("account_id", "balance", "status").join(flows, "account_id", "left")


def _operations_with_lifetimes(tables: BankTables) -> DataFrame:
    operations = tables.operation_log().where(F.col("account_id").isNotNull())
    lifetimes = tables.accounts().select("account_id", "opened_at", "closed_at")
    rows = operations.select("operation_id", "account_id", "status", "created_at")
    return rows.join(lifetimes, "account_id")


def _check_accounts(tables: BankTables, *keys: str) -> DataFrame:
    invalid = F.count_if(~passes_luhn(F.col("card_number"))).alias("invalid")
    cards = distinct_words(tables.accounts(), F.col("card_number"), F.count("*").alias("n_rows"), invalid)
    return _rows(cards, {key: value for key, value in _on_cards().items() if key in keys})


def _check_balances(tables: BankTables, *keys: str) -> DataFrame:
    wanted = {key: value for key, value in _on_balances().items() if key in keys}
    needs_flows = "chk_balance_vs_flows" in wanted
    return _rows(_balances_with_flows(tables) if needs_flows else tables.accounts_with_balance(), wanted)


def _check_operations(tables: BankTables, *keys: str) -> DataFrame:
    wanted = {key: value for key, value in _on_operations().items() if key in keys}
    return _rows(_operations_with_lifetimes(tables), wanted)


def _on_pairs() -> dict[str, Column]:
    matched = F.col("txns").isNotNull()
    differs = ~succeeded() | (F.col("event_type") != F.col("txn_type")) | (F.col("amount_requested") != F.col("amount"))
    return {
        "chk_txn_vs_operation": F.sum(F.when(matched & differs, F.col("txns") * F.col("ops"))),
        "chk_op_without_txn": F.sum(F.when(~matched & succeeded() & moves_money(), F.col("ops"))),
    }


def _check_pairs(tables: BankTables, *keys: str) -> DataFrame:
    """Operations next to their transactions. Both sides are counted per compared values
    first, and the join runs on the partitioning of the counts. A layer keeps the counts in
    buckets by operation: read from there, neither log nor count is exchanged."""
    operations, transactions = tables.operation_counts(), tables.transaction_counts()
    pairs = operations.join(transactions, "operation_id", "left")
    return _rows(pairs, {key: value for key, value in _on_pairs().items() if key in keys})


def _check_transfer_to_closed(tables: BankTables) -> DataFrame:
    received = tables.transactions().where(F.col("to_account_id").isNotNull()).select(
        F.col("to_account_id").alias("account_id"), "operation_id", "created_at"
    )
    closed = tables.accounts().where(F.col("closed_at").isNotNull()).select("account_id", "closed_at")
    joined = received.join(closed, "account_id")
    return _rows(joined, {"chk_transfer_to_closed": F.count_if(F.col("created_at") > F.col("closed_at"))})


def integrity_check(tables: BankTables, key: str) -> DataFrame:
    """One check on its own."""
    if key in ("chk_luhn", "chk_card_duplicates"):
        return _check_accounts(tables, key)
    if key in ("chk_balance_vs_flows", "chk_negative_balance", "chk_closed_with_balance"):
        return _check_balances(tables, key)
    if key in ("chk_op_before_opening", "chk_success_after_close"):
        return _check_operations(tables, key)
    if key in ("chk_txn_vs_operation", "chk_op_without_txn"):
        return _check_pairs(tables, key)
    if key == "chk_transfer_to_closed":
        return _check_transfer_to_closed(tables)
    raise KeyError(key)


def integrity_checks(tables: BankTables) -> DataFrame:
    """All ten checks; checks on the same rows share their pass."""
    parts = [
        _check_accounts(tables, "chk_luhn", "chk_card_duplicates"),
        _check_balances(tables, "chk_balance_vs_flows", "chk_negative_balance", "chk_closed_with_balance"),
        _check_operations(tables, "chk_op_before_opening", "chk_success_after_close"),
        _check_pairs(tables, "chk_txn_vs_operation", "chk_op_without_txn"),
        _check_transfer_to_closed(tables),
    ]
    status = F.when(F.col("failing_rows") == 0, "OK").otherwise("FAILED")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def gate_verdict(tables: BankTables) -> DataFrame:
    """One row: how many checks ran, how many failed, and whether analysis may go on."""
    failures = F.count_if(F.col("failing_rows") > 0)
    return integrity_checks(tables).agg(
        F.count("*").alias("checks"), failures.alias("failed_checks"), (failures == 0).alias("passed")
    )


def quality_gate(tables: BankTables) -> None:
    """Stop the run unless every check passes. Ten rows reach the driver."""
    broken = [row for row in integrity_checks(tables).collect() if row.failing_rows]
    if broken:
        listed = "; ".join(f"{row.check_name}: {row.failing_rows}" for row in broken)
        raise QualityGateError(f"integrity checks failed, results would not be reliable: {listed}")
