"""Declared table constraints as violation counts; files enforce none of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse import vocabulary as vocab
from bankpulse.operators.distinct import counts
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables


def _report(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(constraint_name, violations) rows from one aggregation over ``frame``."""
    counts = [F.coalesce(value, F.lit(0)).cast("bigint").alias(f"c{i}") for i, value in enumerate(rules.values())]
    totals = frame.agg(*counts)
    pairs = [F.struct(F.lit(name).alias("constraint_name"), F.col(f"c{i}").alias("violations")) for i, name in enumerate(rules)]
    return totals.select(F.inline(F.array(*pairs)))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def primary_keys(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """Rows beyond the first of a key, and rows without a key."""

    def surplus(frame: DataFrame, name: str, key: str) -> DataFrame:
        return _report(counts(frame, F.col(key)), {name: F.max(F.col("n_rows") - F.col("n_distinct"))})

    return _all([
        surplus(tables.customers(), "pk_customers", "customer_id"),
        surplus(tables.accounts(), "pk_accounts", "account_id"),
        surplus(tables.operation_log(), "pk_operation_log", "operation_id"),
        surplus(tables.transactions(), "pk_transactions", "transaction_id"),
        surplus(tables.categories(), "pk_categories", "category_code"),
        surplus(params.as_view(tables.spark), "pk_analysis_period", "period_id"),
    ])


def unique_keys(tables: BankTables) -> DataFrame:
    """Repeated values; NULL may repeat. Emails compare without case and accents, and are
    exchanged whole: they stand for no number."""
    email = F.collate("email", "UNICODE_CI_AI")

    def repeats(frame: DataFrame, name: str, key: Column) -> DataFrame:
        return _report(counts(frame, key), {name: F.max(F.col("n_values") - F.col("n_distinct"))})

    return _all([
        _report(tables.customers(), {"uq_customers_email": F.count(email) - F.countDistinct(email)}),
        repeats(tables.accounts(), "uq_accounts_card_number", F.col("card_number")),
        repeats(tables.transactions(), "uq_transactions_operation", F.col("operation_id")),
    ])


def foreign_keys(tables: BankTables) -> DataFrame:
    """Rows pointing nowhere. References are counted per value before the anti join,
    so a heavily referenced key is a single row of it."""

    def dangling(name: str, child: DataFrame, column: str, parent: DataFrame, key: str, uses: Column = F.count("*")) -> DataFrame:
        used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("ref")).agg(uses.alias("uses"))
        known = parent.select(F.col(key).alias("ref")).distinct()
        return _report(used.join(known, "ref", "left_anti"), {name: F.sum("uses")})

    accounts, operations, txns = tables.accounts(), tables.operation_log(), tables.transactions()
    return _all([
        dangling("fk_accounts_customer", accounts, "customer_id", tables.customers(), "customer_id"),
        dangling("fk_oplog_account", operations, "account_id", accounts, "account_id"),
        dangling("fk_txn_operation", tables.transaction_keys(), "operation_id", tables.operation_keys(), "operation_id", F.sum("txns")),
        dangling("fk_txn_from_account", txns, "from_account_id", accounts, "account_id"),
        dangling("fk_txn_to_account", txns, "to_account_id", accounts, "account_id"),
        dangling("fk_txn_category", txns, "merchant_category", tables.categories(), "category_code"),
    ])


def row_checks(tables: BankTables) -> DataFrame:
    """Row-level rules; an unknown outcome is not a violation."""
    closed, has_end = F.col("status") == "CLOSED", F.col("closed_at").isNotNull()
    refused, has_reason = F.col("status") == "FAILED", F.col("failure_reason").isNotNull()
    is_card, has_category = F.col("txn_type") == "CARD_PAYMENT", F.col("merchant_category").isNotNull()
    return _all([
        _report(tables.accounts_with_balance(), {
            "chk_accounts_balance_positive": F.count_if(F.col("balance") < 0),
            "chk_accounts_card_format": F.count_if(~F.col("card_number").rlike(vocab.CARD_PATTERN)),
            "chk_accounts_closing": F.count_if(closed != has_end),
        }),
        _report(tables.operation_log(), {"chk_oplog_failure_reason": F.count_if(refused != has_reason)}),
        _report(tables.transactions(), {
            "chk_txn_amount_positive": F.count_if(F.col("amount") <= 0),
            "chk_txn_category": F.count_if(is_card != has_category),
        }),
    ])


def txn_direction(tables: BankTables) -> DataFrame:
    """Which side must be present for each type; a transfer needs two different accounts."""
    kind, source, target = F.col("txn_type"), F.col("from_account_id"), F.col("to_account_id")
    allowed = (
        F.when(kind == "DEPOSIT", source.isNull() & target.isNotNull())
        .when(kind.isin("WITHDRAWAL", "CARD_PAYMENT"), source.isNotNull() & target.isNull())
        .when(kind == "TRANSFER", F.coalesce(source != target, F.lit(False)))
        .otherwise(F.lit(False))
    )
    return tables.transactions().groupBy("txn_type").agg(
        F.count("*").alias("transactions"), F.count_if(~allowed).alias("violations")
    )


def single_period_row(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """The period table has one row, numbered 1."""
    view = params.as_view(tables.spark)
    return _report(view, {"chk_period_single_row": F.count_if(F.col("period_id") != 1)})


def enum_domains(tables: BankTables) -> DataFrame:
    """Values outside the declared lists."""

    def outside(column: str, domain: list[str]) -> Column:
        return F.count_if(~F.col(column).isin(domain))

    return _all([
        _report(tables.customers(), {"customers.signup_channel": outside("signup_channel", vocab.SIGNUP_CHANNELS)}),
        _report(tables.accounts(), {"accounts.status": outside("status", vocab.ACCOUNT_STATUSES)}),
        _report(tables.operation_log(), {
            "operation_log.event_type": outside("event_type", vocab.EVENT_TYPES),
            "operation_log.status": outside("status", vocab.OPERATION_STATUSES),
            "operation_log.failure_reason": outside("failure_reason", vocab.FAILURE_REASONS),
            "operation_log.channel": outside("channel", vocab.OPERATION_CHANNELS),
        }),
        _report(tables.transactions(), {"transactions.txn_type": outside("txn_type", vocab.TXN_TYPES)}),
    ])
