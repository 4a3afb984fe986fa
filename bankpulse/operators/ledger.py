"""Balances over time: running sums, sequential replay, posting and renumbering."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.numbers import MONEY, money
from bankpulse.operators.activity import movements
from bankpulse.operators.ordering import in_pieces, numbered, running_totals, written

REPLAY_SCHEMA = "operation_id bigint, account_id bigint, created_at timestamp_ntz, reason string, balance_cents bigint"
#: Attempts that one task replays in some seconds; a longer account is cut over several tasks.
LONG_ACCOUNT = 1 << 20
OUTCOME_SCHEMA = "account_id bigint, part bigint, net bigint, low bigint, high bigint"


def running_balance(transactions: DataFrame) -> DataFrame:
    """Balance of each account after each of its movements, in (created_at, operation_id) order.

    An account of any size is cut by a range shuffle; each piece continues from the sum of the
    pieces before it.
    """
    legs = movements(transactions).select(
        "account_id", "created_at", "operation_id",
        (F.col("amount_in") - F.col("amount_out")).cast("decimal(22,2)").alias("delta"),
    )
    order = [F.col("created_at"), F.col("operation_id"), F.col("delta")]
    return running_totals(legs, "account_id", order, "delta", "balance_after").select(
        "account_id", "operation_id", "created_at",
        F.col("delta").cast(MONEY).alias("delta"), F.col("balance_after").cast(MONEY).alias("balance_after"),
    )


def decide(balance: int, credit: bool, amount: int) -> tuple[str, int]:
    """Failure reason ('' when accepted) and the balance afterwards, in cents."""
    if amount <= 0:
        return "INVALID_AMOUNT", balance
    if credit:
        return "", balance + amount
    if amount > balance:
        return "INSUFFICIENT_FUNDS", balance
    return "", balance - amount


def replay_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A partition holds whole chunks (account, piece) in order; the balance is carried from batch
    to batch, and a chunk begins with its ``start_cents``."""
    chunk, balance = None, 0
    for rows in batches:
        reasons, balances = [], []
        columns = (rows[name].tolist() for name in ("account_id", "_part", "is_credit", "amount_cents", "start_cents"))
        for account, part, credit, amount, start in zip(*columns):
            if (account, part) != chunk:
                chunk, balance = (account, part), start
            reason, balance = decide(balance, credit, amount)
            reasons.append(reason)
            balances.append(balance)
        yield rows[["operation_id", "account_id", "created_at"]].assign(reason=reasons, balance_cents=balances)


class Outcome(NamedTuple):
    """What a chunk makes of an opening balance. Every opening from ``low`` to below ``high`` meets
    the same decisions and changes by ``net`` as well; None is no limit."""

    account_id: int
    part: int
    net: int
    low: int | None
    high: int | None

    def holds(self, opening: int) -> bool:
        return (self.low is None or opening >= self.low) and (self.high is None or opening < self.high)


def outcome_of(key: tuple[int, int], opening: int, attempts: Iterable[tuple[bool, int]]) -> Outcome:
    """Replay (is_credit, cents) from an opening and see how far it could be moved: down by the least
    that an accepted debit left, up to below the least that a refused one lacked."""
    balance, low, high = opening, None, None
    for credit, amount in attempts:
        if amount > 0 and not credit:
            edge = opening + amount - balance
            if amount <= balance:
                low = edge if low is None else max(low, edge)
            else:
                high = edge if high is None else min(high, edge)
        balance = decide(balance, credit, amount)[1]
    return Outcome(*key, balance - opening, low, high)


def chunk_outcomes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """An ``Outcome`` per chunk; rows are streamed."""
    names = ("account_id", "_part", "start_cents", "is_credit", "amount_cents")
    rows = (row for batch in batches for row in zip(*(batch[name].tolist() for name in names)))
    for (account, part, start), chunk in groupby(rows, key=lambda row: row[:3]):
        found = outcome_of((account, part), start, (row[3:] for row in chunk))
        yield pd.DataFrame([found], columns=Outcome._fields).astype({"low": "Int64", "high": "Int64"})


def walk(chunks: list[tuple[int, int]], known: dict[tuple[int, int], list[Outcome]]) -> tuple[dict, set]:
    """Opening balance per chunk of accounts, in order, and the chunks that must be replayed from it.

    An opening is right as long as the chunks before it have an outcome that holds for theirs;
    behind the first other chunk it is an estimate with the latest outcome.
    """
    openings, pending = {}, set()
    holder, balance = None, 0
    for key in chunks:
        if key[0] != holder:
            holder, balance = key[0], 0
        openings[key] = balance
        outcomes = known.get(key, [])
        fit = next((o for o in outcomes if o.holds(balance)), None)
        if fit is None:
            pending.add(key)
        latest = fit or (outcomes[-1] if outcomes else None)
        balance = max(0, balance + (latest.net if latest else 0))
    return openings, pending


def replay_input(attempts: DataFrame) -> DataFrame:
    """Attempts as credits and debits; a received transfer was decided by its sender."""
    return attempts.select(
        "operation_id", "account_id", "created_at",
        F.col("event_type").isin("DEPOSIT", "TRANSFER_IN").alias("is_credit"),
        F.coalesce((F.col("amount") * 100).cast("bigint"), F.lit(0)).alias("amount_cents"),
    )


def replay_output(replayed: DataFrame) -> DataFrame:
    return replayed.select(
        "operation_id", "account_id",
        F.when(F.col("reason") == "", "SUCCESS").otherwise("FAILED").alias("status"),
        F.nullif("reason", F.lit("")).alias("failure_reason"),
        (F.col("balance_cents") * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY).alias("balance_after"),
    )


def _chunk_rows(rows: DataFrame, starts: dict[tuple[int, int], int]) -> DataFrame:
    """The rows of pieces with ``start_cents`` of their chunk, zero where none is given, in order."""
    listed = rows.sparkSession.createDataFrame([(*key, cents) for key, cents in starts.items()], "account_id bigint, _part bigint, start_cents bigint")
    opened = rows.join(F.broadcast(listed), ["account_id", "_part"], "left").withColumn("start_cents", F.coalesce("start_cents", F.lit(0).cast("bigint")))
    return opened.repartition("account_id", "_part").sortWithinPartitions("account_id", "_part", "_local")


def opening_balances(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Opening balance of every chunk of the accounts that lie in several pieces.

    A piece shares at most its first and its last account with others, so there are at most two
    such chunks per piece, and only they go through the driver. Each round replays, in parallel, the
    chunks without an outcome for their opening; the first of an account is right by then, so
    an account ends after at most as many rounds as it has chunks, as a rule after two or three.
    """
    pieces = rows.groupBy("_part").agg(F.min("account_id").alias("first"), F.max("account_id").alias("last")).collect()
    shared: dict[int, list[int]] = {}
    for piece in sorted(pieces, key=lambda p: p["_part"]):
        for account in sorted({piece["first"], piece["last"]}):
            shared.setdefault(account, []).append(piece["_part"])
    chunks = [(account, part) for account, parts in sorted(shared.items()) if len(parts) > 1 for part in parts]
    known: dict[tuple[int, int], list[Outcome]] = {}
    openings, pending = walk(chunks, known)
    while pending:
        asked = {key: openings[key] for key in pending}
        accounts, parts = (sorted({key[i] for key in pending}) for i in (0, 1))
        # the pieces are in files of their own, so others are skipped
        some = rows.where(F.col("_part").isin(parts) & F.col("account_id").isin(accounts))
        listed = rows.sparkSession.createDataFrame(list(asked), "account_id bigint, _part bigint")
        some = some.join(F.broadcast(listed), ["account_id", "_part"], "left_semi")
        for row in _chunk_rows(some, asked).mapInPandas(chunk_outcomes, OUTCOME_SCHEMA).collect():
            known.setdefault((row.account_id, row.part), []).append(Outcome(*row))
        openings, pending = walk(chunks, known)
    return openings


def _whole_accounts(rows: DataFrame) -> DataFrame:
    """Each account as one chunk of a task, in order, from zero."""
    nothing = F.lit(0).cast("bigint")
    in_order = rows.repartition("account_id").sortWithinPartitions("account_id", "created_at", "operation_id")
    return in_order.withColumns({"_part": nothing, "start_cents": nothing})


def ledger_replay(attempts: DataFrame, long_account: int = LONG_ACCOUNT) -> DataFrame:
    """Accept or reject credits and debits one after the other, per account from zero.

    Whether a debit passes depends on everything accepted before it. Accounts run in parallel. Those
    with more than ``long_account`` attempts are cut into pieces by (account, moment, operation):
    the opening balances of their chunks are found first (``opening_balances``), then the chunks
    run in parallel too. Rows are sorted outside memory where needed and streamed through a task
    batch by batch. A missing amount is invalid.
    """
    rows = replay_input(attempts)
    per_account = rows.groupBy("account_id").agg(F.count("*").alias("n"))
    long = written(per_account.where(F.col("n") > long_account).select("account_id"))
    if long.isEmpty():
        return replay_output(_whole_accounts(rows).mapInPandas(replay_chunks, REPLAY_SCHEMA))
    pieces = in_pieces(rows.join(long, "account_id", "left_semi"), "account_id", "created_at", "operation_id")
    cut = _chunk_rows(pieces, opening_balances(pieces)).mapInPandas(replay_chunks, REPLAY_SCHEMA)
    whole = _whole_accounts(rows.join(long, "account_id", "left_anti")).mapInPandas(replay_chunks, REPLAY_SCHEMA)
    return replay_output(whole.unionByName(cut))


def apply_balances(balances: DataFrame, legs: DataFrame) -> DataFrame:
    """Post signed movements onto balances; accounts without movements keep theirs."""
    posted = legs.groupBy("account_id").agg(F.sum(F.col("amount_in") - F.col("amount_out")).alias("delta"))
    return balances.join(posted, "account_id", "left").select(
        "account_id",
        F.col("balance").cast(MONEY).alias("opening_balance"),
        money(F.col("delta")).alias("delta"),
        money(F.col("balance") + F.coalesce("delta", F.lit(0))).alias("balance"),
    )


def upsert_by_email(customers: DataFrame, incoming: DataFrame) -> DataFrame:
    """Customers plus one new customer per unknown normalised email, in email order.

    ``incoming``: first_name, last_name, email and anything that orders repeated
    registrations in ``arrived_at``; the earliest registration of an email counts.
    """
    known = customers.where(F.col("email").isNotNull()).select("email").distinct()
    email = F.lower(F.trim("email"))
    first = (
        incoming.where(F.col("email").isNotNull())
        .groupBy(email.alias("email"))
        .agg(F.min(F.struct("arrived_at", _titled("first_name").alias("first_name"),
                            _titled("last_name").alias("last_name"))).alias("entry"))
        .join(known, "email", "left_anti")
        .select("email", "entry.first_name", "entry.last_name")
    )
    highest = customers.agg(F.coalesce(F.max("customer_id"), F.lit(0))).scalar()
    added = numbered(first, F.col("email")).select(
        (highest + F.col("rn")).alias("customer_id"), "first_name", "last_name", "email",
        F.lit("WEB").alias("signup_channel"), F.lit(True).alias("is_new"),
    )
    kept = customers.select(
        "customer_id", "first_name", "last_name", "email", "signup_channel", F.lit(False).alias("is_new")
    )
    return kept.unionByName(added)


def _titled(name: str):
    """Every run of letters starts upper case: 'jean-paul' becomes 'Jean-Paul'."""
    words = F.split(F.lower(F.trim(name)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def renumber_operations(operations: DataFrame) -> DataFrame:
    """The whole operation log with dense ids by (created_at, operation_id)."""
    order = [F.col("created_at"), F.col("operation_id")]
    return numbered(operations, *order, name="new_operation_id").drop("n_rows")


def renumber_chronologically(operations: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions with dense ids in the order of their renumbered operations; a transaction
    without an operation comes last and keeps no operation number."""
    keys = operations.select("operation_id", "created_at")
    renumbered = renumber_operations(keys).select("operation_id", "new_operation_id")
    linked = transactions.select("transaction_id", "operation_id", "txn_type", "amount").join(renumbered, "operation_id", "left")
    order = [F.col("new_operation_id").asc_nulls_last(), F.col("operation_id"), F.col("transaction_id")]
    return numbered(linked, *order, name="new_transaction_id").drop("n_rows", "transaction_id")
