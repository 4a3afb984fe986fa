"""Predicates on the operation log, each written once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankpulse.vocabulary import TXN_TYPES


def succeeded() -> Column:
    return F.col("status") == "SUCCESS"


def failed() -> Column:
    return F.col("status") == "FAILED"


def is_event(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def moves_money() -> Column:
    return is_event(*TXN_TYPES)


def customer_activity() -> Column:
    """A successful operation the customer started. Salary transfers fund an
    account but are not activity, and neither is opening it."""
    return succeeded() & F.col("channel").isin("APP", "CARD_NETWORK") & ~is_event("CREATE_ACCOUNT")


def app_attempt() -> Column:
    return (F.col("channel") == "APP") & is_event("LOGIN", "DEPOSIT", "WITHDRAWAL", "TRANSFER")
