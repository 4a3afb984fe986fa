from __future__ import annotations

import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bankpulse import AnalysisParams, FrameTables, schemas  # noqa: E402
from bankpulse.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
CARDS = ("4000003972196501", "4000004938320896", "4000007916053702")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def params():
    return AnalysisParams(datetime(2025, 1, 1), datetime(2025, 12, 31, 23, 59, 59), 90)


def at(day: str, time: str = "10:00:00") -> datetime:
    return datetime.fromisoformat(f"{day} {time}")


def euros(text: str) -> Decimal:
    return Decimal(text)


class Journey:
    """Three accounts: one funded and active, one that received and closed, one never used."""

    staging = [
        ("101", "alice", "MARTIN", "ALICE@EXAMPLE.COM", "1990-05-06", "paris", "Mobile", "2025-01-02 08:00:00"),
        (" 102", " bob  ", "durand", "bob at example.com", "07/08/1985", "St-Etienne", "site web", "2025-01-02 08:00:00"),
        ("102", "Bob", "Durand", "bob.old@example.com", "07/08/1985", "Lyon", "web", "2024-01-02 08:00:00"),
        ("103", "carla", "petit", "carla@example.com", "", "", "PARTENAIRE", "2025-01-03 08:00:00"),
    ]

    def __init__(self) -> None:
        opened = at("2025-01-05")
        self.accounts = [
            (1, 101, CARDS[0], "x", euros("150.00"), "ACTIVE", opened, None),
            (2, 102, CARDS[1], "x", euros("0.00"), "CLOSED", opened, at("2025-12-20", "10:00:05")),
            (3, 103, CARDS[2], "x", euros("0.00"), "ACTIVE", opened, None),
        ]
        self.operations = [
            (1, 1, "CREATE_ACCOUNT", "SUCCESS", None, "APP", None, opened),
            (2, 2, "CREATE_ACCOUNT", "SUCCESS", None, "APP", None, opened),
            (3, 3, "CREATE_ACCOUNT", "SUCCESS", None, "APP", None, opened),
            (4, 1, "LOGIN", "FAILED", "WRONG_PIN", "APP", None, at("2025-12-01")),
            (5, 1, "DEPOSIT", "SUCCESS", None, "APP", euros("250.00"), at("2025-12-01", "10:01:00")),
            (6, 1, "TRANSFER", "SUCCESS", None, "APP", euros("100.00"), at("2025-12-01", "10:02:00")),
            (7, 1, "TRANSFER", "FAILED", "INSUFFICIENT_FUNDS", "APP", euros("500.00"), at("2025-12-01", "10:03:00")),
            (8, 2, "WITHDRAWAL", "SUCCESS", None, "APP", euros("100.00"), at("2025-12-20")),
            (9, 2, "CLOSE_ACCOUNT", "SUCCESS", None, "APP", None, at("2025-12-20", "10:00:05")),
            (10, 1, "TRANSFER", "FAILED", "ACCOUNT_CLOSED", "APP", euros("10.00"), at("2025-12-21")),
        ]
        self.transactions = [
            (1, 5, "DEPOSIT", None, 1, euros("250.00"), None, at("2025-12-01", "10:01:00")),
            (2, 6, "TRANSFER", 1, 2, euros("100.00"), None, at("2025-12-01", "10:02:00")),
            (3, 8, "WITHDRAWAL", 2, None, euros("100.00"), None, at("2025-12-20")),
        ]

    def tables(self, spark) -> FrameTables:
        return FrameTables(
            spark,
            staging=spark.createDataFrame(self.staging, schemas.STAGING),
            accounts=spark.createDataFrame(self.accounts, schemas.ACCOUNTS),
            operation_log=spark.createDataFrame(self.operations, schemas.OPERATION_LOG),
            transactions=spark.createDataFrame(self.transactions, schemas.TRANSACTIONS),
        )


@pytest.fixture
def journey() -> Journey:
    return Journey()
