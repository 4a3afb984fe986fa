from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from bankpulse.operators.rfm import segment_rfm
from bankpulse.vocabulary import SEGMENTS

SCHEMA = (
    "account_id bigint, recency_days bigint, frequency_180d bigint, card_spend_180d decimal(18,2), "
    "balance_at_period_end decimal(18,2)"
)
ROWS = [
    (1, 0, 200, 5000, 500), (2, 2, 190, 4800, 400), (3, 1, 180, 4600, 300), (4, 3, 170, 4400, 200),
    (5, 45, 5, 50, 20000), (6, 200, 1, 10, 100), (7, 70, 60, 900, 150), (8, 5, 80, 300, 120),
    (9, 4, 2, 20, 50), (10, 6, 90, 700, 90),
]


def base(spark, rows):
    return spark.createDataFrame([(a, r, f, Decimal(m), Decimal(b)) for a, r, f, m, b in rows], SCHEMA)


def test_segments_of_ten_accounts(spark):
    found = {row.account_id: row.segment for row in segment_rfm(base(spark, ROWS)).collect()}
    assert found[1] == "Champions"
    assert found[5] == "Épargnants peu actifs"
    assert found[6] == "Endormis"
    assert found[7] == "À risque"
    assert found[9] == "Occasionnels"
    assert set(found.values()) <= set(SEGMENTS)


def test_never_active_accounts_sleep(spark):
    rows = [*ROWS, (11, None, 0, 0, 10)]
    found = {row.account_id: (row.R, row.segment) for row in segment_rfm(base(spark, rows)).collect()}
    assert found[11] == (1, "Endormis")


@pytest.mark.parametrize("n", [1, 5, 7, 23, 100, 203])
def test_scores_equal_pandas(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, int(rng.integers(0, 200)), int(rng.integers(0, 6)), int(rng.integers(0, 4)) * 10, int(rng.integers(0, 9)) * 7)
            for i in range(1, n + 1)]
    got = {row.account_id: row for row in segment_rfm(base(spark, rows)).collect()}
    frame = pd.DataFrame(rows, columns=["id", "r", "f", "m", "b"])
    if n >= 5:
        for column, name in (("f", "F"), ("m", "M")):
            wanted = pd.qcut(frame[column].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
            assert [got[i][name] for i in frame["id"]] == wanted.tolist()
        high = frame["b"].quantile(0.75)
        for row, f, b in zip(frame.itertuples(), [got[i]["F"] for i in frame["id"]], frame["b"]):
            champion = got[row.id]["R"] >= 4 and f >= 4 and got[row.id]["M"] >= 4
            assert (got[row.id]["segment"] == "Épargnants peu actifs") == (not champion and f <= 2 and b >= high)
    else:
        assert got[1]["F"] == got[1]["M"] == 1
