"""The ledger replay as a stream on Spark's keyed state.

Accounts share keys of the state, ``BUCKETS`` in all, because every call for a key costs
milliseconds. A bucket keeps the balances of its accounts as one value and its attempts in packed
blocks of a list until the watermark has passed their moment; they are then decided per account in
order of moment and id, as in the batch replay. Each micro-batch touches only the buckets that have
new or due attempts. An attempt that arrives behind the watermark is not decided any more:
``late_attempts`` lists those.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from bankpulse.operators.ledger import decide, replay_input, replay_output
from bankpulse.operators.ordering import working_folder, written

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Event time of attempts without a moment: they are decided first, and have to arrive first.
UNKNOWN_MOMENT = 1000
#: Keys of the state. A checkpoint holds for the number it was made with.
BUCKETS = 1 << 12
#: An attempt as it waits: nulls are zeros without their flag.
_WAITING = np.dtype([("due", "i8"), ("micros", "i8"), ("operation_id", "i8"), ("account_id", "i8"), ("amount_cents", "i8"), ("flags", "i1")])
_CREDIT, _KNOWN = 1, {"operation_id": 2, "account_id": 4, "micros": 8}
_BALANCE = np.dtype([("account_id", "i8"), ("known", "?"), ("cents", "i8")])
_YIELDED = 1 << 16


def micros_of(moment: Column) -> Column:
    """The zone-less moment in microseconds, as if it were UTC: the same in any session time zone."""
    minutes = F.unix_date(moment.cast("date")).cast("long") * 1440 + F.hour(moment) * 60 + F.minute(moment)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("long")


def event_time(micros: Column) -> Column:
    """In milliseconds."""
    return F.greatest(F.coalesce(F.call_function("div", micros, F.lit(1000)), F.lit(UNKNOWN_MOMENT)), F.lit(UNKNOWN_MOMENT)).cast("long")


class Ledger(StatefulProcessor):
    """Decides the attempts of the accounts of a bucket up to the watermark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.balances = handle.getValueState("balances", "packed binary")
        self.waiting = handle.getListState("waiting", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for batch in rows:
            block = np.empty(len(batch), _WAITING)
            for name in block.dtype.names:
                block[name] = batch[name]
            if len(block):
                self.waiting.appendValue((block.tobytes(),))
                first = block["due"].min() if first is None else min(first, block["due"].min())
        if first is not None:
            self.handle.registerTimer(int(first) - 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        blocks = [np.frombuffer(packed, _WAITING) for (packed,) in self.waiting.get()]
        held = np.concatenate(blocks) if blocks else np.empty(0, _WAITING)
        rest = held[held["due"] > passed]
        if len(rest) == len(held):
            return
        if len(rest):
            self.waiting.put([(rest.tobytes(),)])
            self.handle.registerTimer(int(rest["due"].min()) - 1)
        else:
            self.waiting.clear()
        ready = held[held["due"] <= passed]
        known = {name: (ready["flags"] & bit) > 0 for name, bit in _KNOWN.items()}
        # what is missing sorts first
        order = np.lexsort([by for name in ("operation_id", "micros", "account_id") for by in (ready[name], known[name])])
        ready, known = ready[order], {name: there[order] for name, there in known.items()}
        balances = self._balances()
        accounts = _cells(ready["account_id"], known["account_id"])
        reasons, after = [], []
        for account, credit, amount in zip(accounts, ((ready["flags"] & _CREDIT) > 0).tolist(), ready["amount_cents"].tolist(), strict=True):
            reason, balance = decide(balances.get(account, 0), credit, amount)
            balances[account] = balance
            reasons.append(reason)
            after.append(balance)
        self._keep(balances)
        decided = pd.DataFrame({name: _nullable(ready[name], known[name]) for name in ("operation_id", "account_id", "micros")})
        decided = decided.assign(reason=reasons, balance_cents=after)
        for begin in range(0, len(decided), _YIELDED):
            yield decided.iloc[begin:begin + _YIELDED]

    def _balances(self) -> dict[int | None, int]:
        if not self.balances.exists():
            return {}
        kept = np.frombuffer(self.balances.get()[0], _BALANCE)
        return dict(zip(_cells(kept["account_id"], kept["known"]), kept["cents"].tolist(), strict=True))

    def _keep(self, balances: dict[int | None, int]) -> None:
        rows = [(account or 0, account is not None, cents) for account, cents in balances.items()]
        self.balances.update((np.array(rows, _BALANCE).tobytes(),))

    def close(self) -> None:
        pass


def _cells(values: np.ndarray, known: np.ndarray) -> list[int | None]:
    return values.tolist() if known.all() else [v if k else None for v, k in zip(values.tolist(), known.tolist(), strict=True)]


def _nullable(values: np.ndarray, known: np.ndarray) -> pd.api.extensions.ExtensionArray:
    return pd.arrays.IntegerArray(values.copy(), ~known)


DECIDED = "operation_id bigint, account_id bigint, micros bigint, reason string, balance_cents bigint"


def decisions(attempts: DataFrame, lateness: str = "0 seconds") -> DataFrame:
    """Decisions (``DECIDED``) on a stream of rows shaped like ``replay_input``."""
    micros = micros_of(F.col("created_at"))
    due = event_time(micros)
    values = {"operation_id": F.col("operation_id"), "account_id": F.col("account_id"), "micros": micros}
    flags = F.coalesce(F.col("is_credit"), F.lit(False)).cast("int") * _CREDIT
    for name, bit in _KNOWN.items():
        flags = flags + values[name].isNotNull().cast("int") * bit
    rows = attempts.select(
        F.pmod(F.xxhash64("account_id"), F.lit(BUCKETS)).cast("int").alias("bucket"),
        *[F.coalesce(value, F.lit(0)).cast("bigint").alias(name) for name, value in values.items()],
        "amount_cents", flags.cast("tinyint").alias("flags"), due.alias("due"), F.timestamp_millis(due).alias("at"),
    )
    return rows.withWatermark("at", lateness).groupBy("bucket").transformWithStateInPandas(
        Ledger(), DECIDED, outputMode="Append", timeMode="EventTime"
    )


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which Spark checkpoints."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def start(attempts: DataFrame, root: str, lateness: str = "0 seconds") -> StreamingQuery:
    """Decide a stream of ``replay_input`` rows into ``root/decided``; ends when all that is
    there is read, and goes on from there when started again."""
    with keyed_state(attempts.sparkSession):
        return (
            decisions(attempts, lateness).writeStream.format("parquet").outputMode("append")
            .option("path", f"{root}/decided").option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True).start()
        )


def decided(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.schema(DECIDED).parquet(f"{root}/decided")
    since = F.expr("make_dt_interval(0, 0, 0, cast(micros as decimal(18,0)) * 0.000001)")
    moment = (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since).alias("created_at")
    return rows.select("operation_id", "account_id", moment, "reason", "balance_cents")


def late_attempts(spark: SparkSession, root: str) -> DataFrame:
    """What arrived in ``root/input`` behind the watermark and was therefore not decided."""
    return spark.read.parquet(f"{root}/input").join(decided(spark, root), ["operation_id", "account_id"], "left_anti")


def feed(attempts: DataFrame, arrivals: list[Column], root: str) -> None:
    """Append the attempts (``replay_input`` rows) of each condition in turn to ``root/input``
    and drain it; state carries over from one run to the next as in continuous operation."""
    spark = attempts.sparkSession
    for arrival in arrivals:
        attempts.where(arrival).write.mode("append").parquet(f"{root}/input")
        start(spark.readStream.schema(attempts.schema).parquet(f"{root}/input"), root).awaitTermination()


def ledger_replay_stream(attempts: DataFrame, cuts: list[str]) -> DataFrame:
    """Feed a batch of attempts through the stream in consecutive arrivals; ``cuts`` are the
    moments between them. Attempts without a moment come with the first."""
    spark = attempts.sparkSession
    root = f"{working_folder(spark)}/ledger-{uuid.uuid4().hex}"
    moment = F.col("created_at")
    edges = [None, *[F.lit(cut).cast("timestamp_ntz") for cut in cuts], None]
    arrivals = []
    for begin, end in zip(edges, edges[1:]):
        after = F.lit(True) if begin is None else moment >= begin
        before = F.lit(True) if end is None else moment < end
        arrivals.append((after & before) | moment.isNull() if begin is None else after & before)
    feed(written(replay_input(attempts)), arrivals, root)
    return replay_output(decided(spark, root))
