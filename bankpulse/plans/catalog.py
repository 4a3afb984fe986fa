"""Every operator as a query over the parquet fixture."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankpulse import schemas
from bankpulse.functions.dates import month_of
from bankpulse.functions.text import ascii_slug
from bankpulse.operators import (
    activity, attempts, cleaning, constraints, derived, integrity, ledger, monthly, profiling, rfm, stats,
)
from bankpulse.operators.business import dormancy_watchlist
from bankpulse.operators.measures import DEFAULT_GROUPING, MEASURES, TILES, measure, retention_matrix_tile, tile
from bankpulse.operators.ordering import working_folder
from bankpulse.operators.star import Star
from bankpulse.plans.named import NAMED
from bankpulse.plans.pipeline import register_views
from bankpulse.sources import files, layer
from bankpulse.sources.fixture import PARAMS, ParquetFixture, open_fixture
from bankpulse.streaming.ledger_stream import ledger_replay_stream
from bankpulse.tables import FrameTables
from bankpulse.vocabulary import CHECK_LABELS, PROFILE_LABELS

Query = Callable[[SparkSession, str], DataFrame]
Job = Callable[[ParquetFixture], DataFrame]
_REPLACED, _NEW_MONTHS = date(1997, 3, 1), "1999-01-01"


def _scratch(tables: ParquetFixture) -> str:
    return f"{working_folder(tables.spark)}/files-{uuid.uuid4().hex}"


def _read_back(name: str, frame: DataFrame) -> DataFrame:
    """What a written table holds when it is read again: rows, filled cells, sum of its numbers."""
    numbers = [f.name for f in frame.schema if isinstance(f.dataType, T.NumericType)]
    nothing = F.lit(0).cast("decimal(38,2)")
    total = reduce(Column.__add__, [F.coalesce(F.col(f"`{c}`").cast("decimal(30,2)"), nothing) for c in numbers], nothing)
    filled = reduce(Column.__add__, [F.when(F.col(f"`{c}`").isNotNull(), 1).otherwise(0) for c in frame.columns])
    return frame.agg(
        F.lit(name).alias("table_name"), F.count("*").alias("rows_read"), F.sum(filled).cast("bigint").alias("filled_cells"),
        F.sum(total).cast("decimal(38,2)").alias("numbers"),
    )


def _all_read_back(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_read_back(name, frame) for name, frame in frames.items()])


def _load_operational(t: ParquetFixture) -> DataFrame:
    folder = _scratch(t)
    layer.write_layer(t, folder)
    back = layer.LayerTables(t.spark, folder)
    return _all_read_back({
        "stg_customers_raw": back.staging(), "customers": back.customers(), "accounts": back.accounts(),
        "operation_log": back.operation_log(), "transactions": back.transactions(),
    })


def _sink_star_schema(t: ParquetFixture) -> DataFrame:
    folder = _scratch(t)
    layer.write_star(Star(t, PARAMS), folder)
    return _all_read_back({name: layer.read_star(t.spark, folder, name) for name in schemas.STAR})


# ---------------------------------------------------------------- sources and sinks
def _scan_crm_staging(t: ParquetFixture) -> DataFrame:
    path = _scratch(t)
    files.write_crm_csv(t.staging(), path)
    return files.read_crm_csv(t.spark, path)


def _scan_operational_csv(t: ParquetFixture) -> DataFrame:
    path = _scratch(t)
    files.write_typed_csv(t.operation_log(), path)
    return files.read_typed_csv(t.spark, path, schemas.OPERATION_LOG)


def _scan_mixed_delivery(t: ParquetFixture) -> DataFrame:
    """A delivery of three folders: columns in order, columns reversed, and files with lines
    that lack a field or have an amount that is none. All lines come back, read or rejected."""
    folder = _scratch(t)
    log = t.operation_log()
    columns = log.columns
    bad = F.col("operation_id") % 401 < 3
    files.write_typed_csv(log.where(~bad & (F.col("operation_id") % 2 == 0)), f"{folder}/ordered")
    files.write_typed_csv(log.where(~bad & (F.col("operation_id") % 2 == 1)).select(*reversed(columns)), f"{folder}/reversed")
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}
    short = F.concat_ws(",", *[text[c] for c in columns[:-1]])
    untyped = F.concat_ws(",", *[F.lit("much") if c == "amount_requested" else text[c] for c in columns])
    line = F.when(F.col("operation_id") % 401 == 0, short).otherwise(untyped)
    header = F.when(F.monotonically_increasing_id() % (1 << 33) == 0, ",".join(columns) + "\n").otherwise("")
    damaged = log.where(bad).repartition(4, "operation_id").select(F.concat(header, line).alias("value"))
    damaged.write.text(f"{folder}/damaged")
    paths = [f"{folder}/{part}" for part in ("ordered", "reversed", "damaged")]
    accepted = files.read_typed_csv(t.spark, paths, schemas.OPERATION_LOG).groupBy(F.col("event_type").alias("name")).agg(
        F.count("*").alias("lines"), F.sum("amount_requested").cast("decimal(18,2)").alias("amount"), F.max("created_at").alias("latest")
    )
    rejected = files.rejected_lines(t.spark, paths, schemas.OPERATION_LOG).groupBy(F.col("reason").alias("name")).agg(
        F.count("*").alias("lines"), F.lit(None).cast("decimal(18,2)").alias("amount"), F.lit(None).cast("timestamp_ntz").alias("latest")
    )
    return accepted.select(F.lit("accepted").alias("kind"), "*").union(rejected.select(F.lit("rejected"), "*"))


def _scan_parquet_tables(t: ParquetFixture) -> DataFrame:
    folder = _scratch(t)
    layer.write_layer(t, folder)
    log = layer.LayerTables(t.spark, folder).operation_log(until=PARAMS.period_end)
    return log.groupBy("event_type").agg(F.count("*").alias("operations"))


def _after_delivery(t: ParquetFixture) -> layer.LayerTables:
    """A layer without its last two years and with every other row of a month before, onto which
    these months are then delivered."""
    at, replaced = F.col("created_at"), month_of(F.col("created_at")) == F.lit(_REPLACED)
    delivered = F.coalesce((at >= F.lit(_NEW_MONTHS).cast("timestamp_ntz")) | replaced, F.lit(False))
    shared = {"staging": t.staging(), "accounts": t.accounts_with_balance()}
    logs = {name: getattr(t, name)() for name in layer.LOGS}
    half = replaced & (F.col("operation_id") % 2 == 0)
    folder = _scratch(t)
    layer.write_layer(FrameTables(t.spark, **shared, **{n: log.where(~delivered | half) for n, log in logs.items()}), folder)
    parts = FrameTables(t.spark, **shared, **{n: log.where(delivered) for n, log in logs.items()})
    layer.write_layer(parts, folder, layer.LayerTables(t.spark, folder).run)
    return layer.LayerTables(t.spark, folder)


def _layer_pair_checks(t: ParquetFixture) -> DataFrame:
    """The checks of operations against transactions, from the counts of a layer."""
    folder = _scratch(t)
    layer.write_layer(t, folder)
    tables = layer.LayerTables(t.spark, folder)
    links = constraints.foreign_keys(tables).where("constraint_name = 'fk_txn_operation'").toDF("check_name", "failing_rows")
    return reduce(DataFrame.union, [integrity.integrity_check(tables, key) for key in ("chk_txn_vs_operation", "chk_op_without_txn")] + [links])


def _register_views(t: ParquetFixture) -> DataFrame:
    register_views(t, PARAMS)
    return t.spark.sql(
        "SELECT signup_channel, lifecycle_status, count(*) AS accounts, "
        "CAST(sum(balance_at_period_end) AS DECIMAL(18,2)) AS balance "
        "FROM v_account_activity GROUP BY signup_channel, lifecycle_status"
    )


def _sink_action_list(t: ParquetFixture) -> DataFrame:
    folder = _scratch(t)
    segments = rfm.rfm_segments(t, PARAMS).select(
        "account_id", "segment", "R", "F", "M", "recency_days", "frequency_180d", "card_spend_180d", "balance_at_period_end"
    )
    lists = {"liste_prevention_dormance": dormancy_watchlist(t, PARAMS), "segmentation_rfm": segments}
    for name, frame in lists.items():
        layer.write_csv(frame, folder, name)
    return _all_read_back({
        name: files.read_typed_csv(t.spark, f"{folder}/{name}", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema))
        for name, frame in lists.items()
    })


def _scan_star_schema(t: ParquetFixture) -> DataFrame:
    folder = _scratch(t)
    layer.write_csv(Star(t, PARAMS).fait_operations, folder, "fait_operations")
    return layer.read_star(t.spark, folder, "fait_operations")


SOURCES: dict[str, Job] = {
    "scan_crm_staging": _scan_crm_staging,
    "scan_operational_csv": _scan_operational_csv,
    "scan_mixed_delivery": _scan_mixed_delivery,
    "scan_parquet_tables": _scan_parquet_tables,
    "load_operational": _load_operational,
    "v_account_activity_after_delivery": lambda t: activity.v_account_activity(_after_delivery(t), PARAMS),
    "v_monthly_kpis_after_delivery": lambda t: monthly.v_monthly_kpis(_after_delivery(t), PARAMS),
    "register_views": _register_views,
    "sink_star_schema": _sink_star_schema,
    "sink_action_list": _sink_action_list,
    "scan_star_schema": _scan_star_schema,
}

CLEANING: dict[str, Job] = {
    name: (lambda t, rule=rule: rule(t.staging()))
    for name, rule in {
        "clean_id": cleaning.clean_id,
        "clean_names": cleaning.clean_names,
        "clean_email": cleaning.clean_email,
        "clean_birth_date": cleaning.clean_birth_date,
        "birth_plausibility": cleaning.birth_plausibility,
        "clean_city": cleaning.clean_city,
        "clean_channel": cleaning.clean_channel,
        "clean_updated_at": cleaning.clean_updated_at,
        "dedup_latest": cleaning.dedup_latest,
        "dq_flags": cleaning.dq_flags,
        "customers_clean": cleaning.customers_clean,
        "rejected_customers": cleaning.rejected_customers,
    }.items()
}

PROFILING: dict[str, Job] = {
    key: (lambda t, key=key: profiling.profile_indicator(t, key)) for key in PROFILE_LABELS
}

# these run with the seeded transaction faults
CHECKS: dict[str, Job] = {
    "layer_pair_checks": _layer_pair_checks,
    **{key: (lambda t, key=key: integrity.integrity_check(t, key)) for key in CHECK_LABELS},
    "integrity_checks": integrity.integrity_checks,
    "quality_gate": integrity.gate_verdict,
    "cst_primary_keys": lambda t: constraints.primary_keys(t, PARAMS),
    "cst_unique_keys": constraints.unique_keys,
    "cst_foreign_keys": constraints.foreign_keys,
    "cst_row_checks": constraints.row_checks,
    "cst_txn_direction": constraints.txn_direction,
    "cst_enum_domains": constraints.enum_domains,
}

ANALYSIS: dict[str, Job] = {
    name: (lambda t, job=job: job(t, PARAMS))
    for name, job in {
        "account_ops": activity.account_ops,
        "account_movements": activity.account_movements,
        "account_money": activity.account_money,
        "age_band": activity.age_band,
        "cohort_month": activity.cohort_month,
        "account_delays": activity.account_delays,
        "lifecycle_status": activity.lifecycle_status,
        "v_account_activity": activity.v_account_activity,
        "monthly_ops": monthly.monthly_ops,
        "monthly_money": monthly.monthly_money,
        "v_monthly_kpis": monthly.v_monthly_kpis,
        **{name: job for name, job in NAMED.items() if name != "integrity_checks"},
        "status_shares": derived.status_shares,
        "peak_month": derived.peak_month,
        "last_month": derived.last_month,
        "activation_crosstab": derived.activation_crosstab,
        "chi2_channels": stats.chi2_channels,
        "chi2_mobile_web": stats.chi2_mobile_web,
        "retention_matrix": derived.retention_matrix,
        "retention_mean": derived.retention_mean,
        "concentration_curve": derived.concentration_curve,
        "top_failures": derived.top_failures,
        "segment_profile": rfm.segment_profile,
        "watchlist_summary": derived.watchlist_summary,
        "watchlist_top10": derived.watchlist_top10,
        "essential_share": derived.essential_share,
        "rfm_recency": rfm.rfm_recency,
        "rfm_frequency": rfm.rfm_frequency,
        "rfm_monetary": rfm.rfm_monetary,
        "rfm_high_balance": rfm.rfm_high_balance,
        "rfm_segments": rfm.rfm_segments,
    }.items()
}

STAR: dict[str, Job] = {
    **{name: (lambda t, name=name: getattr(Star(t, PARAMS), name)) for name in schemas.STAR if name != "dim_canal"},
    **{
        f"m_{name}": (lambda t, name=name: measure(Star(t, PARAMS), name, DEFAULT_GROUPING[name])) for name in MEASURES
    },
    **{name: (lambda t, name=name: tile(Star(t, PARAMS), name)) for name in TILES},
    "tile_retention_matrix": lambda t: retention_matrix_tile(Star(t, PARAMS)),
    # the channel slicer every page shares
    "tile_overview_cards_mobile": lambda t: tile(Star(t, PARAMS), "tile_overview_cards", channel="MOBILE"),
}


def _apply_balances(t: ParquetFixture) -> DataFrame:
    at_end = activity.account_money(t, PARAMS).select("account_id", F.col("balance_at_period_end").alias("balance"))
    at_end = t.accounts().select("account_id").join(at_end, "account_id", "left").fillna(0, subset=["balance"])
    later = activity.movements(t.transactions().where(F.col("created_at") > PARAMS.end))
    return ledger.apply_balances(at_end, later)


def _upsert(t: ParquetFixture) -> DataFrame:
    registrations = t.staging().select("first_name", "last_name", "email", F.col("updated_at").alias("arrived_at"))
    return ledger.upsert_by_email(t.customers(), registrations)


OPERATIONS: dict[str, Job] = {
    "luhn_valid": lambda t: attempts.luhn_valid(t.login_attempts()),
    "luhn_check_digit": lambda t: attempts.luhn_check_digit(t.accounts()),
    "classify_logins": lambda t: attempts.classify_logins(t.login_attempts(), t.accounts()),
    "classify_transfers": lambda t: attempts.classify_transfers(t.transfer_attempts(), t.accounts_with_balance()),
    "running_balance": lambda t: ledger.running_balance(t.transactions()),
    "ledger_replay": lambda t: ledger.ledger_replay(t.ledger_attempts()),
    "ledger_replay_stream": lambda t: ledger_replay_stream(t.ledger_attempts(), ["1998-01-01 00:00:00"]),
    "apply_balances": _apply_balances,
    "upsert_customers_by_email": _upsert,
    "renumber_operations": lambda t: ledger.renumber_operations(t.operation_log()),
    "renumber_chronologically": lambda t: ledger.renumber_chronologically(t.operation_log(), t.transactions()),
    "ascii_slug": lambda t: t.staging().select(
        "crm_customer_id", ascii_slug("first_name").alias("name_slug"), ascii_slug("city").alias("city_slug")
    ),
}


def catalog() -> dict[str, Query]:
    def bind(job: Job, defects: bool) -> Query:
        return lambda spark, folder: job(open_fixture(spark, folder, defects))

    groups = [(SOURCES, False), (CLEANING, False), (PROFILING, False), (CHECKS, True),
              (ANALYSIS, False), (STAR, False), (OPERATIONS, False)]
    return {name: bind(job, defects) for jobs, defects in groups for name, job in jobs.items()}
