"""Batch rebuild: files -> staged layer -> quality gate -> published layer -> star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.operators.activity import v_account_activity
from bankpulse.operators.integrity import quality_gate
from bankpulse.operators.monthly import v_monthly_kpis
from bankpulse.operators.ordering import temporary_stages
from bankpulse.operators.star import Star
from bankpulse.params import AnalysisParams
from bankpulse.sources.files import read_crm_csv, read_typed_csv, rejected_crm_lines, rejected_lines
from bankpulse.sources.layer import LayerTables, publish, retire, stage_layer, write_star
from bankpulse.tables import BankTables, FrameTables

STEPS = ("all", "load", "months", "quality", "star")


TYPED = {"accounts": schemas.ACCOUNTS, "operation_log": schemas.OPERATION_LOG, "transactions": schemas.TRANSACTIONS}


def file_tables(spark: SparkSession, folder: str) -> BankTables:
    """The four extract files of a delivery folder."""
    typed = {name: read_typed_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in TYPED.items()}
    return FrameTables(spark, staging=read_crm_csv(spark, f"{folder}/customers_crm_export.csv"), **typed)


def delivery_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """table_name, file, reason, line of the lines of a delivery that cannot be read."""
    rejects = {"stg_customers_raw": rejected_crm_lines(spark, f"{folder}/customers_crm_export.csv")}
    rejects |= {name: rejected_lines(spark, f"{folder}/{name}.csv", schema) for name, schema in TYPED.items()}
    return reduce(DataFrame.union, [r.select(F.lit(name).alias("table_name"), "file", "reason", "line") for name, r in rejects.items()])


def register_views(tables: BankTables, params: AnalysisParams) -> None:
    """Both semantic views, the period and the operational tables for SQL users."""
    views: dict[str, DataFrame] = {
        "v_account_activity": v_account_activity(tables, params),
        "v_monthly_kpis": v_monthly_kpis(tables, params),
        "ref_analysis_period": params.as_view(tables.spark),
        "ref_merchant_categories": tables.categories(),
        "customers": tables.customers(),
        "accounts": tables.accounts(),
        "operation_log": tables.operation_log(),
        "transactions": tables.transactions(),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def run(spark: SparkSession, step: str, delivery: str, layer: str, star: str, params: AnalysisParams) -> dict[str, int]:
    """Run one step or all; returns the rows written per table, rejected lines included.

    A load is written beside the published layer and replaces it only after the gate: a run that
    fails before or at the gate (``QualityGateError``) leaves the layer and the star as they were.
    ``months`` loads a delivery whose logs hold some whole months, onto the published layer.
    """
    if step not in STEPS:
        raise ValueError(f"step must be one of {STEPS}")
    counts: dict[str, int] = {}
    with temporary_stages(spark):
        if step in ("all", "load", "months"):
            onto = LayerTables(spark, layer).run if step == "months" else None
            name, counts = stage_layer(file_tables(spark, delivery), layer, onto)
            rejects = f"{layer}/{name}/rejected_lines"
            delivery_rejects(spark, delivery).write.parquet(rejects)
            counts["rejected_lines"] = spark.read.parquet(rejects).count()
            quality_gate(LayerTables(spark, layer, name))
            publish(spark, layer, name)
            retire(spark, layer)
        tables = LayerTables(spark, layer)
        if step == "quality":
            quality_gate(tables)
        if step in ("all", "star"):
            counts |= write_star(Star(tables, params), star)
    return counts
