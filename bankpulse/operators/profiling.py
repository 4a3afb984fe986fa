"""What cleaning found in the CRM export: thirteen indicators; ids are counted on a scan of their own column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse.functions.text import capitalised
from bankpulse.operators.distinct import counts
from bankpulse.tables import BankTables
from bankpulse.vocabulary import PROFILE_LABELS


def _staging_indicators() -> dict[str, Column]:
    name_differs = [F.col(name) != capitalised(F.col(name)) for name in ("first_name", "last_name")]
    return {
        "prof_raw_rows": F.count("*"),
        "prof_channel_spellings": F.countDistinct("signup_channel"),
        "prof_fr_dates": F.count_if(F.trim("birth_date").rlike("^[0-9]{2}/")),
        "prof_dirty_names": F.count_if(name_differs[0] | name_differs[1]),
        "prof_dirty_emails": F.count_if(F.col("email") != F.lower(F.trim("email"))),
    }


def _id_indicators() -> dict[str, Column]:
    """Of the counted ids."""
    return {"prof_distinct_ids": F.max("n_distinct"), "prof_duplicates": F.max(F.col("n_rows") - F.col("n_distinct"))}


def _counted_ids(tables: BankTables) -> DataFrame:
    return counts(tables.staging(), F.trim("crm_customer_id"))


def _customer_indicators() -> dict[str, Column]:
    flags = F.col("dq_flags")
    return {
        "prof_customers_kept": F.count("*"),
        "prof_invalid_email": F.count_if(flags.contains("INVALID_EMAIL")),
        "prof_missing_birth": F.count_if(flags.contains("MISSING_BIRTH_DATE")),
        "prof_implausible_birth": F.count_if(flags.contains("IMPLAUSIBLE_BIRTH_DATE")),
        "prof_missing_city": F.count_if(flags.contains("MISSING_CITY")),
    }


def _as_rows(frame: DataFrame, indicators: dict[str, Column]) -> DataFrame:
    """One aggregation, then one row per indicator."""
    totals = frame.agg(*[value.cast("bigint").alias(key) for key, value in indicators.items()])
    pairs = ", ".join(f"struct({i} as position, `{key}` as value)" for i, key in enumerate(indicators))
    rows = totals.select(F.expr(f"inline(array({pairs}))"))
    labels = F.array(*[F.lit(PROFILE_LABELS[key]) for key in indicators])
    return rows.select(
        F.element_at(labels, F.col("position") + 1).alias("indicator"), F.coalesce("value", F.lit(0)).alias("value")
    )


def _dirty_cities(tables: BankTables) -> DataFrame:
    """Lines whose raw city is not spelled like any cleaned city. Spellings are
    counted before the join, so a frequent city is one row of it."""
    spelled = tables.staging().where(F.col("city").isNotNull()).groupBy("city").agg(F.count("*").alias("lines"))
    clean = tables.customers().where(F.col("city").isNotNull()).select("city").distinct()
    dirty = spelled.join(clean.withColumn("known", F.lit(True)), "city", "left")
    value = F.coalesce(F.sum(F.when(F.col("known").isNull() | (F.col("city") == ""), F.col("lines"))), F.lit(0))
    return dirty.agg(value.alias("value")).select(F.lit(PROFILE_LABELS["prof_dirty_cities"]).alias("indicator"), "value")


def profile_indicator(tables: BankTables, key: str) -> DataFrame:
    """A single indicator; only its own columns are read."""
    if key == "prof_dirty_cities":
        return _dirty_cities(tables)
    if key in _id_indicators():
        return _as_rows(_counted_ids(tables), {key: _id_indicators()[key]})
    from_staging = _staging_indicators()
    if key in from_staging:
        return _as_rows(tables.staging(), {key: from_staging[key]})
    return _as_rows(tables.customers(), {key: _customer_indicators()[key]})


def crm_profiling(tables: BankTables) -> DataFrame:
    parts = [
        _as_rows(tables.staging(), _staging_indicators()),
        _as_rows(_counted_ids(tables), _id_indicators()),
        _dirty_cities(tables),
        _as_rows(tables.customers(), _customer_indicators()),
    ]
    return reduce(DataFrame.unionByName, parts)
