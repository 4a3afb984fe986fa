from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.functions.text import ascii_slug, capitalised
from bankpulse.operators.cleaning import customers_clean, rejected_customers
from bankpulse.operators.profiling import crm_profiling
from bankpulse.vocabulary import PROFILE_LABELS


def line(**changes):
    whole = {
        "crm_customer_id": "1", "first_name": "Alice", "last_name": "Martin", "email": "a@example.com",
        "birth_date": "1990-05-06", "city": "Paris", "signup_channel": "web", "updated_at": "2025-01-02 08:00:00",
    }
    return tuple({**whole, **changes}.values())


def cleaned(spark, *lines):
    return {row.customer_id: row for row in customers_clean(spark.createDataFrame(list(lines), schemas.STAGING)).collect()}


def test_names_emails_and_ids(spark):
    row = cleaned(spark, line(crm_customer_id=" 7 ", first_name="  aLICE ", last_name="LE GOFF", email=" A@Example.COM "))[7]
    assert (row.first_name, row.last_name, row.email, row.dq_flags) == ("Alice", "Le goff", "a@example.com", None)


@pytest.mark.parametrize("raw, parsed, flags", [
    ("07/08/1985", date(1985, 8, 7), None),
    ("1985-08-07", date(1985, 8, 7), None),
    ("31/02/1985", None, "IMPLAUSIBLE_BIRTH_DATE"),
    ("1900-01-01", None, "IMPLAUSIBLE_BIRTH_DATE"),
    ("2007-01-03", None, "IMPLAUSIBLE_BIRTH_DATE"),
    ("2007-01-02", date(2007, 1, 2), None),
    ("  ", None, "MISSING_BIRTH_DATE"),
    (None, None, None),
    ("6 mai 1990", None, "IMPLAUSIBLE_BIRTH_DATE"),
])
def test_birth_dates(spark, raw, parsed, flags):
    row = cleaned(spark, line(birth_date=raw))[1]
    assert (row.birth_date, row.dq_flags) == (parsed, flags)


@pytest.mark.parametrize("raw, city", [
    ("St-Etienne", "Saint-Étienne"), ("SAINT ETIENNE ", "Saint-Étienne"), ("saint-étienne", "Saint-Étienne"),
    ("lyon ", "Lyon"), ("saint denis", "Saint denis"), ("", None), (None, None),
])
def test_cities(spark, raw, city):
    row = cleaned(spark, line(city=raw))[1]
    assert row.city == city
    assert row.dq_flags == (None if city else "MISSING_CITY")


def test_flags_are_listed_in_order_and_unknown_email_is_invalid(spark):
    row = cleaned(spark, line(email=None, birth_date="", city=""))[1]
    assert row.dq_flags == "INVALID_EMAIL,MISSING_BIRTH_DATE,MISSING_CITY"


def test_latest_version_wins_and_ties_are_stable(spark):
    lines = [
        line(city="Lyon", updated_at="2025-01-03 00:00:00"), line(city="Paris", updated_at="2025-01-01 00:00:00"),
        line(crm_customer_id="2", city="Nice"), line(crm_customer_id="2", city="Lille"),
    ]
    first, second = cleaned(spark, *lines), cleaned(spark, *reversed(lines))
    assert first[1].city == "Lyon" and first == second


def test_update_moments_ignore_clock_changes_and_bad_text(spark):
    from bankpulse.operators.cleaning import clean_updated_at

    moments = ["1996-03-31 02:31:30", " 2025-01-02 08:00:00 ", "2025-02-31 08:00:00", "2025-01-02"]
    staging = spark.createDataFrame([line(updated_at=text) for text in moments], schemas.STAGING)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        found = [row.crm_updated_at for row in clean_updated_at(staging).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [str(m) for m in found] == ["1996-03-31 02:31:30", "2025-01-02 08:00:00", "None", "None"]


def test_unmapped_channel_is_rejected_not_lost(spark):
    staging = spark.createDataFrame([line(), line(crm_customer_id="2", signup_channel="fax")], schemas.STAGING)
    assert [r.customer_id for r in customers_clean(staging).collect()] == [1]
    assert [r.customer_id for r in rejected_customers(staging).collect()] == [2]


def test_every_unreadable_line_is_returned(spark):
    lines = [line(), line(crm_customer_id="x"), line(crm_customer_id="x"), line(crm_customer_id=""), line(crm_customer_id="3", updated_at="soon"),
             line(updated_at="2020-01-01 00:00:00")]
    staging = spark.createDataFrame(lines, schemas.STAGING)
    accepted, rejected = customers_clean(staging).collect(), rejected_customers(staging).collect()
    assert len(accepted) == 1 and sorted(str(r.customer_id) for r in rejected) == ["3", "None", "None", "None"]


def test_one_customer_with_most_lines_is_combined_before_the_shuffle(spark):
    """Repeated exports of one customer must not travel: partial aggregation comes first."""
    staging = spark.createDataFrame([line()], schemas.STAGING)
    plan = customers_clean(staging)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_profiling_counts(spark, journey):
    found = {row.indicator: row.value for row in crm_profiling(journey.tables(spark)).collect()}
    by_key = {key: found[label] for key, label in PROFILE_LABELS.items()}
    assert by_key == {
        "prof_raw_rows": 4, "prof_distinct_ids": 3, "prof_duplicates": 1, "prof_channel_spellings": 4,
        "prof_fr_dates": 2, "prof_dirty_names": 3, "prof_dirty_emails": 1, "prof_dirty_cities": 4,
        "prof_customers_kept": 3, "prof_invalid_email": 1, "prof_missing_birth": 1, "prof_implausible_birth": 0,
        "prof_missing_city": 1,
    }


def test_small_text_helpers(spark):
    frame = spark.createDataFrame([(" saint denis", "Éloïse D'Arc-42"), (None, None)], "a string, b string")
    rows = frame.select(capitalised(F.col("a")).alias("a"), ascii_slug("b").alias("b")).collect()
    assert [tuple(r) for r in rows] == [("Saint denis", "eloisedarc42"), (None, None)]
