"""CRM export to customers: normalise, validate, keep the latest version, flag problems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse import vocabulary as vocab
from bankpulse.functions.dates import complete_years
from bankpulse.functions.text import capitalised, loosely_in

CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "birth_date",
    "city", "signup_channel", "crm_updated_at", "dq_flags",
]


def customer_id(raw: str = "crm_customer_id") -> Column:
    return F.trim(F.col(raw)).try_cast("bigint")


def normalised_email(raw: str = "email") -> Column:
    return F.lower(F.trim(F.col(raw)))


def parsed_birth_date(raw: str = "birth_date") -> Column:
    """Two accepted spellings; impossible dates become NULL."""
    value = F.trim(F.col(raw))
    return (
        F.when(value.rlike(vocab.ISO_DATE_PATTERN), F.try_to_date(value, "yyyy-MM-dd"))
        .when(value.rlike(vocab.FRENCH_DATE_PATTERN), F.try_to_date(value, "dd/MM/yyyy"))
    )


def updated_at(raw: str = "updated_at") -> Column:
    """Parsed without a time zone: a clock change must not move a CRM timestamp."""
    value = F.trim(F.col(raw))
    return F.when(value.rlike(vocab.MOMENT_PATTERN), value.try_cast("timestamp_ntz"))


def cleaned_city(raw: str = "city") -> Column:
    value = F.trim(F.col(raw))
    return (
        F.when(F.col(raw).isNull() | (value == ""), None)
        .when(loosely_in(value, vocab.SAINT_ETIENNE_ALIASES), vocab.SAINT_ETIENNE)
        .otherwise(capitalised(F.col(raw)))
    )


def mapped_channel(raw: str = "signup_channel") -> Column:
    value = F.lower(F.trim(F.col(raw)))
    mapped = F
    for code, spellings in vocab.CHANNEL_SPELLINGS.items():
        mapped = mapped.when(value.isin(spellings), code)
    return mapped


def normalise(staging: DataFrame) -> DataFrame:
    return staging.select(
        customer_id().alias("customer_id"),
        capitalised(F.col("first_name")).alias("first_name"),
        capitalised(F.col("last_name")).alias("last_name"),
        normalised_email().alias("email_clean"),
        F.trim(F.col("birth_date")).alias("birth_raw"),
        parsed_birth_date().alias("birth_parsed"),
        cleaned_city().alias("city"),
        mapped_channel().alias("signup_channel"),
        updated_at().alias("crm_updated_at"),
    )


def validate(normalised: DataFrame) -> DataFrame:
    """Plausible means parsed, not before 1920, and adult when the line was last updated; not
    if that moment cannot be read."""
    birth = F.col("birth_parsed")
    adult = complete_years(birth, F.col("crm_updated_at")) >= vocab.ADULT_AGE
    return normalised.withColumns({
        "email_is_valid": F.col("email_clean").rlike(vocab.EMAIL_PATTERN),
        "birth_is_plausible": F.coalesce((birth >= F.lit(vocab.EARLIEST_BIRTH).cast("date")) & adult, F.lit(False)),
    })


def latest_versions(validated: DataFrame) -> DataFrame:
    """One row per customer: the most recent, the remaining columns breaking ties. Lines
    without a readable id belong to no customer.

    A grouped maximum combines before the shuffle, so a customer exported millions
    of times costs one row per task, where a window would sort them all in one.
    """
    others = [name for name in validated.columns if name not in ("customer_id", "crm_updated_at")]
    newest = F.max(F.struct("crm_updated_at", *others)).alias("newest")
    return validated.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(newest).select("customer_id", "newest.*")


def _flags() -> Column:
    found = F.concat_ws(
        ",",
        F.when(F.col("email_is_valid"), None).otherwise("INVALID_EMAIL"),
        F.when(F.col("birth_raw") == "", "MISSING_BIRTH_DATE"),
        F.when((F.col("birth_raw") != "") & ~F.col("birth_is_plausible"), "IMPLAUSIBLE_BIRTH_DATE"),
        F.when(F.col("city").isNull(), "MISSING_CITY"),
    )
    return F.nullif(found, F.lit(""))


def _finished(staging: DataFrame) -> DataFrame:
    return _shaped(latest_versions(validate(normalise(staging))))


def _shaped(validated: DataFrame) -> DataFrame:
    return validated.select(
        "customer_id", "first_name", "last_name",
        F.when(F.col("email_is_valid"), F.col("email_clean")).alias("email"),
        F.when(F.col("birth_is_plausible"), F.col("birth_parsed")).alias("birth_date"),
        "city", "signup_channel", "crm_updated_at",
        _flags().alias("dq_flags"),
    )


_ACCEPTED = ["customer_id", "signup_channel", "crm_updated_at"]


def customers_clean(staging: DataFrame) -> DataFrame:
    """The customers table. Rows whose mandatory fields cannot be read are in ``rejected_customers``."""
    return _finished(staging).dropna(subset=_ACCEPTED).select(*CUSTOMER_COLUMNS)


def rejected_customers(staging: DataFrame) -> DataFrame:
    """Every line without a readable id, and the latest line of each customer whose channel or
    moment cannot be read: with the accepted and the superseded lines, all of the export."""
    nameless = _shaped(validate(normalise(staging)).where(F.col("customer_id").isNull()))
    unread = _finished(staging).where(F.col("signup_channel").isNull() | F.col("crm_updated_at").isNull())
    return nameless.unionByName(unread).select(*CUSTOMER_COLUMNS)


# ---------------------------------------------------------------- single rules, line by line
def clean_id(staging: DataFrame) -> DataFrame:
    return staging.select("crm_customer_id", customer_id().alias("customer_id"))


def clean_names(staging: DataFrame) -> DataFrame:
    return staging.select(
        "crm_customer_id",
        capitalised(F.col("first_name")).alias("first_name"),
        capitalised(F.col("last_name")).alias("last_name"),
    )


def clean_email(staging: DataFrame) -> DataFrame:
    clean = normalised_email()
    return staging.select("crm_customer_id", F.when(clean.rlike(vocab.EMAIL_PATTERN), clean).alias("email"))


def clean_birth_date(staging: DataFrame) -> DataFrame:
    return staging.select(
        "crm_customer_id", F.col("birth_date").alias("birth_raw"), parsed_birth_date().alias("birth_date")
    )


def birth_plausibility(staging: DataFrame) -> DataFrame:
    return validate(normalise(staging)).select("customer_id", "birth_parsed", "birth_is_plausible")


def clean_city(staging: DataFrame) -> DataFrame:
    return staging.select("crm_customer_id", F.col("city").alias("city_raw"), cleaned_city().alias("city"))


def clean_channel(staging: DataFrame) -> DataFrame:
    return staging.select(
        "crm_customer_id", F.col("signup_channel").alias("channel_raw"), mapped_channel().alias("signup_channel")
    )


def clean_updated_at(staging: DataFrame) -> DataFrame:
    return staging.select("crm_customer_id", updated_at().alias("crm_updated_at"))


def dedup_latest(staging: DataFrame) -> DataFrame:
    return latest_versions(validate(normalise(staging))).select("customer_id", "email_clean", "city", "crm_updated_at")


def dq_flags(staging: DataFrame) -> DataFrame:
    return _finished(staging).select("customer_id", "dq_flags")
