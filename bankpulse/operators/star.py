"""Star schema for dashboards: four fact tables and three dimensions."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankpulse import vocabulary as vocab
from bankpulse.functions.activity import customer_activity, failed, is_event, succeeded
from bankpulse.functions.dates import month_of
from bankpulse.functions.numbers import MONEY, money
from bankpulse.functions.text import labelled
from bankpulse.operators.activity import account_measures
from bankpulse.operators.business import ELIGIBLE_DAYS, cohort_cells, funded_open, month_words
from bankpulse.operators.ordering import written
from bankpulse.operators.rfm import cut_points, with_scores
from bankpulse.params import AnalysisParams
from bankpulse.tables import BankTables


def _within(days: int) -> Column:
    return F.coalesce(F.col("days_to_first_deposit") <= days, F.lit(False))


def account_dimension(tables: BankTables, params: AnalysisParams) -> DataFrame:
    return _dimension(account_measures(tables, params), params)


def _dimension(measures: DataFrame, params: AnalysisParams, *more: str) -> DataFrame:
    return measures.select(
        "account_id", "customer_id", "signup_channel", "age_band",
        F.coalesce("city", F.lit(vocab.UNKNOWN_CITY)).alias("city"),
        "cohort_month",
        F.col("opened_at").cast("date").alias("opened_date"),
        "lifecycle_status", "days_to_first_deposit",
        _within(7).alias("funded_within_7_days"),
        _within(30).alias("funded_within_30_days"),
        (F.col("opened_at") <= params.end_minus(ELIGIBLE_DAYS)).alias("activation_eligible"),
        "days_since_last_activity", "balance_at_period_end", "card_spend", "card_payments", "declined_card_payments",
        *more,
    )


def operation_rows(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """What facts need of each logged operation; ``attempts`` is 1."""
    return tables.operation_log(until=params.period_end).select(
        "account_id", month_of(F.col("created_at")).alias("month_start"), "event_type", "status",
        F.coalesce("failure_reason", F.lit("NONE")).alias("failure_reason"), F.coalesce(customer_activity(), F.lit(False)).alias("active"),
        F.lit(1).cast("bigint").alias("attempts"), F.col("amount_requested").alias("amount"),
    )


def money_rows(tables: BankTables, params: AnalysisParams) -> DataFrame:
    """What facts need of each card payment and deposit; ``payments`` is 1."""
    spent = F.col("txn_type") == "CARD_PAYMENT"
    return tables.transactions(until=params.period_end).where(spent | (F.col("txn_type") == "DEPOSIT")).select(
        F.when(spent, F.col("from_account_id")).otherwise(F.col("to_account_id")).alias("account_id"),
        month_of(F.col("created_at")).alias("month_start"), "txn_type", "merchant_category",
        F.lit(1).cast("bigint").alias("payments"), "amount",
    )


def states(rows: DataFrame, count: str) -> DataFrame:
    """The rows added up by everything but their count and amount. States of any split of the
    log add up to the same, and facts of states are those of the rows."""
    keys = [c for c in rows.columns if c not in (count, "amount")]
    return rows.groupBy(*keys).agg(F.sum(count).alias(count), F.sum("amount").alias("amount"))


def account_month_fact(operations: DataFrame, money_flows: DataFrame) -> DataFrame:
    """One row per account and month with an operation. Log and money rows share one
    grouping; months with money but no logged operation are left out."""
    card = is_event("CARD_PAYMENT")
    times = lambda what: F.when(what, F.col("attempts")).otherwise(0)
    logged = operations.where(F.col("account_id").isNotNull()).select(
        "account_id", "month_start", F.lit(True).alias("logged"),
        times(F.col("active")).alias("customer_operations"),
        times(card & succeeded()).alias("card_payments"),
        times(card & failed()).alias("declined_card_payments"),
    )
    spent, deposited = F.col("txn_type") == "CARD_PAYMENT", F.col("txn_type") == "DEPOSIT"
    flows = money_flows.select(
        "account_id", "month_start",
        F.when(spent, F.col("amount")).alias("card_spend"),
        F.when(deposited, F.col("amount")).alias("deposits"),
    )
    counts = ["customer_operations", "card_payments", "declined_card_payments"]
    return (
        logged.unionByName(flows, allowMissingColumns=True)
        .groupBy("account_id", "month_start")
        .agg(
            F.max("logged").alias("logged"),
            *[F.sum(name).cast("bigint").alias(name) for name in counts],
            money(F.sum("card_spend")).alias("card_spend"),
            money(F.sum("deposits")).alias("deposits"),
        )
        .where("logged")
        .select(
            "account_id", "month_start", (F.col("customer_operations") > 0).alias("is_customer_active"),
            *counts, "card_spend", "deposits",
        )
    )


def _account_channels(tables: BankTables) -> DataFrame:
    holders = tables.customers().select("customer_id", "signup_channel")
    return tables.accounts().select("account_id", "customer_id").join(holders, "customer_id").drop("customer_id")


def operations_fact(tables: BankTables, operations: DataFrame) -> DataFrame:
    """Counted per account first, so that the channel lookup joins one row per account,
    month and outcome instead of the log itself."""
    keys = ["month_start", "event_type", "status", "failure_reason"]
    per_account = operations.groupBy("account_id", *keys).agg(F.sum("attempts").alias("attempts"), F.sum("amount").alias("amount"))
    return (
        per_account.join(_account_channels(tables), "account_id", "left")
        .withColumn("signup_channel", F.coalesce("signup_channel", F.lit("UNKNOWN")))
        .groupBy("signup_channel", *keys)
        .agg(F.sum("attempts").alias("attempts"), money(F.sum("amount")).alias("amount_requested"))
        .select("month_start", "signup_channel", "event_type", "status", "failure_reason", "attempts", "amount_requested")
    )


def card_spend_fact(tables: BankTables, money_flows: DataFrame) -> DataFrame:
    per_account = (
        money_flows.where(F.col("txn_type") == "CARD_PAYMENT")
        .groupBy("account_id", "month_start", F.col("merchant_category").alias("category_code"))
        .agg(F.sum("payments").alias("payments"), F.sum("amount").alias("amount"))
    )
    per_code = (
        per_account.join(_account_channels(tables), "account_id")
        .groupBy("month_start", "signup_channel", "category_code")
        .agg(F.sum("payments").alias("payments"), F.sum("amount").cast(MONEY).alias("amount"))
    )
    return per_code.join(F.broadcast(tables.categories()), "category_code").select(
        "month_start", "signup_channel", F.col("label_fr").alias("category"), "is_essential", "payments", "amount"
    )


def retention_fact(tables: BankTables, params: AnalysisParams, operations: DataFrame) -> DataFrame:
    """A cohort and channel without any active account in a month has no row."""
    active = operations.where(F.col("active") & F.col("account_id").isNotNull())
    months = month_words(active, F.col("month_start"))
    return cohort_cells(tables, params, "cohort_month", "signup_channel", months=months).select(
        "cohort_month", "signup_channel", "months_since_opening", "active_accounts", "cohort_size"
    )


def _rank(label: Column, ordered: list[str]) -> Column:
    return labelled(label, {name: str(i) for i, name in enumerate(ordered, 1)}).cast("int")


class Star:
    """The labelled tables a dashboard imports. ``accounts`` lacks the segment, which
    costs a global ranking; ``dim_compte`` has it."""

    def __init__(self, tables: BankTables, params: AnalysisParams) -> None:
        self.tables, self.params = tables, params
        self.operations, self.money = operation_rows(tables, params), money_rows(tables, params)

    def with_steps(self) -> Star:
        """The same star with its facts made from written states, for exporting all tables."""
        star = Star(self.tables, self.params)
        star.operations = written(states(self.operations, "attempts"))
        star.money = written(states(self.money, "payments"))
        return star

    @property
    def accounts(self) -> DataFrame:
        return self._labelled_accounts(account_dimension(self.tables, self.params))

    @cached_property
    def dim_compte(self) -> DataFrame:
        """The account measures are written once; the cut points are selected from three narrow
        columns of them, and each account then finds its segment without a join."""
        measures = written(account_measures(self.tables, self.params))
        base = measures.withColumn("recency_days", F.col("days_since_last_activity"))
        scored = with_scores(base, cut_points(funded_open(measures)))
        segment = F.when(F.col("lifecycle_status").isin("ACTIVE", "DORMANT"), F.col("segment"))
        segmented = scored.withColumn("segment", F.coalesce(segment, F.lit(vocab.NOT_SEGMENTED)))
        return self._labelled_accounts(_dimension(segmented, self.params, "segment"), F.col("segment"))

    @staticmethod
    def _labelled_accounts(dimension: DataFrame, segment: Column | None = None) -> DataFrame:
        status = labelled(F.col("lifecycle_status"), vocab.STATUS_LABELS)
        segment_columns = [] if segment is None else [
            segment.alias("Segment RFM"), _rank(segment, [*vocab.SEGMENTS, vocab.NOT_SEGMENTED]).alias("Ordre segment"),
        ]
        return dimension.select(
            F.col("account_id").alias("Id compte"),
            F.col("customer_id").alias("Id client"),
            F.col("signup_channel").alias("Code canal"),
            F.col("age_band").alias("Tranche âge"),
            F.col("city").alias("Ville"),
            F.col("cohort_month").alias("Mois ouverture"),
            F.col("opened_date").alias("Date ouverture"),
            status.alias("Statut"),
            _rank(status, list(vocab.STATUS_LABELS.values())).alias("Ordre statut"),
            *segment_columns,
            F.col("days_to_first_deposit").alias("Jours avant premier dépôt"),
            F.col("funded_within_7_days").cast("int").alias("Alimenté sous 7 jours"),
            F.col("funded_within_30_days").cast("int").alias("Alimenté sous 30 jours"),
            F.col("activation_eligible").cast("int").alias("Éligible activation"),
            F.col("days_since_last_activity").alias("Jours depuis dernière activité"),
            F.col("balance_at_period_end").alias("Solde fin de période"),
            F.col("card_spend").alias("Dépenses carte"),
            F.col("card_payments").alias("Paiements carte"),
            F.col("declined_card_payments").alias("Paiements refusés"),
        )

    @property
    def dim_mois(self) -> DataFrame:
        """Every month from the first to the last with an account operation."""
        month = F.col("month_start")
        return calendar(self.operations.where(F.col("account_id").isNotNull()).agg(F.min(month).alias("first"), F.max(month).alias("last")))

    @property
    def dim_canal(self) -> DataFrame:
        rows = [(code, label, i) for i, (code, label) in enumerate(vocab.CHANNEL_LABELS.items(), 1)]
        return self.tables.spark.createDataFrame(rows, "`Code canal` string, `Canal` string, `Ordre canal` int")

    @property
    def fait_activite_mensuelle(self) -> DataFrame:
        return account_month_fact(self.operations, self.money).select(
            F.col("account_id").alias("Id compte"),
            F.col("month_start").alias("Mois"),
            F.col("is_customer_active").cast("int").alias("Client actif"),
            F.col("customer_operations").alias("Opérations client"),
            F.col("card_payments").alias("Paiements carte"),
            F.col("declined_card_payments").alias("Paiements refusés"),
            F.col("card_spend").alias("Dépenses carte"),
            F.col("deposits").alias("Dépôts"),
        )

    @property
    def fait_operations(self) -> DataFrame:
        event = labelled(F.col("event_type"), vocab.EVENT_LABELS)
        reason = labelled(F.col("failure_reason"), vocab.REASON_LABELS)
        return operations_fact(self.tables, self.operations).select(
            F.col("month_start").alias("Mois"),
            F.col("signup_channel").alias("Code canal"),
            event.alias("Type opération"),
            F.when(failed(), "Échec").otherwise("Réussite").alias("Résultat"),
            reason.alias("Motif échec"),
            F.when(failed(), F.concat(event, F.lit(" : "), reason)).otherwise(event).alias("Type et motif"),
            F.col("attempts").alias("Tentatives"),
            F.col("amount_requested").alias("Montant demandé"),
        )

    @property
    def fait_depenses_carte(self) -> DataFrame:
        return card_spend_fact(self.tables, self.money).select(
            F.col("month_start").alias("Mois"),
            F.col("signup_channel").alias("Code canal"),
            F.col("category").alias("Catégorie"),
            F.when(F.col("is_essential"), "Essentielle").otherwise("Non essentielle").alias("Type de dépense"),
            F.col("payments").alias("Paiements"),
            F.col("amount").alias("Montant"),
        )

    @property
    def fait_retention_cohortes(self) -> DataFrame:
        return retention_fact(self.tables, self.params, self.operations).select(
            F.col("cohort_month").alias("Mois ouverture"),
            F.date_format("cohort_month", "yyyy-MM").alias("Cohorte"),
            F.col("signup_channel").alias("Code canal"),
            F.col("months_since_opening").alias("Mois depuis ouverture"),
            F.col("active_accounts").alias("Comptes actifs"),
            F.col("cohort_size").alias("Taille cohorte"),
        )


def calendar(span: DataFrame) -> DataFrame:
    """Month rows between the two dates (``first``, ``last``) of a one-row frame."""
    month = F.col("month")
    label = F.element_at(F.array(*[F.lit(text) for text in vocab.MONTH_LABELS]), F.month(month))
    return span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month")).select(
        month.alias("Mois"),
        F.concat_ws(" ", label, F.year(month)).alias("Libellé mois"),
        F.year(month).alias("Année"),
        F.month(month).alias("Numéro mois"),
        F.concat(F.lit("T"), F.quarter(month), F.lit(" "), F.year(month)).alias("Trimestre"),
        (F.year(month) * 100 + F.month(month)).alias("Ordre mois"),
    )
