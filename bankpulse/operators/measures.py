"""Measure catalogue over the star schema, and the dashboard tiles built from it.

``measures(star, names, by, channel)`` evaluates any set of measures under one
grouping and an optional channel filter. Measures on the same table share one pass.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.functions.bitsets import bit_of, word_of
from bankpulse.functions.numbers import MONEY, cents, money_mean, rounded_ratio
from bankpulse.operators.derived import matrix_columns
from bankpulse.operators.distinct import count_bits
from bankpulse.operators.star import Star
from bankpulse.vocabulary import NOT_SEGMENTED

CHANNEL, MONTH, SEGMENT = "Code canal", "Mois", "Segment RFM"
CHANNEL_LABEL, MONTH_LABEL = ["Canal", "Ordre canal"], ["Libellé mois", "Ordre mois"]
BALANCE = "Solde fin de période"


@dataclass(frozen=True)
class Measure:
    table: str
    value: Callable[[], Column]
    share: bool = False  # divide by the total over segments, leaving out unsegmented accounts
    row: Callable[[], Column] | None = None  # of a share: what a row adds to the total


def divide(num: Column, den: Column) -> Column:
    """Ratio to six decimals; blank when the denominator is zero."""
    return rounded_ratio(num, den, 6)


def _status(label: str) -> Column:
    return F.col("Statut") == label


def _eligible() -> Column:
    return F.col("Éligible activation") == 1


def _attempts(condition: Column | None = None) -> Column:
    counted = F.col("Tentatives") if condition is None else F.when(condition, F.col("Tentatives"))
    return F.sum(counted)


def _is_failure() -> Column:
    return F.col("Résultat") == "Échec"


def _is_operation(label: str) -> Column:
    return F.col("Type opération") == label


def _failure_rate(label: str | None = None) -> Column:
    if label is None:
        return divide(F.coalesce(_attempts(_is_failure()), F.lit(0)), _attempts())
    kind = _is_operation(label)
    return divide(F.coalesce(_attempts(_is_failure() & kind), F.lit(0)), _attempts(kind))


def _with_reason(*labels: str) -> Column:
    return F.coalesce(_attempts(_is_failure() & F.col("Motif échec").isin(*labels)), F.lit(0))


def _active_words(rows: DataFrame, by: list[str]) -> DataFrame:
    """The active accounts of each group as words, whose bits ``count_bits`` counts."""
    account = F.col("Id compte")
    bits = F.bit_or(F.when(F.col("Client actif") == 1, bit_of(account)))
    return rows.groupBy(*by, word_of(account).alias("_word")).agg(bits.alias("bits"))


def _retention(condition: Column | None = None) -> Column:
    def total(name: str) -> Column:
        return F.sum(F.col(name) if condition is None else F.when(condition, F.col(name)))

    return divide(total("Comptes actifs"), total("Taille cohorte"))


MEASURES: dict[str, Measure] = {
    # portfolio
    "comptes": Measure("accounts", lambda: F.count("*")),
    "comptes_actifs": Measure("accounts", lambda: F.count_if(_status("Actif"))),
    "comptes_dormants": Measure("accounts", lambda: F.count_if(_status("Dormant"))),
    "comptes_jamais_alimentes": Measure("accounts", lambda: F.count_if(_status("Jamais alimenté"))),
    "comptes_clotures": Measure("accounts", lambda: F.count_if(_status("Clôturé"))),
    "taux_de_comptes_actifs": Measure("accounts", lambda: divide(F.count_if(_status("Actif")), F.count("*"))),
    "nouveaux_comptes": Measure("openings", lambda: F.count("*")),
    "comptes_actifs_du_mois": Measure("activity", count_bits),
    "comptes_actifs_dernier_mois": Measure("last_activity", count_bits),
    # value
    "encours": Measure("accounts", lambda: F.sum(BALANCE).cast(MONEY)),
    "encours_comptes_dormants": Measure(
        "accounts", lambda: F.sum(F.when(_status("Dormant"), F.col(BALANCE))).cast(MONEY)
    ),
    "solde_moyen": Measure("accounts", lambda: money_mean(F.sum(BALANCE), F.count(BALANCE))),
    "depenses_carte": Measure("card_spend", lambda: F.sum("Montant").cast(MONEY)),
    "paiements_carte": Measure("card_spend", lambda: F.sum("Paiements")),
    "panier_moyen": Measure("card_spend", lambda: money_mean(F.sum("Montant"), F.sum("Paiements"))),
    "part_des_comptes_segmentes": Measure("segmented", lambda: F.count("*"), True, lambda: F.lit(1)),
    "part_des_encours_segmentes": Measure("segmented", lambda: cents(F.sum(BALANCE)), True, lambda: cents(F.col(BALANCE))),
    # activation and retention
    "taux_activation_7_jours": Measure("accounts", lambda: divide(
        F.count_if(_eligible() & (F.col("Alimenté sous 7 jours") == 1)), F.count_if(_eligible()))),
    "taux_jamais_alimentes": Measure("accounts", lambda: divide(
        F.count_if(_eligible() & _status("Jamais alimenté")), F.count_if(_eligible()))),
    "delai_moyen_premier_depot_jours": Measure("accounts", lambda: rounded_ratio(
        F.sum("Jours avant premier dépôt"), F.count("Jours avant premier dépôt"), 2)),
    "taux_de_retention": Measure("retention", lambda: _retention()),
    "retention_a_6_mois": Measure("retention", lambda: _retention(F.col("Mois depuis ouverture") == 6)),
    # service quality
    "tentatives": Measure("operations", lambda: _attempts()),
    "echecs": Measure("operations", lambda: _attempts(_is_failure())),
    "taux_d_echec": Measure("operations", lambda: _failure_rate()),
    "taux_de_refus_carte": Measure("operations", lambda: _failure_rate("Paiement carte")),
    "paiements_carte_refuses": Measure(
        "operations", lambda: _attempts(_is_failure() & _is_operation("Paiement carte"))
    ),
    "montant_des_paiements_refuses": Measure("operations", lambda: F.sum(
        F.when(_is_failure() & _is_operation("Paiement carte"), F.col("Montant demandé"))).cast(MONEY)),
    "taux_d_echec_connexion": Measure("operations", lambda: _failure_rate("Connexion")),
    "interception_luhn": Measure("operations", lambda: divide(
        _with_reason("numéro de carte invalide"), _with_reason("numéro de carte invalide", "carte inconnue"))),
}

# grouping under which each measure is registered as a query
DEFAULT_GROUPING: dict[str, list[str]] = {
    **{name: [CHANNEL] for name in MEASURES},
    "nouveaux_comptes": [MONTH],
    "comptes_actifs_du_mois": [MONTH],
    "depenses_carte": ["Catégorie"],
    "paiements_carte": ["Type de dépense"],
    "panier_moyen": ["Catégorie"],
    "part_des_comptes_segmentes": [SEGMENT],
    "part_des_encours_segmentes": [SEGMENT],
    "taux_de_retention": ["Mois depuis ouverture"],
    "tentatives": ["Type opération"],
    "echecs": ["Type et motif"],
    "taux_d_echec": ["Type opération"],
    "taux_de_refus_carte": [MONTH],
    "paiements_carte_refuses": [MONTH],
    "montant_des_paiements_refuses": [MONTH],
    "interception_luhn": ["Type opération"],
}


def _base(star: Star, table: str) -> DataFrame:
    return {
        "accounts": lambda: star.accounts,
        "segmented": lambda: star.dim_compte,
        # accounts on the calendar by opening month
        "openings": lambda: star.accounts.withColumnRenamed("Mois ouverture", MONTH),
        "activity": lambda: star.fait_activite_mensuelle,
        "last_activity": lambda: star.fait_activite_mensuelle,
        "card_spend": lambda: star.fait_depenses_carte,
        "operations": lambda: star.fait_operations,
        "retention": lambda: star.fait_retention_cohortes,
    }[table]()


def _columns(ddl: str) -> list[str]:
    return re.findall("`([^`]+)`", ddl)


ACCOUNT, CALENDAR, CHANNELS = (_columns(ddl) for ddl in (schemas.DIM_ACCOUNT, schemas.DIM_MONTH, schemas.DIM_CHANNEL))


def _source(star: Star, table: str, needed: list[str]) -> DataFrame:
    """The rows of a table with the attributes that the grouping or a filter needs, reached
    along the relationships: month rows to their account, everything to calendar and channel."""
    if table == "accounts" and {SEGMENT, "Ordre segment"} & set(needed):
        table = "segmented"
    rows = _base(star, table)

    def missing(attributes: list[str]) -> list[str]:
        return [name for name in needed if name in attributes and name not in rows.columns]

    if missing(CHANNELS) and CHANNEL not in rows.columns:
        needed = [*needed, CHANNEL]
    if wanted := missing(ACCOUNT):
        if "Id compte" not in rows.columns:
            raise ValueError(f"{table} has no relationship to accounts: {wanted}")
        accounts = star.dim_compte if {SEGMENT, "Ordre segment"} & set(wanted) else star.accounts
        rows = rows.join(accounts.select("Id compte", *wanted), "Id compte")
    if wanted := missing(CALENDAR):
        if MONTH not in rows.columns:
            raise ValueError(f"{table} has no relationship to the calendar: {wanted}")
        rows = rows.join(F.broadcast(star.dim_mois.select(MONTH, *wanted)), MONTH)  # one row per month
    if wanted := missing(CHANNELS):
        rows = rows.join(F.broadcast(star.dim_canal.select(CHANNEL, *wanted)), CHANNEL, "left")  # one row per channel
    return rows


def _last_month(rows: DataFrame, names: list[str], by: list[str]) -> DataFrame:
    """Measures in the last month of the context: counted per month first, then the greatest
    month of the calendar attributes in the grouping stays. One pass over the rows."""
    months = list(dict.fromkeys([*by, MONTH]))
    monthly = _active_words(rows, months).groupBy(*months).agg(*[MEASURES[name].value().alias(name) for name in names])
    context = W.partitionBy(*[name for name in by if name in CALENDAR])
    last = monthly.withColumn("_last", F.max(MONTH).over(context)).where(F.col(MONTH) == F.col("_last"))
    return last.select(*by, *names)


def _evaluated(star: Star, table: str, names: list[str], by: list[str], channel: str | None) -> DataFrame:
    rows = _source(star, table, by if channel is None else [*by, CHANNEL])
    if channel is not None:
        rows = rows.where(F.col(CHANNEL) == channel)
    if table == "last_activity":
        return _last_month(rows, names, by)
    if table == "activity":
        rows = _active_words(rows, by)
    shares = [name for name in names if MEASURES[name].share]
    values = [MEASURES[name].value().alias(name) for name in names]
    if not shares:
        return rows.groupBy(*by).agg(*values)
    segmented = F.col(SEGMENT) != NOT_SEGMENTED
    if SEGMENT not in by:  # without a segment in context: all accounts over the segmented ones
        whole = {name: F.sum(F.when(segmented, MEASURES[name].row())) for name in shares}
        return rows.groupBy(*by).agg(*values, *[w.alias(f"_{name}") for name, w in whole.items()]).select(
            *by, *[divide(F.col(name), F.col(f"_{name}")).alias(name) if name in shares else name for name in names]
        )
    result = rows.groupBy(*by).agg(*values)
    context = W.partitionBy(*[name for name in by if name not in (SEGMENT, "Ordre segment")])

    def share(name: str) -> Column:
        total = F.sum(F.when(segmented, F.col(name))).over(context)
        return F.when(segmented, divide(F.col(name), total))

    return result.withColumns({name: share(name) for name in shares})


def measures(
    star: Star, names: list[str], by: list[str] | None = None, channel: str | None = None, table: str | None = None
) -> DataFrame:
    """``table`` moves account measures to the segmented dimension when the grouping needs it."""
    by = by or []
    per_table: dict[str, list[str]] = {}
    for name in names:
        home = MEASURES[name].table
        per_table.setdefault(table if table and home == "accounts" else home, []).append(name)
    parts = [_evaluated(star, source, group, by, channel) for source, group in per_table.items()]
    joined = reduce(lambda a, b: a.join(b, by, "full") if by else a.crossJoin(b), parts)
    return joined.select(*by, *names)


def measure(star: Star, name: str, by: list[str] | None = None, channel: str | None = None) -> DataFrame:
    return measures(star, [name], by, channel)


# ---------------------------------------------------------------- tiles
STATUS_ORDER, SEGMENT_ORDER = ["Statut", "Ordre statut"], [SEGMENT, "Ordre segment"]

# tile: measures, grouping, sort (a leading '-' sorts downwards)
TILES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "tile_overview_cards": (
        ["comptes", "taux_de_comptes_actifs", "comptes_actifs_dernier_mois", "comptes_jamais_alimentes", "encours"], [], []),
    "tile_active_rate_by_channel": (["taux_de_comptes_actifs"], CHANNEL_LABEL, ["-taux_de_comptes_actifs"]),
    "tile_accounts_by_status": (["comptes"], STATUS_ORDER, ["Ordre statut"]),
    "tile_new_accounts_by_month": (["nouveaux_comptes"], MONTH_LABEL, ["Ordre mois"]),
    "tile_active_by_month": (["comptes_actifs_du_mois"], MONTH_LABEL, ["Ordre mois"]),
    "tile_acquisition_cards": (
        ["taux_activation_7_jours", "taux_jamais_alimentes", "delai_moyen_premier_depot_jours", "retention_a_6_mois"], [], []),
    "tile_activation_by_channel": (
        ["taux_activation_7_jours", "taux_jamais_alimentes"], CHANNEL_LABEL, ["-taux_activation_7_jours"]),
    "tile_channel_table": (
        ["comptes", "taux_activation_7_jours", "delai_moyen_premier_depot_jours", "taux_jamais_alimentes",
         "taux_de_comptes_actifs"], CHANNEL_LABEL, ["Ordre canal"]),
    "tile_quality_cards": (
        ["taux_de_refus_carte", "montant_des_paiements_refuses", "taux_d_echec_connexion", "interception_luhn"], [], []),
    "tile_failure_causes": (["echecs"], ["Type et motif"], ["-echecs"]),
    "tile_declines_by_month": (["paiements_carte_refuses"], MONTH_LABEL, ["Ordre mois"]),
    "tile_decline_rate_by_month": (["taux_de_refus_carte"], MONTH_LABEL, ["Ordre mois"]),
    "tile_value_cards": (["encours", "encours_comptes_dormants", "depenses_carte", "panier_moyen"], [], []),
    "tile_spend_by_category": (["depenses_carte"], ["Catégorie"], ["-depenses_carte"]),
    "tile_segment_shares": (
        ["part_des_comptes_segmentes", "part_des_encours_segmentes"], SEGMENT_ORDER, ["Ordre segment"]),
    "tile_segment_table": (
        ["comptes", "encours", "solde_moyen", "part_des_encours_segmentes"], SEGMENT_ORDER, ["Ordre segment"]),
}


def tile(star: Star, name: str, channel: str | None = None) -> DataFrame:
    names, by, sort = TILES[name]
    frame = measures(star, names, by, channel, table="segmented" if SEGMENT in by else None)
    if names == ["echecs"]:
        frame = frame.where(F.col("echecs").isNotNull())  # causes only; successes are blank
    order = [F.desc_nulls_last(key[1:]) if key.startswith("-") else F.asc(key) for key in sort]
    return frame.orderBy(*order, *[key for key in by if key not in sort]) if by else frame


def retention_matrix_tile(star: Star, channel: str | None = None) -> DataFrame:
    """Retention rate by cohort and month since opening, as a matrix."""
    cells = measures(star, ["taux_de_retention"], ["Cohorte", "Mois depuis ouverture"], channel)
    columns = matrix_columns(star.params, F.col("Mois depuis ouverture"), F.col("taux_de_retention"))
    return cells.groupBy("Cohorte").agg(*columns).orderBy("Cohorte")
