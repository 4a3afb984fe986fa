"""Checks for the star schema, the measures and the tiles."""

from __future__ import annotations

import oracle.analysis  # noqa: F401  (defines the views)
from bankpulse import schemas
from bankpulse.vocabulary import (
    CHANNEL_LABELS, EVENT_LABELS, MONTH_LABELS, NOT_SEGMENTED, REASON_LABELS, SEGMENTS, STATUS_LABELS,
)
from oracle.base import ACTIVE, END, cents, check, euros, mapping, mean, n, pick, rank_of, ratio, read_back, relation

CHECKS: dict[str, str] = {}

relation("dim_account", ["v"], f"""
SELECT account_id, customer_id, signup_channel, age_band, COALESCE(city, 'Non renseignée') AS city, cohort_month,
       CAST(opened_at AS DATE) AS opened_date, lifecycle_status, days_to_first_deposit,
       COALESCE(days_to_first_deposit, 9999) <= 7 AS funded_within_7_days,
       COALESCE(days_to_first_deposit, 9999) <= 30 AS funded_within_30_days,
       opened_at <= {END} - INTERVAL 30 DAY AS activation_eligible, days_since_last_activity, balance_at_period_end,
       card_spend, card_payments, declined_card_payments FROM v""")
CHECKS["pbi_dim_account"] = check(["dim_account"], "SELECT * FROM dim_account")

relation("month_flows", ["txn_as_of"], """
SELECT account_id, m, sum(spent) AS spent, sum(paid_in) AS paid_in
FROM (SELECT from_account_id AS account_id, m, amount AS spent, 0 AS paid_in FROM txn_as_of WHERE txn_type = 'CARD_PAYMENT'
      UNION ALL SELECT to_account_id, m, 0, amount FROM txn_as_of WHERE txn_type = 'DEPOSIT') AS f
GROUP BY account_id, m""")
relation("account_months", ["log_as_of", "month_flows"], f"""
SELECT o.account_id, o.m AS month_start, is_customer_active, customer_operations, card_payments, declined_card_payments,
       {euros('spent')} AS card_spend, {euros('paid_in')} AS deposits
FROM (SELECT account_id, m, bool_or({ACTIVE}) AS is_customer_active, {n(f'count(*) FILTER (WHERE {ACTIVE})')} AS customer_operations,
             {n("count(*) FILTER (WHERE event_type = 'CARD_PAYMENT' AND status = 'SUCCESS')")} AS card_payments,
             {n("count(*) FILTER (WHERE event_type = 'CARD_PAYMENT' AND status = 'FAILED')")} AS declined_card_payments
      FROM log_as_of WHERE account_id IS NOT NULL GROUP BY account_id, m) AS o
LEFT JOIN month_flows f ON f.account_id = o.account_id AND f.m = o.m""")
CHECKS["pbi_fact_account_month"] = check(["account_months"], "SELECT * FROM account_months")

relation("channel_of", ["accounts_plain", "customers"], """
SELECT account_id, signup_channel FROM accounts_plain JOIN customers USING (customer_id)""")
relation("fact_ops", ["log_as_of", "channel_of"], f"""
SELECT m AS month_start, COALESCE(signup_channel, 'UNKNOWN') AS signup_channel, event_type, status,
       COALESCE(failure_reason, 'NONE') AS failure_reason, {n('count(*)')} AS attempts,
       {euros('sum(amount_requested)')} AS amount_requested
FROM log_as_of LEFT JOIN channel_of USING (account_id) GROUP BY 1, 2, 3, 4, 5""")
CHECKS["pbi_fact_operations"] = check(["fact_ops"], "SELECT * FROM fact_ops")
relation("fact_spend", ["txn_as_of", "channel_of", "categories"], f"""
SELECT m AS month_start, c.signup_channel, r.label_fr AS category, r.is_essential, {n('count(*)')} AS payments, {euros('sum(amount)')} AS amount
FROM txn_as_of t, channel_of c, categories r
WHERE t.txn_type = 'CARD_PAYMENT' AND c.account_id = t.from_account_id AND r.category_code = t.merchant_category
GROUP BY ALL""")
CHECKS["pbi_fact_card_spend"] = check(["fact_spend"], "SELECT * FROM fact_spend")
relation("fact_retention", ["profiles", "active_months"], f"""
SELECT p.cohort_month, p.signup_channel, CAST(datediff('month', p.cohort_month, a.m) AS INTEGER) AS months_since_opening,
       {n('count(*)')} AS active_accounts, any_value(p.cohort_size) AS cohort_size
FROM (SELECT *, {n('count(*) OVER (PARTITION BY cohort_month, signup_channel)')} AS cohort_size FROM profiles) AS p
JOIN active_months a USING (account_id)
GROUP BY 1, 2, 3""")
CHECKS["pbi_fact_retention"] = check(["fact_retention"], "SELECT * FROM fact_retention")

# ---------------------------------------------------------------- labelled tables
_STATUS = mapping("lifecycle_status", STATUS_LABELS)
_SEGMENT_ORDER = [*SEGMENTS, NOT_SEGMENTED]
relation("comptes", ["dim_account", "segments"], f"""
SELECT *, {rank_of('"Statut"', list(STATUS_LABELS.values()))} AS "Ordre statut", {rank_of('"Segment RFM"', _SEGMENT_ORDER)} AS "Ordre segment"
FROM (SELECT d.account_id AS "Id compte", d.customer_id AS "Id client", d.signup_channel AS "Code canal", d.age_band AS "Tranche âge",
             d.city AS "Ville", d.cohort_month AS "Mois ouverture", d.opened_date AS "Date ouverture",
             {_STATUS.replace('lifecycle_status', 'd.lifecycle_status')} AS "Statut",
             COALESCE(s.segment, '{NOT_SEGMENTED}') AS "Segment RFM", d.days_to_first_deposit AS "Jours avant premier dépôt",
             CAST(d.funded_within_7_days AS INTEGER) AS "Alimenté sous 7 jours", CAST(d.funded_within_30_days AS INTEGER) AS "Alimenté sous 30 jours",
             CAST(d.activation_eligible AS INTEGER) AS "Éligible activation",
             d.days_since_last_activity AS "Jours depuis dernière activité", d.balance_at_period_end AS "Solde fin de période",
             d.card_spend AS "Dépenses carte", d.card_payments AS "Paiements carte", d.declined_card_payments AS "Paiements refusés"
      FROM dim_account d LEFT JOIN segments s ON s.account_id = d.account_id) AS c""")
CHECKS["dim_compte"] = check(["comptes"], "SELECT * FROM comptes")
relation("mois", ["account_months"], """
SELECT min(month_start) AS "Mois" FROM account_months
UNION ALL
SELECT CAST("Mois" + INTERVAL 1 MONTH AS DATE) FROM mois WHERE "Mois" < (SELECT max(month_start) FROM account_months)""")
relation("calendrier", ["mois"], f"""
SELECT "Mois", {pick(MONTH_LABELS, 'month("Mois") - 1')} || ' ' || year("Mois") AS "Libellé mois", CAST(year("Mois") AS INTEGER) AS "Année",
       CAST(month("Mois") AS INTEGER) AS "Numéro mois", 'T' || quarter("Mois") || ' ' || year("Mois") AS "Trimestre",
       CAST(strftime("Mois", '%Y%m') AS INTEGER) AS "Ordre mois" FROM mois""")
CHECKS["dim_mois"] = check(["calendrier"], "SELECT * FROM calendrier")
relation("activite", ["account_months"], """
SELECT account_id AS "Id compte", month_start AS "Mois", CAST(is_customer_active AS INTEGER) AS "Client actif",
       customer_operations AS "Opérations client", card_payments AS "Paiements carte", declined_card_payments AS "Paiements refusés",
       card_spend AS "Dépenses carte", deposits AS "Dépôts" FROM account_months""")
CHECKS["fait_activite_mensuelle"] = check(["activite"], "SELECT * FROM activite")
_EVENT, _REASON = mapping("event_type", EVENT_LABELS), mapping("failure_reason", REASON_LABELS)
relation("operations", ["fact_ops"], f"""
SELECT month_start AS "Mois", signup_channel AS "Code canal", {_EVENT} AS "Type opération",
       CASE status WHEN 'FAILED' THEN 'Échec' ELSE 'Réussite' END AS "Résultat", {_REASON} AS "Motif échec",
       {_EVENT} || CASE status WHEN 'FAILED' THEN ' : ' || {_REASON} ELSE '' END AS "Type et motif",
       attempts AS "Tentatives", amount_requested AS "Montant demandé" FROM fact_ops""")
CHECKS["fait_operations"] = check(["operations"], "SELECT * FROM operations")
CHECKS["scan_star_schema"] = CHECKS["fait_operations"]
relation("depenses", ["fact_spend"], """
SELECT month_start AS "Mois", signup_channel AS "Code canal", category AS "Catégorie",
       CASE WHEN is_essential THEN 'Essentielle' ELSE 'Non essentielle' END AS "Type de dépense", payments AS "Paiements",
       amount AS "Montant" FROM fact_spend""")
CHECKS["fait_depenses_carte"] = check(["depenses"], "SELECT * FROM depenses")
relation("cohortes", ["fact_retention"], """
SELECT cohort_month AS "Mois ouverture", strftime(cohort_month, '%Y-%m') AS "Cohorte", signup_channel AS "Code canal",
       months_since_opening AS "Mois depuis ouverture", active_accounts AS "Comptes actifs", cohort_size AS "Taille cohorte"
FROM fact_retention""")
CHECKS["fait_retention_cohortes"] = check(["cohortes"], "SELECT * FROM cohortes")

# ---------------------------------------------------------------- measures
_FAIL, _CARD = "\"Résultat\" = 'Échec'", "\"Type opération\" = 'Paiement carte'"


def _c(condition: str) -> str:
    return n(f"count(*) FILTER (WHERE {condition})")


def _s(column: str, condition: str | None = None) -> str:
    return f'sum("{column}")' + (f" FILTER (WHERE {condition})" if condition else "")


def _fails(condition: str) -> str:
    return f"COALESCE({_s('Tentatives', _FAIL + ' AND ' + condition)}, 0)"


_LUHN, _UNKNOWN = "\"Motif échec\" = 'numéro de carte invalide'", "\"Motif échec\" = 'carte inconnue'"
_ELIGIBLE = '"Éligible activation" = 1'
_SEGMENTED = f"\"Segment RFM\" <> '{NOT_SEGMENTED}'"
_BAL = '"Solde fin de période"'

MEASURES: dict[str, tuple[str, str]] = {
    "comptes": ("comptes", n("count(*)")),
    "comptes_actifs": ("comptes", _c("\"Statut\" = 'Actif'")),
    "comptes_dormants": ("comptes", _c("\"Statut\" = 'Dormant'")),
    "comptes_jamais_alimentes": ("comptes", _c("\"Statut\" = 'Jamais alimenté'")),
    "comptes_clotures": ("comptes", _c("\"Statut\" = 'Clôturé'")),
    "taux_de_comptes_actifs": ("comptes", ratio(_c("\"Statut\" = 'Actif'"), "count(*)", 6, times=1)),
    "nouveaux_comptes": ("ouvertures", n("count(*)")),
    "comptes_actifs_du_mois": ("activite", n('count(DISTINCT "Id compte") FILTER (WHERE "Client actif" = 1)')),
    "comptes_actifs_dernier_mois": ("dernier_mois", n('count(DISTINCT "Id compte") FILTER (WHERE "Client actif" = 1)')),
    "encours": ("comptes", euros(f"sum({_BAL})")),
    "encours_comptes_dormants": ("comptes", f"CAST(sum({_BAL}) FILTER (WHERE \"Statut\" = 'Dormant') AS DECIMAL(18,2))"),
    "solde_moyen": ("comptes", mean(f"sum({_BAL})", "count(*)")),
    "depenses_carte": ("depenses", euros(_s("Montant"))),
    "paiements_carte": ("depenses", n(_s("Paiements"))),
    "panier_moyen": ("depenses", mean(_s("Montant"), _s("Paiements"))),
    "part_des_comptes_segmentes": ("comptes", f"CASE WHEN {_SEGMENTED} THEN " + ratio(
        "count(*)", f"(SELECT count(*) FROM comptes WHERE {_SEGMENTED})", 6, times=1) + " END"),
    "part_des_encours_segmentes": ("comptes", f"CASE WHEN {_SEGMENTED} THEN " + ratio(
        cents(f"sum({_BAL})"), cents(f"(SELECT sum({_BAL}) FROM comptes WHERE {_SEGMENTED})"), 6, times=1) + " END"),
    "taux_activation_7_jours": ("comptes", ratio(_c(f'{_ELIGIBLE} AND "Alimenté sous 7 jours" = 1'), _c(_ELIGIBLE), 6, times=1)),
    "taux_jamais_alimentes": ("comptes", ratio(_c(f"{_ELIGIBLE} AND \"Statut\" = 'Jamais alimenté'"), _c(_ELIGIBLE), 6, times=1)),
    "delai_moyen_premier_depot_jours": ("comptes", ratio(_s("Jours avant premier dépôt"), 'count("Jours avant premier dépôt")', 2, times=1)),
    "taux_de_retention": ("cohortes", ratio(_s("Comptes actifs"), _s("Taille cohorte"), 6, times=1)),
    "retention_a_6_mois": ("cohortes", ratio(_s("Comptes actifs", '"Mois depuis ouverture" = 6'),
                                             _s("Taille cohorte", '"Mois depuis ouverture" = 6'), 6, times=1)),
    "tentatives": ("operations", n(_s("Tentatives"))),
    "echecs": ("operations", n(_s("Tentatives", _FAIL))),
    "taux_d_echec": ("operations", ratio(_fails("true"), _s("Tentatives"), 6, times=1)),
    "taux_de_refus_carte": ("operations", ratio(_fails(_CARD), _s("Tentatives", _CARD), 6, times=1)),
    "paiements_carte_refuses": ("operations", n(_s("Tentatives", f"{_FAIL} AND {_CARD}"))),
    "montant_des_paiements_refuses": ("operations", f"CAST({_s('Montant demandé', f'{_FAIL} AND {_CARD}')} AS DECIMAL(18,2))"),
    "taux_d_echec_connexion": ("operations", ratio(_fails("\"Type opération\" = 'Connexion'"),
                                                   _s("Tentatives", "\"Type opération\" = 'Connexion'"), 6, times=1)),
    "interception_luhn": ("operations", ratio(_fails(_LUHN), _fails(f"({_LUHN} OR {_UNKNOWN})"), 6, times=1)),
}
relation("ouvertures", ["comptes"], 'SELECT * EXCLUDE ("Mois ouverture"), "Mois ouverture" AS "Mois" FROM comptes')
relation("activite_canal", ["activite", "comptes"], 'SELECT a.*, c."Code canal" FROM activite a JOIN comptes c USING ("Id compte")')
relation("dernier_mois", ["activite_canal", "mois"], 'SELECT * FROM activite_canal WHERE "Mois" = (SELECT max("Mois") FROM mois)')
relation("dernier_mois_tous", ["activite", "mois"], 'SELECT * FROM activite WHERE "Mois" = (SELECT max("Mois") FROM mois)')

GROUPING = {
    "nouveaux_comptes": "Mois", "comptes_actifs_du_mois": "Mois", "depenses_carte": "Catégorie",
    "paiements_carte": "Type de dépense", "panier_moyen": "Catégorie", "part_des_comptes_segmentes": "Segment RFM",
    "part_des_encours_segmentes": "Segment RFM", "taux_de_retention": "Mois depuis ouverture",
    "tentatives": "Type opération", "echecs": "Type et motif", "taux_d_echec": "Type opération",
    "taux_de_refus_carte": "Mois", "paiements_carte_refuses": "Mois", "montant_des_paiements_refuses": "Mois",
    "interception_luhn": "Type opération",
}


def _grouped(names: list[str], by: list[str], where: str = "true") -> tuple[list[str], str]:
    """Measures of one table under one grouping."""
    table = MEASURES[names[0]][0]
    keys = ", ".join(f'"{key}"' for key in by)
    values = ", ".join(f"{MEASURES[name][1]} AS {name}" for name in names)
    group = f" GROUP BY {keys}" if by else ""
    return [table], f"SELECT {keys + ', ' if by else ''}{values} FROM {table} WHERE {where}{group}"


for _name in MEASURES:
    _needs, _sql = _grouped([_name], [GROUPING.get(_name, "Code canal")])
    CHECKS[f"m_{_name}"] = check(_needs, _sql)


_CHANNELS = ", ".join(f"('{code}', '{label}', {i})" for i, (code, label) in enumerate(CHANNEL_LABELS.items(), 1))
relation("canaux", [], f'SELECT * FROM (VALUES {_CHANNELS}) AS l("Code canal", "Canal", "Ordre canal")')
_CANAL, _LIBELLE = ["Canal", "Ordre canal"], ["Libellé mois", "Ordre mois"]


def _tile(name: str, names: list[str], by: list[str], where: str = "true", extra: str = "") -> None:
    needs, sql = _grouped(names, by, where)
    if by == _CANAL:
        needs, sql = [*needs, "canaux"], sql.replace(f"FROM {needs[0]} ", f'FROM {needs[0]} t JOIN canaux c ON c."Code canal" = t."Code canal" ')
    if by == _LIBELLE:
        needs, sql = [*needs, "calendrier"], sql.replace(f"FROM {needs[0]} ", f'FROM {needs[0]} t JOIN calendrier l ON l."Mois" = t."Mois" ')
    CHECKS[name] = check(needs, sql + extra)


def _cards(name: str, names: list[str], where: str = "true") -> None:
    """Cards without grouping: one scalar per measure, each from its own table."""
    needs = sorted({MEASURES[m][0] for m in names})
    values = ", ".join(f"({_grouped([m], [], where)[1]}) AS {m}" for m in names)
    if where == "true":  # without a channel filter, month rows need no account
        needs = [need.replace("dernier_mois", "dernier_mois_tous") for need in needs]
        values = values.replace("FROM dernier_mois ", "FROM dernier_mois_tous ")
    CHECKS[name] = check(needs, f"SELECT {values}")


_OVERVIEW = ["comptes", "taux_de_comptes_actifs", "comptes_actifs_dernier_mois", "comptes_jamais_alimentes", "encours"]
_cards("tile_overview_cards", _OVERVIEW)
_cards("tile_overview_cards_mobile", _OVERVIEW, "\"Code canal\" = 'MOBILE'")
_tile("tile_active_rate_by_channel", ["taux_de_comptes_actifs"], _CANAL)
_tile("tile_accounts_by_status", ["comptes"], ["Statut", "Ordre statut"])
_tile("tile_new_accounts_by_month", ["nouveaux_comptes"], _LIBELLE)
_tile("tile_active_by_month", ["comptes_actifs_du_mois"], _LIBELLE)
_cards("tile_acquisition_cards", ["taux_activation_7_jours", "taux_jamais_alimentes", "delai_moyen_premier_depot_jours", "retention_a_6_mois"])
_tile("tile_activation_by_channel", ["taux_activation_7_jours", "taux_jamais_alimentes"], _CANAL)
_tile("tile_channel_table", ["comptes", "taux_activation_7_jours", "delai_moyen_premier_depot_jours", "taux_jamais_alimentes",
                             "taux_de_comptes_actifs"], _CANAL)
_cards("tile_quality_cards", ["taux_de_refus_carte", "montant_des_paiements_refuses", "taux_d_echec_connexion", "interception_luhn"])
_tile("tile_failure_causes", ["echecs"], ["Type et motif"], where=_FAIL)
_tile("tile_declines_by_month", ["paiements_carte_refuses"], _LIBELLE)
_tile("tile_decline_rate_by_month", ["taux_de_refus_carte"], _LIBELLE)
_cards("tile_value_cards", ["encours", "encours_comptes_dormants", "depenses_carte", "panier_moyen"])
_tile("tile_spend_by_category", ["depenses_carte"], ["Catégorie"])
_tile("tile_segment_shares", ["part_des_comptes_segmentes", "part_des_encours_segmentes"], ["Segment RFM", "Ordre segment"])
_tile("tile_segment_table", ["comptes", "encours", "solde_moyen", "part_des_encours_segmentes"], ["Segment RFM", "Ordre segment"])
CHECKS["tile_retention_matrix"] = check(["cohortes"], f"""
SELECT "Cohorte", {', '.join(f'max(rate) FILTER (WHERE elapsed = {i}) AS m{i:02d}' for i in range(72))},
       string_agg(elapsed || ':' || rate, ' ' ORDER BY elapsed) FILTER (WHERE elapsed < 0) AS before_opening,
       string_agg(elapsed || ':' || rate, ' ' ORDER BY elapsed) FILTER (WHERE elapsed > 71) AS after_period
FROM (SELECT "Cohorte", "Mois depuis ouverture" AS elapsed, {MEASURES['taux_de_retention'][1]} AS rate FROM cohortes GROUP BY 1, 2) AS r
GROUP BY "Cohorte" """)

# ---------------------------------------------------------------- sinks
_STAR_TABLES = {
    "dim_compte": "comptes", "dim_mois": "calendrier", "fait_activite_mensuelle": "activite", "fait_operations": "operations",
    "fait_depenses_carte": "depenses", "fait_retention_cohortes": "cohortes",
}
CHECKS["sink_star_schema"] = check([*_STAR_TABLES.values(), "canaux"], "\nUNION ALL\n".join(
    read_back(name, table, schemas.STAR[name]) for name, table in {**_STAR_TABLES, "dim_canal": "canaux"}.items()))
_WATCHLIST = ("account_id bigint, customer_id bigint, signup_channel string, age_band string, last_activity_at timestamp_ntz, "
              "days_since_last_activity bigint, balance_at_period_end decimal(18,2), card_payments bigint")
_SEGMENTATION = ("account_id bigint, segment string, R int, F int, M int, recency_days bigint, frequency_180d bigint, "
                 "card_spend_180d decimal(18,2), balance_at_period_end decimal(18,2)")
CHECKS["sink_action_list"] = check(["q11", "segments"],
    read_back("liste_prevention_dormance", "q11", _WATCHLIST) + "\nUNION ALL\n" + read_back("segmentation_rfm", "segments", _SEGMENTATION))
