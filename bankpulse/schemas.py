"""Declared schemas. Nothing is ever inferred from files."""

STAGING_COLUMNS = [
    "crm_customer_id", "first_name", "last_name", "email",
    "birth_date", "city", "signup_channel", "updated_at",
]
STAGING = ", ".join(f"{name} string" for name in STAGING_COLUMNS)

CUSTOMERS = (
    "customer_id bigint, first_name string, last_name string, email string, birth_date date, "
    "city string, signup_channel string, crm_updated_at timestamp_ntz, dq_flags string"
)
ACCOUNTS = (
    "account_id bigint, customer_id bigint, card_number string, pin_hash string, "
    "balance decimal(12,2), status string, opened_at timestamp_ntz, closed_at timestamp_ntz"
)
OPERATION_LOG = (
    "operation_id bigint, account_id bigint, event_type string, status string, "
    "failure_reason string, channel string, amount_requested decimal(12,2), created_at timestamp_ntz"
)
TRANSACTIONS = (
    "transaction_id bigint, operation_id bigint, txn_type string, from_account_id bigint, "
    "to_account_id bigint, amount decimal(12,2), merchant_category string, created_at timestamp_ntz"
)
CATEGORIES = "category_code string, label_fr string, is_essential boolean"

DIM_ACCOUNT = (
    "`Id compte` bigint, `Id client` bigint, `Code canal` string, `Tranche âge` string, `Ville` string, "
    "`Mois ouverture` date, `Date ouverture` date, `Statut` string, `Ordre statut` int, "
    "`Segment RFM` string, `Ordre segment` int, `Jours avant premier dépôt` bigint, "
    "`Alimenté sous 7 jours` int, `Alimenté sous 30 jours` int, `Éligible activation` int, "
    "`Jours depuis dernière activité` bigint, `Solde fin de période` decimal(18,2), "
    "`Dépenses carte` decimal(18,2), `Paiements carte` bigint, `Paiements refusés` bigint"
)
DIM_MONTH = (
    "`Mois` date, `Libellé mois` string, `Année` int, `Numéro mois` int, `Trimestre` string, `Ordre mois` int"
)
DIM_CHANNEL = "`Code canal` string, `Canal` string, `Ordre canal` int"
FACT_ACTIVITY = (
    "`Id compte` bigint, `Mois` date, `Client actif` int, `Opérations client` bigint, "
    "`Paiements carte` bigint, `Paiements refusés` bigint, `Dépenses carte` decimal(18,2), "
    "`Dépôts` decimal(18,2)"
)
FACT_OPERATIONS = (
    "`Mois` date, `Code canal` string, `Type opération` string, `Résultat` string, `Motif échec` string, "
    "`Type et motif` string, `Tentatives` bigint, `Montant demandé` decimal(18,2)"
)
FACT_CARD_SPEND = (
    "`Mois` date, `Code canal` string, `Catégorie` string, `Type de dépense` string, "
    "`Paiements` bigint, `Montant` decimal(18,2)"
)
FACT_RETENTION = (
    "`Mois ouverture` date, `Cohorte` string, `Code canal` string, `Mois depuis ouverture` int, "
    "`Comptes actifs` bigint, `Taille cohorte` bigint"
)
STAR = {
    "dim_compte": DIM_ACCOUNT,
    "dim_mois": DIM_MONTH,
    "dim_canal": DIM_CHANNEL,
    "fait_activite_mensuelle": FACT_ACTIVITY,
    "fait_operations": FACT_OPERATIONS,
    "fait_depenses_carte": FACT_CARD_SPEND,
    "fait_retention_cohortes": FACT_RETENTION,
}
