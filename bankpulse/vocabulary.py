"""Codes, labels and word lists that results must show exactly."""

# --- merchant categories: code, label, essential (fixed values)
CATEGORIES = [
    ("GROCERIES", "Alimentation", True),
    ("RESTAURANTS", "Restaurants et cafés", False),
    ("TRANSPORT", "Transport", True),
    ("ONLINE_SHOPPING", "Achats en ligne", False),
    ("UTILITIES", "Énergie et télécom", True),
    ("LEISURE", "Loisirs", False),
    ("HEALTH", "Santé", True),
    ("TRAVEL", "Voyages", False),
    ("OTHER", "Autres", False),
]

# --- enumerated domains (fixed values)
SIGNUP_CHANNELS = ["MOBILE", "WEB", "PARTNER"]
ACCOUNT_STATUSES = ["ACTIVE", "CLOSED"]
EVENT_TYPES = [
    "CREATE_ACCOUNT", "LOGIN", "BALANCE_INQUIRY", "DEPOSIT",
    "WITHDRAWAL", "TRANSFER", "CARD_PAYMENT", "CLOSE_ACCOUNT",
]
OPERATION_STATUSES = ["SUCCESS", "FAILED"]
FAILURE_REASONS = [
    "WRONG_PIN", "UNKNOWN_CARD", "INVALID_CARD_NUMBER", "SAME_ACCOUNT",
    "ACCOUNT_CLOSED", "INVALID_AMOUNT", "INSUFFICIENT_FUNDS",
]
OPERATION_CHANNELS = ["APP", "CARD_NETWORK", "SEPA"]
TXN_TYPES = ["DEPOSIT", "WITHDRAWAL", "TRANSFER", "CARD_PAYMENT"]
CARD_PATTERN = "^400000[0-9]{10}$"

# --- CRM cleaning (fixed values)
CHANNEL_SPELLINGS = {
    "MOBILE": ["mobile", "app mobile", "mobile_app"],
    "WEB": ["web", "site web"],
    "PARTNER": ["partner", "partenaire"],
}
SAINT_ETIENNE = "Saint-Étienne"
SAINT_ETIENNE_ALIASES = ["st-etienne", "st etienne", "saint etienne", "saint-etienne"]
EMAIL_PATTERN = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
ISO_DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
FRENCH_DATE_PATTERN = "^[0-9]{2}/[0-9]{2}/[0-9]{4}$"
MOMENT_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
EARLIEST_BIRTH = "1920-01-01"
ADULT_AGE = 18

# --- report labels (fixed values)
PROFILE_LABELS = {
    "prof_raw_rows": "Lignes brutes dans l'export CRM",
    "prof_distinct_ids": "Identifiants clients distincts",
    "prof_duplicates": "Doublons écartés (anciennes versions ou copies)",
    "prof_channel_spellings": "Orthographes différentes du canal d'inscription",
    "prof_fr_dates": "Dates de naissance au format JJ/MM/AAAA",
    "prof_dirty_names": "Prénoms ou noms avec espaces ou casse incohérente",
    "prof_dirty_emails": "Emails non normalisés (majuscules ou espaces)",
    "prof_dirty_cities": "Villes non normalisées ou alias",
    "prof_customers_kept": "Clients retenus dans la table customers",
    "prof_invalid_email": "Clients avec email invalide (valeur mise à NULL)",
    "prof_missing_birth": "Clients sans date de naissance",
    "prof_implausible_birth": "Clients avec date de naissance aberrante (mise à NULL)",
    "prof_missing_city": "Clients sans ville",
}
CHECK_LABELS = {
    "chk_balance_vs_flows": "Solde différent de la somme des transactions",
    "chk_luhn": "Numéro de carte invalide (algorithme de Luhn recalculé en SQL)",
    "chk_card_duplicates": "Numéro de carte en double",
    "chk_negative_balance": "Solde négatif",
    "chk_txn_vs_operation": "Transaction liée à une opération échouée, d'un autre type ou d'un autre montant",
    "chk_op_without_txn": "Opération monétaire réussie sans transaction",
    "chk_op_before_opening": "Opération antérieure à l'ouverture du compte",
    "chk_success_after_close": "Opération réussie après la clôture du compte",
    "chk_transfer_to_closed": "Virement reçu par un compte clôturé",
    "chk_closed_with_balance": "Compte clôturé avec un solde restant",
}

# --- dashboard labels (fixed values)
CHANNEL_LABELS = {
    "MOBILE": "Mobile", "WEB": "Site web", "PARTNER": "Partenaires", "UNKNOWN": "Non identifié",
}
STATUS_LABELS = {
    "ACTIVE": "Actif", "DORMANT": "Dormant", "NEVER_FUNDED": "Jamais alimenté", "CLOSED": "Clôturé",
}
EVENT_LABELS = {
    "CREATE_ACCOUNT": "Ouverture de compte", "LOGIN": "Connexion",
    "BALANCE_INQUIRY": "Consultation du solde", "DEPOSIT": "Dépôt", "WITHDRAWAL": "Retrait",
    "TRANSFER": "Virement", "CARD_PAYMENT": "Paiement carte", "CLOSE_ACCOUNT": "Clôture de compte",
}
REASON_LABELS = {
    "NONE": "Aucun", "INSUFFICIENT_FUNDS": "solde insuffisant", "WRONG_PIN": "code PIN erroné",
    "INVALID_CARD_NUMBER": "numéro de carte invalide", "ACCOUNT_CLOSED": "bénéficiaire clôturé",
    "SAME_ACCOUNT": "virement vers soi-même", "UNKNOWN_CARD": "carte inconnue",
    "INVALID_AMOUNT": "montant invalide",
}
MONTH_LABELS = [
    "janv.", "févr.", "mars", "avr.", "mai", "juin", "juil.", "août", "sept.", "oct.", "nov.", "déc.",
]
SEGMENTS = [
    "Champions", "Clients réguliers", "Épargnants peu actifs", "Occasionnels", "À risque", "Endormis",
]
NOT_SEGMENTED = "Hors segmentation"
UNKNOWN_AGE = "Inconnu"
UNKNOWN_CITY = "Non renseignée"
