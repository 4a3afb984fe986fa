"""Checks for cleaning, profiling, integrity and constraints."""

from __future__ import annotations

from bankpulse.vocabulary import CHECK_LABELS, PROFILE_LABELS
from oracle.base import check, full_years, luhn_ok, n, relation

CHECKS: dict[str, str] = {}


def _capital(c: str) -> str:
    return f"upper(left(trim({c}), 1)) || lower(substr(trim({c}), 2))"


EMAIL_OK = "regexp_full_match(lower(trim(email)), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}')"
BIRTH = """CAST(CASE WHEN trim(birth_date) SIMILAR TO '[0-9]{4}-[0-9]{2}-[0-9]{2}' THEN try_strptime(trim(birth_date), '%Y-%m-%d')
     WHEN trim(birth_date) SIMILAR TO '[0-9]{2}/[0-9]{2}/[0-9]{4}' THEN try_strptime(trim(birth_date), '%d/%m/%Y') END AS DATE)"""
CITY = f"""CASE WHEN trim(city) = '' OR city IS NULL THEN NULL
     WHEN strip_accents(lower(trim(city))) IN ('saint etienne', 'saint-etienne', 'st etienne', 'st-etienne') THEN 'Saint-Étienne'
     ELSE {_capital('city')} END"""
CHANNEL = """CASE WHEN lower(trim(signup_channel)) IN ('mobile', 'app mobile', 'mobile_app') THEN 'MOBILE'
     WHEN lower(trim(signup_channel)) IN ('web', 'site web') THEN 'WEB'
     WHEN lower(trim(signup_channel)) IN ('partner', 'partenaire') THEN 'PARTNER' END"""
UPDATED = "try_strptime(trim(updated_at), '%Y-%m-%d %H:%M:%S')"

relation("lines", ["stg_customers_raw"], f"""
SELECT *, {full_years('birth', 'seen')} >= 18 AND birth >= DATE '1920-01-01' AS age_ok
FROM (SELECT TRY_CAST(trim(crm_customer_id) AS BIGINT) AS customer_id, {_capital('first_name')} AS first_name,
             {_capital('last_name')} AS last_name, lower(trim(email)) AS mail, {EMAIL_OK} AS mail_ok,
             trim(birth_date) AS birth_text, {BIRTH} AS birth, {CITY} AS town, {CHANNEL} AS origin, {UPDATED} AS seen
      FROM stg_customers_raw) AS parsed""")

relation("latest", ["lines"], """
SELECT * FROM lines WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seen DESC, mail DESC, town DESC) = 1""")

_CUSTOMER = """
SELECT customer_id, first_name, last_name, CASE WHEN mail_ok THEN mail END AS email,
       CASE WHEN birth IS NOT NULL AND age_ok THEN birth END AS birth_date, town AS city, origin AS signup_channel,
       seen AS crm_updated_at,
       nullif(concat_ws(',', CASE WHEN NOT COALESCE(mail_ok, false) THEN 'INVALID_EMAIL' END,
                        CASE WHEN birth_text = '' THEN 'MISSING_BIRTH_DATE' END,
                        CASE WHEN birth_text <> '' AND NOT COALESCE(age_ok, false) THEN 'IMPLAUSIBLE_BIRTH_DATE' END,
                        CASE WHEN town IS NULL THEN 'MISSING_CITY' END), '') AS dq_flags
FROM """
relation("customers", ["latest"], _CUSTOMER + "latest WHERE origin IS NOT NULL AND seen IS NOT NULL")
relation("rejected", ["lines", "latest"], _CUSTOMER + "lines WHERE customer_id IS NULL UNION ALL"
         + _CUSTOMER + "latest WHERE origin IS NULL OR seen IS NULL")
CHECKS["rejected_customers"] = check(["rejected"], "SELECT * FROM rejected")

for _key, _sql in {
    "clean_id": "SELECT crm_customer_id, TRY_CAST(trim(crm_customer_id) AS BIGINT) AS customer_id FROM stg_customers_raw",
    "clean_names": f"SELECT crm_customer_id, {_capital('first_name')} AS first_name, {_capital('last_name')} AS last_name FROM stg_customers_raw",
    "clean_email": f"SELECT crm_customer_id, CASE WHEN {EMAIL_OK} THEN lower(trim(email)) END AS email FROM stg_customers_raw",
    "clean_birth_date": f"SELECT crm_customer_id, birth_date AS birth_raw, {BIRTH} AS birth_date FROM stg_customers_raw",
    "clean_city": f"SELECT crm_customer_id, city AS city_raw, {CITY} AS city FROM stg_customers_raw",
    "clean_channel": f"SELECT crm_customer_id, signup_channel AS channel_raw, {CHANNEL} AS signup_channel FROM stg_customers_raw",
    "clean_updated_at": f"SELECT crm_customer_id, {UPDATED} AS crm_updated_at FROM stg_customers_raw",
}.items():
    CHECKS[_key] = check(["stg_customers_raw"], _sql)
CHECKS["birth_plausibility"] = check(["lines"], """
SELECT customer_id, birth AS birth_parsed, COALESCE(age_ok, false) AS birth_is_plausible FROM lines""")
CHECKS["dedup_latest"] = check(
    ["latest"], "SELECT customer_id, mail AS email_clean, town AS city, seen AS crm_updated_at FROM latest")
relation("finished", ["latest"], _CUSTOMER + "latest")
CHECKS["dq_flags"] = check(["finished"], "SELECT customer_id, dq_flags FROM finished")
CHECKS["customers_clean"] = check(["customers"], "SELECT * FROM customers")

_PROFILE = {
    "prof_raw_rows": ("stg_customers_raw", "SELECT count(*) FROM stg_customers_raw"),
    "prof_distinct_ids": ("stg_customers_raw", "SELECT count(DISTINCT trim(crm_customer_id)) FROM stg_customers_raw"),
    "prof_duplicates": ("stg_customers_raw", "SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM stg_customers_raw GROUP BY trim(crm_customer_id)) AS g"),
    "prof_channel_spellings": ("stg_customers_raw", "SELECT count(DISTINCT signup_channel) FROM stg_customers_raw"),
    "prof_fr_dates": ("stg_customers_raw", "SELECT count(*) FROM stg_customers_raw WHERE regexp_matches(trim(birth_date), '^[0-9]{2}/')"),
    "prof_dirty_names": ("stg_customers_raw", f"SELECT count(*) FROM stg_customers_raw WHERE first_name <> {_capital('first_name')} OR last_name <> {_capital('last_name')}"),
    "prof_dirty_emails": ("stg_customers_raw", "SELECT count(*) FROM stg_customers_raw WHERE lower(trim(email)) <> email"),
    "prof_dirty_cities": ("customers", "SELECT count(*) FROM stg_customers_raw WHERE city = '' OR city NOT IN (SELECT city FROM customers WHERE city IS NOT NULL)"),
    "prof_customers_kept": ("customers", "SELECT count(*) FROM customers"),
    "prof_invalid_email": ("customers", "SELECT count(*) FROM customers WHERE dq_flags LIKE '%INVALID_EMAIL%'"),
    "prof_missing_birth": ("customers", "SELECT count(*) FROM customers WHERE dq_flags LIKE '%MISSING_BIRTH_DATE%'"),
    "prof_implausible_birth": ("customers", "SELECT count(*) FROM customers WHERE dq_flags LIKE '%IMPLAUSIBLE_BIRTH_DATE%'"),
    "prof_missing_city": ("customers", "SELECT count(*) FROM customers WHERE dq_flags LIKE '%MISSING_CITY%'"),
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _indicator(key: str) -> str:
    return f"SELECT {_quoted(PROFILE_LABELS[key])} AS indicator, {n('(' + _PROFILE[key][1] + ')')} AS value"


for _key, (_needs, _) in _PROFILE.items():
    CHECKS[_key] = check([_needs], _indicator(_key))
CHECKS["crm_profiling"] = check(["stg_customers_raw", "customers"], "\nUNION ALL\n".join(map(_indicator, _PROFILE)))

_LEGS = """
SELECT to_account_id AS account_id, amount AS delta FROM seeded_transactions WHERE to_account_id IS NOT NULL
UNION ALL
SELECT from_account_id, -amount FROM seeded_transactions WHERE from_account_id IS NOT NULL"""
relation("seeded_legs", ["seeded_transactions"], _LEGS)
_MONETARY = "('DEPOSIT', 'WITHDRAWAL', 'TRANSFER', 'CARD_PAYMENT')"

_FAULTS = {
    "chk_balance_vs_flows": (["accounts", "seeded_legs"], """
        SELECT count(*) FROM accounts a WHERE a.balance <> COALESCE((SELECT sum(l.delta) FROM seeded_legs l WHERE l.account_id = a.account_id), 0)"""),
    "chk_luhn": (["accounts_plain"], f"SELECT count(*) FROM accounts_plain WHERE NOT ({luhn_ok('card_number')})"),
    "chk_card_duplicates": (["accounts_plain"], "SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM accounts_plain GROUP BY card_number) AS g"),
    "chk_negative_balance": (["accounts"], "SELECT count(*) FROM accounts WHERE balance < 0"),
    "chk_txn_vs_operation": (["seeded_transactions", "operation_log"], """
        SELECT count(*) FROM operation_log o, seeded_transactions t
        WHERE t.operation_id = o.operation_id
          AND NOT (o.status = 'SUCCESS' AND t.txn_type = o.event_type AND COALESCE(t.amount = o.amount_requested, true))"""),
    "chk_op_without_txn": (["seeded_transactions", "operation_log"], f"""
        SELECT count(*) FROM operation_log o WHERE status = 'SUCCESS' AND event_type IN {_MONETARY}
          AND NOT EXISTS (SELECT 1 FROM seeded_transactions t WHERE t.operation_id = o.operation_id)"""),
    "chk_op_before_opening": (["operation_log", "accounts_plain"], """
        SELECT count(*) FROM operation_log o, accounts_plain a WHERE a.account_id = o.account_id AND a.opened_at > o.created_at"""),
    "chk_success_after_close": (["operation_log", "accounts_plain"], """
        SELECT count(*) FROM operation_log o, accounts_plain a
        WHERE a.account_id = o.account_id AND a.closed_at < o.created_at AND o.status = 'SUCCESS'"""),
    "chk_transfer_to_closed": (["seeded_transactions", "accounts_plain"], """
        SELECT count(*) FROM seeded_transactions t, accounts_plain a
        WHERE a.account_id = t.to_account_id AND a.closed_at < t.created_at"""),
    "chk_closed_with_balance": (["accounts"], "SELECT count(*) FROM accounts WHERE balance <> 0 AND status = 'CLOSED'"),
}


def _fault(key: str) -> str:
    return f"SELECT {_quoted(CHECK_LABELS[key])} AS check_name, {n('(' + _FAULTS[key][1] + ')')} AS failing_rows"


for _key, (_needs_list, _) in _FAULTS.items():
    CHECKS[_key] = check(_needs_list, _fault(_key))
_ALL_NEEDS = sorted({name for needs, _ in _FAULTS.values() for name in needs})
_ALL_FAULTS = "\nUNION ALL\n".join(map(_fault, _FAULTS))
CHECKS["integrity_checks"] = check(_ALL_NEEDS, f"""
SELECT check_name, failing_rows, CASE WHEN failing_rows > 0 THEN 'FAILED' ELSE 'OK' END AS status FROM ({_ALL_FAULTS}) AS f""")
CHECKS["quality_gate"] = check(_ALL_NEEDS, f"""
SELECT {n('count(*)')} AS checks, {n('count(*) FILTER (WHERE failing_rows > 0)')} AS failed_checks,
       max(failing_rows) = 0 AS passed FROM ({_ALL_FAULTS}) AS f""")


def _rules(needs: list[str], rules: dict[str, str]) -> str:
    return check(needs, "\nUNION ALL\n".join(
        f"SELECT '{name}' AS constraint_name, {n('(' + sql + ')')} AS violations" for name, sql in rules.items()))


def _surplus(table: str, key: str) -> str:
    return f"SELECT COALESCE(sum(CASE WHEN k IS NULL THEN c ELSE c - 1 END), 0) FROM (SELECT {key} AS k, count(*) AS c FROM {table} GROUP BY 1) AS g"


def _repeats(table: str, key: str) -> str:
    return f"SELECT COALESCE(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}) AS g"


def _dangling(child: str, column: str, parent: str, key: str) -> str:
    return f"SELECT count(*) FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"


_BASE = ["customers", "accounts_plain", "operation_log", "seeded_transactions", "categories"]
CHECKS["cst_primary_keys"] = _rules(_BASE, {
    "pk_customers": _surplus("customers", "customer_id"),
    "pk_accounts": _surplus("accounts_plain", "account_id"),
    "pk_operation_log": _surplus("operation_log", "operation_id"),
    "pk_transactions": _surplus("seeded_transactions", "transaction_id"),
    "pk_categories": _surplus("categories", "category_code"),
    "pk_analysis_period": "SELECT 0",
})
CHECKS["cst_unique_keys"] = _rules(_BASE, {
    "uq_customers_email": _repeats("customers", "strip_accents(lower(email))"),
    "uq_accounts_card_number": _repeats("accounts_plain", "card_number"),
    "uq_transactions_operation": _repeats("seeded_transactions", "operation_id"),
})
CHECKS["cst_foreign_keys"] = _rules(_BASE, {
    "fk_accounts_customer": _dangling("accounts_plain", "customer_id", "customers", "customer_id"),
    "fk_oplog_account": _dangling("operation_log", "account_id", "accounts_plain", "account_id"),
    "fk_txn_operation": _dangling("seeded_transactions", "operation_id", "operation_log", "operation_id"),
    "fk_txn_from_account": _dangling("seeded_transactions", "from_account_id", "accounts_plain", "account_id"),
    "fk_txn_to_account": _dangling("seeded_transactions", "to_account_id", "accounts_plain", "account_id"),
    "fk_txn_category": _dangling("seeded_transactions", "merchant_category", "categories", "category_code"),
})
CHECKS["cst_row_checks"] = _rules(["accounts", "operation_log", "seeded_transactions"], {
    "chk_accounts_balance_positive": "SELECT count(*) FROM accounts WHERE NOT balance >= 0",
    "chk_accounts_card_format": "SELECT count(*) FROM accounts WHERE NOT regexp_full_match(card_number, '400000[0-9]{10}')",
    "chk_accounts_closing": "SELECT count(*) FROM accounts WHERE (status = 'CLOSED') <> (closed_at IS NOT NULL)",
    "chk_oplog_failure_reason": "SELECT count(*) FROM operation_log WHERE (status = 'FAILED') <> (failure_reason IS NOT NULL)",
    "chk_txn_amount_positive": "SELECT count(*) FROM seeded_transactions WHERE NOT amount > 0",
    "chk_txn_category": "SELECT count(*) FROM seeded_transactions WHERE (txn_type = 'CARD_PAYMENT') <> (merchant_category IS NOT NULL)",
})
CHECKS["cst_txn_direction"] = check(["seeded_transactions"], f"""
SELECT txn_type, {n('count(*)')} AS transactions, {n('''count(*) FILTER (WHERE CASE txn_type
         WHEN 'DEPOSIT' THEN from_account_id IS NOT NULL OR to_account_id IS NULL
         WHEN 'TRANSFER' THEN from_account_id IS NULL OR to_account_id IS NULL OR from_account_id = to_account_id
         ELSE from_account_id IS NULL OR to_account_id IS NOT NULL END)''')} AS violations
FROM seeded_transactions GROUP BY txn_type""")
CHECKS["cst_enum_domains"] = _rules(_BASE, {
    "customers.signup_channel": "SELECT count(*) FROM customers WHERE signup_channel NOT IN ('MOBILE', 'WEB', 'PARTNER')",
    "accounts.status": "SELECT count(*) FROM accounts_plain WHERE status NOT IN ('ACTIVE', 'CLOSED')",
    "operation_log.event_type": f"SELECT count(*) FROM operation_log WHERE event_type NOT IN {_MONETARY} AND event_type NOT IN ('CREATE_ACCOUNT', 'CLOSE_ACCOUNT', 'LOGIN', 'BALANCE_INQUIRY')",
    "operation_log.status": "SELECT count(*) FROM operation_log WHERE status NOT IN ('FAILED', 'SUCCESS')",
    "operation_log.failure_reason": "SELECT count(*) FROM operation_log WHERE failure_reason NOT IN ('ACCOUNT_CLOSED', 'INSUFFICIENT_FUNDS', 'INVALID_AMOUNT', 'INVALID_CARD_NUMBER', 'SAME_ACCOUNT', 'UNKNOWN_CARD', 'WRONG_PIN')",
    "operation_log.channel": "SELECT count(*) FROM operation_log WHERE channel NOT IN ('APP', 'SEPA', 'CARD_NETWORK')",
    "transactions.txn_type": f"SELECT count(*) FROM seeded_transactions WHERE txn_type NOT IN {_MONETARY}",
})
_PAIRS = ("chk_txn_vs_operation", "chk_op_without_txn")
CHECKS["layer_pair_checks"] = check(["seeded_transactions", "operation_log"], "\nUNION ALL\n".join([
    *map(_fault, _PAIRS),
    f"SELECT 'fk_txn_operation', {n('(' + _dangling('seeded_transactions', 'operation_id', 'operation_log', 'operation_id') + ')')}",
]))
