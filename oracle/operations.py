"""Checks for sources, attempt classification and ledger jobs."""

from __future__ import annotations

import oracle.customers  # noqa: F401
from bankpulse import schemas
from oracle.base import END, check, euros, luhn_digit, luhn_ok, n, read_back, relation

CHECKS: dict[str, str] = {}

CHECKS["scan_crm_staging"] = check(["stg_customers_raw"], "SELECT * FROM stg_customers_raw")
CHECKS["scan_operational_csv"] = check(["operation_log"], "SELECT * FROM operation_log")
CHECKS["scan_mixed_delivery"] = check(["operation_log"], f"""
SELECT 'accepted' AS kind, event_type AS name, {n('count(*)')} AS lines, CAST(sum(amount_requested) AS DECIMAL(18,2)) AS amount, max(created_at) AS latest
FROM operation_log WHERE operation_id % 401 >= 3 GROUP BY event_type
UNION ALL
SELECT 'rejected', CASE WHEN operation_id % 401 = 0 THEN 'WRONG_LENGTH' ELSE 'WRONG_TYPE' END, {n('count(*)')}, NULL, NULL
FROM operation_log WHERE operation_id % 401 < 3 GROUP BY 2""")
CHECKS["scan_parquet_tables"] = check(["operation_log"], f"""
SELECT event_type, {n('count(*)')} AS operations FROM operation_log WHERE created_at <= {END} GROUP BY event_type""")
_LAYER = {
    "stg_customers_raw": ("stg_customers_raw", schemas.STAGING), "customers": ("customers", schemas.CUSTOMERS),
    "accounts": ("accounts_plain", schemas.ACCOUNTS.replace("balance decimal(12,2), ", "")),
    "operation_log": ("operation_log", schemas.OPERATION_LOG), "transactions": ("transactions", schemas.TRANSACTIONS),
}
CHECKS["load_operational"] = check([table for table, _ in _LAYER.values()], "\nUNION ALL\n".join(
    read_back(name, table, ddl) for name, (table, ddl) in _LAYER.items()))

# ---------------------------------------------------------------- attempts
_STRANGER = "'400000' || lpad(CAST(900000000 + o AS VARCHAR), 9, '0')"


def _typo(card: str) -> str:
    return f"left({card}, 15) || ((CAST(right({card}, 1) AS INTEGER) + 1) % 10)"


relation("logins", ["accounts_plain"], f"""
SELECT o AS attempt_id, CASE o % 5 WHEN 0 THEN {_typo('card_number')} WHEN 1 THEN body || {luhn_digit('body')}
                             WHEN 2 THEN left(card_number, 15) ELSE card_number END AS card_input, pin_ok
FROM (SELECT o_orderkey AS o, {_STRANGER.replace('o AS', 'o_orderkey AS').replace('+ o ', '+ o_orderkey ')} AS body, a.card_number,
             CASE WHEN o_orderkey % 23 <> 7 THEN o_orderstatus <> 'P' END AS pin_ok
      FROM orders JOIN accounts_plain a ON a.account_id = o_custkey + 1) AS t""")
relation("transfers", ["accounts"], f"""
SELECT o AS attempt_id, CASE WHEN o % 37 <> 5 THEN sender_card END AS sender_card,
       CASE WHEN o % 37 <> 5 THEN sender_balance END AS sender_balance, CASE WHEN o % 29 <> 11 THEN amount END AS amount,
       CASE o % 7 WHEN 0 THEN {_typo('target_card')} WHEN 1 THEN sender_card WHEN 2 THEN body || {luhn_digit('body')}
                  ELSE target_card END AS card_input
FROM (SELECT o_orderkey AS o, {_STRANGER.replace('+ o ', '+ o_orderkey ')} AS body, s.account_id AS sender_id, s.card_number AS sender_card,
             s.balance AS sender_balance, t.card_number AS target_card,
             CASE WHEN o_orderkey % 25 = 4 THEN 0 ELSE CAST(CAST(floor(o_totalprice) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) END AS amount
      FROM orders JOIN accounts s ON s.account_id = o_custkey + 1
      JOIN accounts t ON t.account_id = (s.account_id + 6) % (SELECT count(*) FROM customer) + 1) AS x""")
relation("holders", ["accounts_plain"], """
SELECT * FROM accounts_plain QUALIFY row_number() OVER (PARTITION BY card_number ORDER BY account_id) = 1""")
_OK = f"(length(card_input) = 16 AND {luhn_ok('card_input')})"
CHECKS["luhn_valid"] = check(["logins"], f"SELECT attempt_id, card_input, {luhn_ok('card_input')} AS is_valid FROM logins")
CHECKS["luhn_check_digit"] = check(["accounts_plain"], f"""
SELECT account_id, left(card_number, 15) AS body, CAST({luhn_digit('left(card_number, 15)')} AS INTEGER) AS check_digit FROM accounts_plain""")


def _verdict(reason: str, source: str, blind: str) -> str:
    return f"""
SELECT attempt_id, CASE WHEN failure_reason IN ({blind}) THEN NULL ELSE account_id END AS account_id,
       CASE WHEN failure_reason IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status, failure_reason
FROM (SELECT a.attempt_id, h.account_id, {reason} AS failure_reason FROM {source} a LEFT JOIN holders h ON h.card_number = a.card_input) AS j"""


CHECKS["classify_logins"] = check(["logins", "holders"], _verdict(
    f"""CASE WHEN NOT {_OK} THEN 'INVALID_CARD_NUMBER' WHEN h.account_id IS NULL THEN 'UNKNOWN_CARD'
        WHEN h.status = 'CLOSED' THEN 'ACCOUNT_CLOSED' WHEN a.pin_ok IS NOT TRUE THEN 'WRONG_PIN' END""",
    "logins", "'INVALID_CARD_NUMBER', 'UNKNOWN_CARD'"))
CHECKS["classify_transfers"] = check(["transfers", "holders"], _verdict(
    f"""CASE WHEN NOT {_OK} THEN 'INVALID_CARD_NUMBER' WHEN a.card_input = a.sender_card THEN 'SAME_ACCOUNT'
        WHEN h.account_id IS NULL THEN 'UNKNOWN_CARD' WHEN h.status = 'CLOSED' THEN 'ACCOUNT_CLOSED'
        WHEN a.amount IS NULL OR a.amount <= 0 THEN 'INVALID_AMOUNT'
        WHEN a.sender_balance IS NULL OR a.amount > a.sender_balance THEN 'INSUFFICIENT_FUNDS' END""",
    "transfers", "'INVALID_CARD_NUMBER', 'SAME_ACCOUNT', 'UNKNOWN_CARD'"))

# ---------------------------------------------------------------- ledger
relation("signed_legs", ["transactions"], """
SELECT to_account_id AS account_id, operation_id, created_at, amount AS delta FROM transactions WHERE to_account_id IS NOT NULL
UNION ALL
SELECT from_account_id, operation_id, created_at, -amount FROM transactions WHERE from_account_id IS NOT NULL""")
CHECKS["running_balance"] = check(["signed_legs"], """
SELECT account_id, operation_id, created_at, CAST(delta AS DECIMAL(18,2)) AS delta,
       CAST(sum(delta) OVER (PARTITION BY account_id ORDER BY created_at, operation_id) AS DECIMAL(18,2)) AS balance_after
FROM signed_legs""")
relation("queue", ["operation_log", "transactions"], """
SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY created_at, operation_id) AS turn
FROM (SELECT operation_id, account_id, event_type = 'DEPOSIT' AS paid_in, amount_requested AS amount, created_at FROM operation_log
      WHERE event_type IN ('CARD_PAYMENT', 'DEPOSIT', 'WITHDRAWAL', 'TRANSFER') AND account_id IS NOT NULL
        AND COALESCE(failure_reason, 'INVALID_AMOUNT') IN ('INVALID_AMOUNT', 'INSUFFICIENT_FUNDS')
      UNION ALL
      SELECT operation_id, to_account_id, true, amount, created_at FROM transactions WHERE txn_type = 'TRANSFER') AS moves""")
relation("replay", ["queue"], """
SELECT operation_id, account_id, turn, CASE WHEN amount <= 0 THEN 'INVALID_AMOUNT' WHEN NOT paid_in AND amount > 0 THEN 'INSUFFICIENT_FUNDS' END AS failure_reason,
       CAST(CASE WHEN paid_in AND amount > 0 THEN amount ELSE 0 END AS DECIMAL(18,2)) AS balance_after
FROM queue WHERE turn = 1
UNION ALL
SELECT q.operation_id, q.account_id, q.turn,
       CASE WHEN q.amount <= 0 THEN 'INVALID_AMOUNT' WHEN NOT q.paid_in AND q.amount > r.balance_after THEN 'INSUFFICIENT_FUNDS' END,
       CAST(CASE WHEN q.amount <= 0 THEN r.balance_after WHEN q.paid_in THEN r.balance_after + q.amount
                 WHEN q.amount > r.balance_after THEN r.balance_after ELSE r.balance_after - q.amount END AS DECIMAL(18,2))
FROM replay r JOIN queue q ON q.account_id = r.account_id AND q.turn = r.turn + 1""")
CHECKS["ledger_replay"] = check(["replay"], """
SELECT operation_id, account_id, CASE WHEN failure_reason IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status, failure_reason, balance_after
FROM replay""")
CHECKS["ledger_replay_stream"] = CHECKS["ledger_replay"]
CHECKS["apply_balances"] = check(["signed_legs", "accounts_plain"], f"""
SELECT account_id, {euros(f'sum(delta) FILTER (WHERE created_at <= {END})')} AS opening_balance,
       {euros(f'sum(delta) FILTER (WHERE created_at > {END})')} AS delta, {euros('sum(delta)')} AS balance
FROM accounts_plain LEFT JOIN signed_legs USING (account_id) GROUP BY account_id""")
CHECKS["upsert_customers_by_email"] = check(["customers", "stg_customers_raw"], """
, arrivals AS (
SELECT lower(trim(email)) AS email, updated_at, trim(first_name) AS f, trim(last_name) AS l FROM stg_customers_raw
WHERE email IS NOT NULL AND lower(trim(email)) NOT IN (SELECT email FROM customers WHERE email IS NOT NULL)),
fresh AS (
SELECT email, upper(left(f, 1)) || lower(substr(f, 2)) AS first_name, upper(left(l, 1)) || lower(substr(l, 2)) AS last_name
FROM arrivals QUALIFY row_number() OVER (PARTITION BY email ORDER BY updated_at, lower(f), lower(l)) = 1)
SELECT customer_id, first_name, last_name, email, signup_channel, false AS is_new FROM customers
UNION ALL
SELECT (SELECT max(customer_id) FROM customers) + row_number() OVER (ORDER BY email), first_name, last_name, email, 'WEB', true FROM fresh""")
CHECKS["renumber_operations"] = check(["operation_log"], """
SELECT *, row_number() OVER (ORDER BY created_at, operation_id) AS new_operation_id FROM operation_log""")
CHECKS["renumber_chronologically"] = check(["operation_log", "transactions"], """
SELECT t.operation_id, t.txn_type, t.amount, o.new_operation_id,
       row_number() OVER (ORDER BY o.new_operation_id NULLS LAST, t.operation_id) AS new_transaction_id
FROM transactions t LEFT JOIN (SELECT operation_id, row_number() OVER (ORDER BY created_at, operation_id) AS new_operation_id
                               FROM operation_log) AS o USING (operation_id)""")
CHECKS["ascii_slug"] = check(["stg_customers_raw"], """
SELECT crm_customer_id, regexp_replace(lower(strip_accents(first_name)), '[^a-z0-9]', '', 'g') AS name_slug,
       regexp_replace(lower(strip_accents(city)), '[^a-z0-9]', '', 'g') AS city_slug FROM stg_customers_raw""")
