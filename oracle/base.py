"""DuckDB spellings of the input tables, plus helpers to write check queries.

A check query names the relations it needs; ``check`` puts the needed common table
expressions in front of it.
"""

from __future__ import annotations

START = "TIMESTAMP '1995-01-01 00:00:00'"
END = "TIMESTAMP '2000-12-31 23:59:59'"
ACTIVE = "(status = 'SUCCESS' AND channel <> 'SEPA' AND event_type <> 'CREATE_ACCOUNT')"

RELATIONS: dict[str, tuple[list[str], str]] = {}


def relation(name: str, needs: list[str], sql: str) -> None:
    RELATIONS[name] = (needs, sql)


def check(needs: list[str], sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in RELATIONS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS (\n{RELATIONS[name][1]}\n)" for name in ordered)
    if not ordered:
        return sql
    return f"WITH RECURSIVE {ctes}\n{sql.lstrip()}" if not sql.lstrip().startswith(",") else f"WITH RECURSIVE {ctes}{sql}"


def ratio(num: str, den: str, scale: int, times: int = 100) -> str:
    """Exact half-away rounding of times * num / den for whole numbers."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    units = f"((2 * {times * 10**scale} * abs({n}) + abs({d})) // (2 * abs({d})))"
    signed = f"CASE WHEN {d} = 0 THEN NULL WHEN ({n} < 0) <> ({d} < 0) THEN -{units} ELSE {units} END"
    if scale == 0:
        return f"CAST({signed} AS DECIMAL(18,0))"
    unit = f"CAST({10 ** -scale:.{scale}f} AS DECIMAL({scale + 1},{scale}))"
    return f"CAST(CAST({signed} AS DECIMAL(18,0)) * {unit} AS DECIMAL(18,{scale}))"


def cents(money: str) -> str:
    return f"CAST(({money}) * 100 AS HUGEINT)"


def money_ratio(num: str, den: str, scale: int = 1) -> str:
    return ratio(cents(num), cents(den), scale)


def mean(total: str, count: str, scale: int = 2) -> str:
    return ratio(cents(total), f"({count}) * 100", scale, times=1)


def euros(expr: str) -> str:
    return f"CAST(COALESCE({expr}, 0) AS DECIMAL(18,2))"


def n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def month(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def read_back(name: str, table: str, ddl: str) -> str:
    """Rows, filled cells and the sum of all numbers of a relation with declared columns."""
    fields = [f.strip().rpartition(" ") for f in ddl.replace("(12,2)", "").replace("(18,2)", "").replace("(18,1)", "").split(",")]
    columns = {c.strip("`"): kind for c, _, kind in fields}
    filled = " + ".join(f'count("{c}")' for c in columns)
    numeric = [c for c, kind in columns.items() if kind in ("bigint", "int", "decimal")]
    total = " + ".join(f'COALESCE(sum(CAST("{c}" AS DECIMAL(30,2))), 0)' for c in numeric) or "0"
    return (
        f"SELECT '{name}' AS table_name, {n('count(*)')} AS rows_read, {n(filled)} AS filled_cells,"
        f" CAST({total} AS DECIMAL(38,2)) AS numbers FROM {table}"
    )


def full_years(start: str, end: str) -> str:
    """Complete years: not counted until the (month, day) has come round."""
    return (
        f"(year({end}) - year({start}) - CASE WHEN month({end}) * 100 + day({end}) < "
        f"month({start}) * 100 + day({start}) THEN 1 ELSE 0 END)"
    )


def pick(words: list[str], index: str) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + f"][{index} + 1]"


def mapping(column: str, labels: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in labels.items())
    return f"CASE {column} {arms} END"


def rank_of(column: str, labels: list[str]) -> str:
    arms = " ".join(f"WHEN '{label}' THEN {i}" for i, label in enumerate(labels, 1))
    return f"CAST(CASE {column} {arms} END AS INTEGER)"


OPENED = "(TIMESTAMP '1995-01-01' + to_days(CAST(k * 7 % 2200 AS INTEGER)) + to_seconds(k * 7919 % 86400))"
CLOSED = f"(CASE WHEN k % 19 = 0 THEN {OPENED} + to_days(400) END)"


def luhn_digit(body: str) -> str:
    """Check digit of a digit string of any length, by folding over its characters."""
    return (
        f"((10 - list_sum(list_transform(generate_series(1, length({body})), lambda p: "
        f"CASE WHEN p % 2 = 1 THEN (2 * CAST(substr(reverse({body}), p, 1) AS INTEGER)) // 10 + "
        f"(2 * CAST(substr(reverse({body}), p, 1) AS INTEGER)) % 10 "
        f"ELSE CAST(substr(reverse({body}), p, 1) AS INTEGER) END)) % 10) % 10)"
    )


def luhn_ok(number: str) -> str:
    body = f"left({number}, length({number}) - 1)"
    return (
        f"CASE WHEN regexp_full_match({number}, '[0-9]{{2,}}') THEN "
        f"{luhn_digit(body)} = CAST(right({number}, 1) AS INTEGER) ELSE false END"
    )


relation("people", [], f"""
SELECT k, nk, seg, fn, 'Nom' || ln AS ln, ct, bd, up, lower(fn) || '.' || k || '@example.com' AS em
FROM (SELECT c_custkey AS k, c_nationkey AS nk, c_mktsegment AS seg,
             {pick(['Alice', 'Bruno', 'Chloe', 'David', 'Emma'], 'c_custkey % 5')} AS fn,
             {pick(['martin', 'durand', 'petit'], 'c_nationkey % 3')} AS ln,
             {pick(['Paris', 'Lyon', 'Lille', 'Nice', 'Saint-Étienne'], 'c_nationkey % 5')} AS ct,
             CAST(DATE '1935-01-01' + to_days(CAST(c_custkey * 37 % 14000 AS INTEGER)) AS DATE) AS bd,
             TIMESTAMP '1996-01-01' + to_days(CAST(c_custkey % 1800 AS INTEGER)) + to_seconds(c_custkey * 101 % 86400) AS up
      FROM customer) AS drawn""")

relation("stg_customers_raw", ["people"], f"""
SELECT CASE kind WHEN 3 THEN 'C-' || k WHEN 4 THEN CAST(900000000 + k AS VARCHAR) WHEN 5 THEN CAST(800000000 + k AS VARCHAR)
       ELSE (CASE WHEN k % 50 = 3 THEN ' ' ELSE '' END) || CAST(10001 + k AS VARCHAR) END AS crm_customer_id,
       CASE WHEN k % 17 = 0 THEN lower(fn) WHEN k % 20 = 1 THEN ' ' || fn || '  ' ELSE fn END AS first_name,
       CASE WHEN k % 10 = 2 THEN upper(ln) ELSE ln END AS last_name,
       CASE WHEN kind = 1 THEN replace(em, '@', '.old@') WHEN k % 16 = 4 THEN upper(em)
            WHEN k % 33 = 8 THEN ' ' || em || ' ' WHEN k % 100 = 9 THEN replace(em, '@', ' at ') ELSE em END AS email,
       CASE WHEN k % 40 = 5 THEN '' WHEN k % 150 = 7 THEN '1900-01-01' WHEN k % 150 = 57 THEN '14/05/2031'
            WHEN k % 4 = 1 THEN strftime(bd, '%d/%m/%Y') ELSE strftime(bd, '%Y-%m-%d') END AS birth_date,
       CASE WHEN kind = 1 THEN ct WHEN k % 100 = 11 THEN ''
            WHEN nk % 5 = 4 AND k % 2 = 0 THEN {pick(['St-Etienne', 'Saint Etienne', 'saint-etienne'], 'k % 3')}
            WHEN k % 12 = 0 THEN upper(ct) WHEN k % 25 = 6 THEN lower(ct) || ' ' ELSE ct END AS city,
       CASE WHEN kind = 4 THEN 'fax' WHEN seg IN ('BUILDING', 'MACHINERY')
            THEN {pick(['mobile', 'Mobile', 'MOBILE', 'app mobile', 'mobile_app'], 'k % 5')}
            WHEN seg IN ('AUTOMOBILE', 'FURNITURE') THEN {pick(['web', 'Web', 'WEB', 'site web'], 'k % 4')}
            ELSE {pick(['partner', 'Partner', 'PARTENAIRE', 'partenaire'], 'k % 4')} END AS signup_channel,
       CASE WHEN kind = 5 THEN 'soon'
            ELSE strftime(CASE WHEN kind = 1 THEN up - to_days(200) ELSE up END, '%Y-%m-%d %H:%M:%S') END AS updated_at
FROM (SELECT 0 AS kind, * FROM people
      UNION ALL SELECT 1, * FROM people WHERE k % 25 = 0
      UNION ALL SELECT 2, * FROM people WHERE k % 200 = 1
      UNION ALL SELECT 3, * FROM people WHERE k % 90 = 17
      UNION ALL SELECT 4, * FROM people WHERE k % 130 = 21
      UNION ALL SELECT 5, * FROM people WHERE k % 170 = 33) AS versions""")

relation("account_base", [], f"""
SELECT k, body, {luhn_digit('body')} AS digit
FROM (SELECT c_custkey AS k,
             '400000' || lpad(CAST(CASE WHEN c_custkey % 701 = 700 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR), 9, '0') AS body
      FROM customer) AS bodies""")

relation("accounts_plain", ["account_base"], f"""
SELECT k + 1 AS account_id, 10001 + k - CASE WHEN k % 17 = 16 THEN 1 ELSE 0 END AS customer_id,
       body || CAST(CASE WHEN k % 101 = 100 THEN (digit + 1) % 10 ELSE digit END AS VARCHAR) AS card_number,
       'x' AS pin_hash, CASE WHEN k % 19 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
       {OPENED} AS opened_at, {CLOSED} AS closed_at
FROM account_base""")

_DEPOSIT_AMOUNT = "CAST(CAST(floor(o_totalprice) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"

relation("raw_operations", [], f"""
SELECT k, 8 * k + 3 AS operation_id, k + 1 AS account_id, 'CREATE_ACCOUNT' AS event_type, 'SUCCESS' AS status,
       CAST(NULL AS VARCHAR) AS failure_reason, 'APP' AS channel, CAST(NULL AS DECIMAL(12,2)) AS amount_requested,
       {OPENED} AS created_at, CAST(NULL AS VARCHAR) AS merchant_category
FROM (SELECT c_custkey AS k FROM customer) AS c1
UNION ALL
SELECT k, 8 * k + 4, k + 1, 'CLOSE_ACCOUNT', 'SUCCESS', NULL, 'APP', NULL, {CLOSED}, NULL
FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 19 = 0) AS c2
UNION ALL
SELECT k, 8 * k + 5, k + 1, 'DEPOSIT', 'SUCCESS', NULL, CASE WHEN k % 3 = 0 THEN 'SEPA' ELSE 'APP' END,
       CAST(500 + k * 13 % 4000 AS DECIMAL(12,2)),
       {OPENED} + to_days(CAST(k % 12 AS INTEGER)) + to_seconds(300), NULL
FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 5 < 3 AND c_custkey % 11 <> 0) AS c3
UNION ALL
SELECT k, 8 * o + 1,
       CASE WHEN failure_reason IN ('INVALID_CARD_NUMBER', 'UNKNOWN_CARD') AND o % 6 = 0 THEN NULL ELSE k + 1 END,
       {pick(['LOGIN', 'BALANCE_INQUIRY', 'DEPOSIT', 'DEPOSIT', 'TRANSFER', 'WITHDRAWAL'], 'kind')},
       CASE WHEN refused THEN 'FAILED' ELSE 'SUCCESS' END, failure_reason,
       CASE WHEN kind = 3 THEN 'SEPA' ELSE 'APP' END,
       CASE WHEN kind < 2 THEN NULL WHEN failure_reason = 'INVALID_AMOUNT' THEN 0 ELSE {_DEPOSIT_AMOUNT} END,
       o_orderdate + to_seconds(o * 53 % 86400), NULL
FROM (SELECT *, CASE WHEN NOT refused THEN NULL
                     WHEN o % 6 = 0 THEN {pick(['INVALID_CARD_NUMBER', 'UNKNOWN_CARD', 'WRONG_PIN', 'ACCOUNT_CLOSED'], '(o // 6) % 4')}
                     WHEN o % 6 = 4 THEN {pick(['INVALID_CARD_NUMBER', 'SAME_ACCOUNT', 'UNKNOWN_CARD', 'ACCOUNT_CLOSED', 'INSUFFICIENT_FUNDS'], 'o % 5')}
                     WHEN o % 6 = 5 THEN 'INSUFFICIENT_FUNDS' ELSE 'INVALID_AMOUNT' END AS failure_reason
      FROM (SELECT o_orderkey AS o, o_custkey AS k, o_totalprice, o_orderdate,
                   CASE WHEN o_custkey % 11 = 0 AND o_orderkey % 6 IN (2, 3) THEN 0 ELSE o_orderkey % 6 END AS kind,
                   o_orderstatus = 'P' AND CASE o_orderkey % 6 WHEN 2 THEN o_orderkey % 5 = 0 AND o_custkey % 11 <> 0
                                                               ELSE o_orderkey % 6 IN (0, 4, 5) END AS refused
            FROM orders) AS o1) AS o2
UNION ALL
SELECT k, 8 * ((l_orderkey * 8 + l_linenumber) * 262144
              + (l_partkey * 8191 + l_suppkey * 611 + CAST(l_quantity AS BIGINT) * 31) % 262144) + 2,
       k + 1, 'CARD_PAYMENT', CASE WHEN declined THEN 'FAILED' ELSE 'SUCCESS' END,
       CASE WHEN declined THEN 'INSUFFICIENT_FUNDS' END, 'CARD_NETWORK',
       CAST(CAST(floor(l_extendedprice / 10) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)),
       l_shipdate + to_seconds((l_orderkey * 37 + l_partkey * 101 + l_linenumber * 7919) % 86400),
       {pick(['GROCERIES', 'RESTAURANTS', 'TRANSPORT', 'ONLINE_SHOPPING', 'UTILITIES', 'LEISURE', 'HEALTH', 'TRAVEL', 'OTHER'], 'l_partkey % 9')}
FROM (SELECT *, l_orderkey % (SELECT count(*) FROM customer) AS k,
             (l_returnflag = 'R' AND l_linestatus = 'O') AS declined
      FROM lineitem) AS l1""")

relation("placed_operations", ["raw_operations"], f"""
SELECT r.* REPLACE (CASE WHEN created_at < {OPENED} AND operation_id % 211 <> 0
    THEN {OPENED} + to_seconds(datediff('second', created_at, {OPENED}) % greatest(86400, datediff('second', {OPENED}, {END})))
    ELSE created_at END AS created_at)
FROM raw_operations r""")
relation("all_operations", ["placed_operations"], f"""
SELECT p.* EXCLUDE (k) REPLACE (CASE WHEN created_at > {CLOSED} AND operation_id % 211 <> 0 THEN 'FAILED' ELSE status END AS status,
    CASE WHEN created_at > {CLOSED} AND operation_id % 211 <> 0 AND status = 'SUCCESS' THEN 'ACCOUNT_CLOSED' ELSE failure_reason END AS failure_reason)
FROM placed_operations p""")

relation("operation_log", ["all_operations"], "SELECT * EXCLUDE (merchant_category) FROM all_operations")

_TXN = """
SELECT operation_id AS transaction_id, operation_id, event_type AS txn_type,
       CASE WHEN event_type <> 'DEPOSIT' THEN account_id END AS from_account_id,
       CASE event_type WHEN 'DEPOSIT' THEN account_id
            WHEN 'TRANSFER' THEN (account_id + 6) % (SELECT count(*) FROM customer) + 1 END AS to_account_id,
       {amount} AS amount, merchant_category, created_at
FROM all_operations
WHERE status = 'SUCCESS' AND event_type IN ('DEPOSIT', 'WITHDRAWAL', 'TRANSFER', 'CARD_PAYMENT'){drop}"""
relation("transactions", ["all_operations"], _TXN.format(amount="amount_requested", drop=""))
relation("seeded_transactions", ["all_operations"], _TXN.format(
    amount="CAST(amount_requested + CASE WHEN operation_id % 1013 = 0 THEN 1.00 ELSE 0.00 END AS DECIMAL(12,2))",
    drop=" AND operation_id % 1019 <> 0"))

relation("accounts", ["accounts_plain", "seeded_transactions"], """
SELECT a.account_id, a.customer_id, a.card_number, a.pin_hash,
       CAST(COALESCE(inflow, 0) - COALESCE(outflow, 0)
            + CASE WHEN a.account_id % 97 = 0 THEN 0.01 ELSE 0.00 END AS DECIMAL(12,2)) AS balance,
       a.status, a.opened_at, a.closed_at
FROM accounts_plain a
LEFT JOIN (SELECT to_account_id AS id, sum(amount) AS inflow FROM seeded_transactions GROUP BY 1) i ON i.id = a.account_id
LEFT JOIN (SELECT from_account_id AS id, sum(amount) AS outflow FROM seeded_transactions GROUP BY 1) x ON x.id = a.account_id""")

relation("categories", [], """
SELECT * FROM (VALUES ('GROCERIES', 'Alimentation', true), ('RESTAURANTS', 'Restaurants et cafés', false),
  ('TRANSPORT', 'Transport', true), ('ONLINE_SHOPPING', 'Achats en ligne', false),
  ('UTILITIES', 'Énergie et télécom', true), ('LEISURE', 'Loisirs', false), ('HEALTH', 'Santé', true),
  ('TRAVEL', 'Voyages', false), ('OTHER', 'Autres', false)) AS r(category_code, label_fr, is_essential)""")
