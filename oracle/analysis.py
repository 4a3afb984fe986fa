"""Checks for the semantic views, the business questions, RFM and statistics."""

from __future__ import annotations

import oracle.customers  # noqa: F401  (defines the customers relation)
from bankpulse.vocabulary import EVENT_LABELS, REASON_LABELS, SEGMENTS
from oracle.base import (
    ACTIVE, END, START, check, cents, euros, full_years, mapping, mean, money_ratio, month, n, rank_of, ratio, relation,
)

CHECKS: dict[str, str] = {}

relation("log_as_of", ["operation_log"], f"SELECT *, {month('created_at')} AS m FROM operation_log WHERE created_at <= {END}")
relation("txn_as_of", ["transactions"], f"SELECT *, {month('created_at')} AS m FROM transactions WHERE created_at <= {END}")
relation("recent_log", ["log_as_of"], f"SELECT * FROM log_as_of WHERE {ACTIVE} AND created_at > {END} - INTERVAL 180 DAY")

relation("ops", ["log_as_of"], f"""
SELECT account_id,
       min(created_at) FILTER (WHERE event_type = 'DEPOSIT' AND status = 'SUCCESS') AS first_deposit_at,
       max(created_at) FILTER (WHERE {ACTIVE}) AS last_activity_at,
       {n("count(*) FILTER (WHERE event_type = 'LOGIN' AND status = 'SUCCESS')")} AS logins,
       {n("count(*) FILTER (WHERE event_type = 'CARD_PAYMENT' AND status = 'SUCCESS')")} AS card_payments,
       {n("count(*) FILTER (WHERE event_type = 'CARD_PAYMENT' AND status = 'FAILED')")} AS declined_card_payments,
       {n("count(*) FILTER (WHERE status = 'FAILED')")} AS failed_operations
FROM log_as_of WHERE account_id IS NOT NULL GROUP BY account_id""")

relation("legs", ["txn_as_of"], """
SELECT to_account_id AS account_id, txn_type, amount AS amount_in, CAST(0 AS DECIMAL(12,2)) AS amount_out
FROM txn_as_of WHERE to_account_id IS NOT NULL
UNION ALL
SELECT from_account_id, txn_type, 0, amount FROM txn_as_of WHERE from_account_id IS NOT NULL""")

relation("money", ["legs"], f"""
SELECT account_id,
       {euros("sum(amount_in) FILTER (WHERE txn_type = 'DEPOSIT')")} AS total_deposits,
       {euros("sum(amount_in) FILTER (WHERE txn_type = 'TRANSFER')")} AS transfers_received,
       {euros("sum(amount_out) FILTER (WHERE txn_type = 'TRANSFER')")} AS transfers_sent,
       {euros("sum(amount_out) FILTER (WHERE txn_type = 'CARD_PAYMENT')")} AS card_spend,
       {euros("sum(amount_out) FILTER (WHERE txn_type = 'WITHDRAWAL')")} AS withdrawals,
       {euros('sum(amount_in - amount_out)')} AS balance_at_period_end
FROM legs GROUP BY account_id""")

relation("age_bands", [], """
SELECT * FROM (VALUES (-1000, 24, '18-24'), (25, 34, '25-34'), (35, 44, '35-44'), (45, 54, '45-54'), (55, 1000, '55+')) AS b(lowest, highest, age_band)""")
relation("profiles", ["accounts_plain", "customers", "age_bands"], f"""
SELECT account_id, customer_id, signup_channel, city, age_at_opening,
       COALESCE(b.age_band, 'Inconnu') AS age_band,
       opened_at, {month('opened_at')} AS cohort_month, CASE WHEN closed_at <= {END} THEN closed_at END AS closed_at
FROM (SELECT a.*, c.signup_channel, c.city, {n(full_years('c.birth_date', 'a.opened_at'))} AS age_at_opening
      FROM accounts_plain a, customers c
      WHERE c.customer_id = a.customer_id AND a.opened_at <= {END}) AS held
LEFT JOIN age_bands b ON held.age_at_opening BETWEEN b.lowest AND b.highest""")

_COUNTS = ["logins", "card_payments", "declined_card_payments", "failed_operations"]
_SUMS = ["total_deposits", "transfers_received", "transfers_sent", "card_spend", "withdrawals", "balance_at_period_end"]
relation("v", ["profiles", "ops", "money"], f"""
SELECT p.*, o.first_deposit_at,
       CAST(trunc(epoch(o.first_deposit_at - p.opened_at) / 86400) AS BIGINT) AS days_to_first_deposit,
       o.last_activity_at,
       CAST(trunc(epoch({END} - o.last_activity_at) / 86400) AS BIGINT) AS days_since_last_activity,
       {', '.join(f'COALESCE(o.{c}, 0) AS {c}' for c in _COUNTS)},
       {', '.join(f'{euros("f." + c)} AS {c}' for c in _SUMS)},
       CASE WHEN p.closed_at IS NOT NULL THEN 'CLOSED' WHEN o.first_deposit_at IS NULL THEN 'NEVER_FUNDED'
            WHEN COALESCE(o.last_activity_at >= {END} - INTERVAL 90 DAY, false) THEN 'ACTIVE' ELSE 'DORMANT' END AS lifecycle_status
FROM profiles p LEFT JOIN ops o USING (account_id) LEFT JOIN money f USING (account_id)""")

CHECKS["account_ops"] = check(["ops"], "SELECT * FROM ops")
CHECKS["account_movements"] = check(["legs"], "SELECT * FROM legs")
CHECKS["account_money"] = check(["money"], "SELECT * FROM money")
CHECKS["age_band"] = check(["profiles"], "SELECT account_id, age_at_opening, age_band FROM profiles")
CHECKS["cohort_month"] = check(["profiles"], "SELECT account_id, cohort_month FROM profiles")
CHECKS["account_delays"] = check(["v"], "SELECT account_id, days_to_first_deposit, days_since_last_activity FROM v")
CHECKS["lifecycle_status"] = check(["v"], "SELECT account_id, lifecycle_status FROM v")
CHECKS["v_account_activity"] = check(["v"], "SELECT * FROM v")
CHECKS["register_views"] = check(["v"], f"""
SELECT signup_channel, lifecycle_status, {n('count(*)')} AS accounts, {euros('sum(balance_at_period_end)')} AS balance
FROM v GROUP BY ALL""")

# ---------------------------------------------------------------- months
relation("spine", [], f"""
SELECT {month(START)} AS month_start
UNION ALL
SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE) FROM spine WHERE month_start + INTERVAL 1 MONTH <= {END}""")
_APP = "channel = 'APP' AND event_type IN ('LOGIN', 'DEPOSIT', 'WITHDRAWAL', 'TRANSFER')"
relation("month_ops", ["log_as_of"], f"""
SELECT m AS month_start,
       {n("count(*) FILTER (WHERE event_type = 'CREATE_ACCOUNT')")} AS new_accounts,
       {n("count(*) FILTER (WHERE event_type = 'CLOSE_ACCOUNT')")} AS closed_accounts,
       {n(f"count(DISTINCT account_id) FILTER (WHERE {ACTIVE})")} AS active_accounts,
       {n(f"count(*) FILTER (WHERE {_APP})")} AS app_attempts,
       {n(f"count(*) FILTER (WHERE {_APP} AND status = 'FAILED')")} AS app_failures,
       {n("count(*) FILTER (WHERE event_type = 'CARD_PAYMENT')")} AS card_payment_attempts,
       {n("count(*) FILTER (WHERE event_type = 'CARD_PAYMENT' AND status = 'FAILED')")} AS declined_card_payments
FROM log_as_of GROUP BY m""")
relation("month_money", ["txn_as_of"], f"""
SELECT m AS month_start, {euros("sum(amount) FILTER (WHERE txn_type = 'DEPOSIT')")} AS deposits_amount,
       {euros("sum(amount) FILTER (WHERE txn_type = 'CARD_PAYMENT')")} AS card_spend_amount,
       {euros("sum(amount) FILTER (WHERE txn_type = 'TRANSFER')")} AS transfers_amount,
       {euros("sum(amount) FILTER (WHERE txn_type = 'WITHDRAWAL')")} AS withdrawals_amount
FROM txn_as_of GROUP BY m""")
_AMOUNTS = ["deposits_amount", "card_spend_amount", "transfers_amount", "withdrawals_amount"]
relation("kpis", ["spine", "month_ops", "month_money"], f"""
SELECT month_start, {', '.join(f'COALESCE({c}, 0) AS {c}' for c in ('new_accounts', 'closed_accounts', 'active_accounts'))},
       {', '.join(f'{euros(c)} AS {c}' for c in _AMOUNTS)}, COALESCE(card_payment_attempts, 0) AS card_payment_attempts,
       {ratio('app_failures', 'app_attempts', 2)} AS app_failure_rate_pct,
       {ratio('declined_card_payments', 'card_payment_attempts', 2)} AS card_decline_rate_pct
FROM spine LEFT JOIN month_ops USING (month_start) LEFT JOIN month_money USING (month_start)""")
CHECKS["monthly_ops"] = check(["month_ops"], "SELECT * FROM month_ops")
CHECKS["monthly_money"] = check(["month_money"], "SELECT * FROM month_money")
CHECKS["v_monthly_kpis"] = check(["kpis"], "SELECT * FROM kpis")

# ---------------------------------------------------------------- questions
_IS = {code: f"lifecycle_status = '{code}'" for code in ("ACTIVE", "DORMANT", "NEVER_FUNDED", "CLOSED")}


def _count(condition: str) -> str:
    return n(f"count(*) FILTER (WHERE {condition})")


relation("q01", ["v"], f"""
SELECT {n('count(DISTINCT customer_id)')} AS customers, {n('count(*)')} AS accounts,
       {_count(_IS['ACTIVE'])} AS active_accounts, {_count(_IS['DORMANT'])} AS dormant_accounts,
       {_count(_IS['NEVER_FUNDED'])} AS never_funded_accounts, {_count(_IS['CLOSED'])} AS closed_accounts,
       {ratio(_count(_IS['ACTIVE']), 'count(*)', 1)} AS active_rate_pct,
       {euros('sum(balance_at_period_end)')} AS total_balances,
       {euros(f"sum(balance_at_period_end) FILTER (WHERE {_IS['DORMANT']})")} AS dormant_balances,
       {euros('sum(total_deposits)')} AS total_deposits, {euros('sum(card_spend)')} AS total_card_spend,
       {mean(f"sum(balance_at_period_end) FILTER (WHERE {_IS['ACTIVE']})", _count(_IS['ACTIVE']))} AS avg_balance_active_account
FROM v""")
CHECKS["q01_global_kpis"] = check(["q01"], "SELECT * FROM q01")
relation("q02", ["kpis"], f"""
SELECT month_start, new_accounts, {n('sum(new_accounts) OVER (ORDER BY month_start)')} AS cumulative_accounts, active_accounts,
       {ratio('(active_accounts - before)', 'before', 1)} AS active_accounts_mom_pct, closed_accounts, deposits_amount,
       card_spend_amount, {mean('card_spend_amount', 'active_accounts')} AS card_spend_per_active_account,
       app_failure_rate_pct, card_decline_rate_pct
FROM (SELECT *, lag(active_accounts) OVER (ORDER BY month_start) AS before FROM kpis) AS k""")
CHECKS["q02_monthly_trend"] = check(["q02"], "SELECT * FROM q02")
relation("eligible", ["v"], f"SELECT * FROM v WHERE opened_at <= {END} - INTERVAL 30 DAY")
CHECKS["q03_activation_by_channel"] = check(["eligible"], f"""
SELECT signup_channel, {n('count(*)')} AS accounts, {n('count(first_deposit_at)')} AS funded_accounts,
       {ratio(_count('days_to_first_deposit <= 7'), 'count(*)', 1)} AS funded_within_7_days_pct,
       {ratio(_count('days_to_first_deposit <= 30'), 'count(*)', 1)} AS funded_within_30_days_pct,
       {ratio('sum(days_to_first_deposit)', 'count(days_to_first_deposit)', 1, times=1)} AS avg_days_to_first_deposit,
       {ratio(_count(_IS['ACTIVE']), 'count(*)', 1)} AS active_rate_pct,
       {ratio(_count(_IS['NEVER_FUNDED']), 'count(*)', 1)} AS never_funded_pct
FROM eligible GROUP BY signup_channel""")
relation("detail", ["eligible"], """
SELECT account_id, signup_channel, days_to_first_deposit, COALESCE(days_to_first_deposit, 9999) <= 30 AS funded_within_30_days,
       lifecycle_status FROM eligible""")
CHECKS["q03b_activation_detail"] = check(["detail"], "SELECT * FROM detail")
CHECKS["q04_lifecycle_by_age_band"] = check(["v"], f"""
SELECT age_band, {n('count(*)')} AS accounts,
       {', '.join(f"{ratio(_count(_IS[code]), 'count(*)', 1)} AS {code.lower()}_pct" for code in _IS)},
       {mean(f"sum(balance_at_period_end) FILTER (WHERE {_IS['ACTIVE']})", _count(_IS['ACTIVE']), 0)} AS avg_balance_active,
       {mean('sum(card_spend) FILTER (WHERE first_deposit_at IS NOT NULL)', 'count(first_deposit_at)', 0)} AS avg_card_spend_funded
FROM v GROUP BY age_band""")

relation("active_months", ["log_as_of"], f"""
SELECT account_id, m FROM log_as_of WHERE {ACTIVE} AND account_id IS NOT NULL GROUP BY account_id, m""")
_ELAPSED = "CAST(datediff('month', p.cohort_month, a.m) AS INTEGER)"
relation("cohorts", ["profiles", "active_months"], f"""
SELECT p.cohort_month, s.cohort_size, {_ELAPSED} AS months_since_opening, {n('count(*)')} AS active_accounts
FROM profiles p JOIN active_months a USING (account_id)
JOIN (SELECT cohort_month, {n('count(*)')} AS cohort_size FROM profiles GROUP BY 1) s ON s.cohort_month = p.cohort_month
GROUP BY ALL""")
relation("q05", ["cohorts"], f"SELECT *, {ratio('active_accounts', 'cohort_size', 1)} AS retention_pct FROM cohorts")
CHECKS["q05_cohort_retention"] = check(["q05"], "SELECT * FROM q05")

relation("q06", ["v"], f"""
SELECT balance_decile, accounts, min_balance, total_balance,
       {money_ratio('total_balance', 'sum(total_balance) OVER ()')} AS share_pct,
       {money_ratio('sum(total_balance) OVER (ORDER BY balance_decile)', 'sum(total_balance) OVER ()')} AS cumulative_share_pct
FROM (SELECT CAST(tenth AS INTEGER) AS balance_decile, {n('count(*)')} AS accounts,
             CAST(min(b) AS DECIMAL(18,2)) AS min_balance, {euros('sum(b)')} AS total_balance
      FROM (SELECT balance_at_period_end AS b, ntile(10) OVER (ORDER BY balance_at_period_end DESC) AS tenth
            FROM v WHERE lifecycle_status <> 'CLOSED') AS t
      GROUP BY tenth) AS d""")
CHECKS["q06_balance_concentration"] = check(["q06"], "SELECT * FROM q06")
relation("q07", ["txn_as_of", "categories"], f"""
SELECT category, is_essential, payments, total_spend, {mean('total_spend', 'payments')} AS avg_ticket,
       {money_ratio('total_spend', 'sum(total_spend) OVER ()')} AS spend_share_pct,
       CAST(rank() OVER (ORDER BY total_spend DESC) AS INTEGER) AS spend_rank
FROM (SELECT label_fr AS category, is_essential, {n('count(*)')} AS payments, {euros('sum(amount)')} AS total_spend
      FROM txn_as_of, categories WHERE txn_type = 'CARD_PAYMENT' AND category_code = merchant_category
      GROUP BY ALL) AS c""")
CHECKS["q07_card_spend_by_category"] = check(["q07"], "SELECT * FROM q07")
relation("q08", ["log_as_of"], f"""
SELECT event_type, failure_reason, failures, attempts, {ratio('failures', 'attempts', 2)} AS failure_rate_pct,
       {ratio('failures', 'sum(failures) OVER ()', 1)} AS share_of_all_failures_pct, amount_refused
FROM (SELECT event_type, failure_reason, {n('count(*)')} AS failures, CAST(sum(amount_requested) AS DECIMAL(18,2)) AS amount_refused
      FROM log_as_of WHERE status = 'FAILED' GROUP BY ALL) AS f
JOIN (SELECT event_type, {n('count(*)')} AS attempts FROM log_as_of GROUP BY ALL) AS t USING (event_type)""")
CHECKS["q08_failures_by_reason"] = check(["q08"], "SELECT * FROM q08")
CHECKS["q09_card_number_errors"] = check(["log_as_of"], f"""
SELECT event_type, {_count("failure_reason = 'INVALID_CARD_NUMBER'")} AS stopped_by_luhn_check,
       {_count("failure_reason = 'UNKNOWN_CARD'")} AS reached_database_lookup, {n('count(*)')} AS card_number_errors,
       {ratio(_count("failure_reason = 'INVALID_CARD_NUMBER'"), 'count(*)', 1)} AS luhn_interception_pct
FROM log_as_of
WHERE event_type IN ('TRANSFER', 'LOGIN') AND failure_reason IN ('UNKNOWN_CARD', 'INVALID_CARD_NUMBER') GROUP BY event_type""")
CHECKS["q10_declined_payments_concentration"] = check(["v"], f"""
SELECT declines_band, accounts, {ratio('accounts', 'sum(accounts) OVER ()', 1)} AS accounts_pct, declined_payments,
       {ratio('declined_payments', 'sum(declined_payments) OVER ()', 1)} AS declines_pct
FROM (SELECT CASE WHEN d >= 10 THEN '10 refus ou plus' WHEN d >= 3 THEN '3 à 9 refus' WHEN d >= 1 THEN '1 à 2 refus'
                  ELSE '0 refus' END AS declines_band, {n('count(*)')} AS accounts, {n('sum(d)')} AS declined_payments
      FROM (SELECT declined_card_payments AS d FROM v WHERE declined_card_payments > 0 OR card_payments > 0) AS x
      GROUP BY 1) AS b""")
relation("q11", ["v"], """
SELECT account_id, customer_id, signup_channel, age_band, last_activity_at, days_since_last_activity, balance_at_period_end,
       card_payments FROM v WHERE days_since_last_activity >= 45 AND lifecycle_status = 'ACTIVE'""")
CHECKS["q11_dormancy_watchlist"] = check(["q11"], "SELECT * FROM q11")
relation("q12", ["v", "recent_log", "txn_as_of"], f"""
SELECT account_id, signup_channel, age_band, lifecycle_status, days_since_last_activity AS recency_days,
       {n('(SELECT count(*) FROM recent_log r WHERE r.account_id = v.account_id)')} AS frequency_180d,
       {euros(f"(SELECT sum(t.amount) FROM txn_as_of t WHERE t.from_account_id = v.account_id AND t.txn_type = 'CARD_PAYMENT' AND t.created_at > {END} - INTERVAL 180 DAY)")} AS card_spend_180d,
       balance_at_period_end
FROM v WHERE lifecycle_status NOT IN ('CLOSED', 'NEVER_FUNDED')""")
CHECKS["q12_rfm_base"] = check(["q12"], "SELECT * FROM q12")

# ---------------------------------------------------------------- derived
CHECKS["status_shares"] = check(["v"], f"""
SELECT s.lifecycle_status, {n('count(v.account_id)')} AS accounts,
       {ratio('count(v.account_id)', 'sum(count(v.account_id)) OVER ()', 1)} AS share_pct
FROM (VALUES ('ACTIVE'), ('DORMANT'), ('NEVER_FUNDED'), ('CLOSED')) AS s(lifecycle_status)
LEFT JOIN v ON v.lifecycle_status = s.lifecycle_status GROUP BY s.lifecycle_status""")
CHECKS["peak_month"] = check(["kpis"], "SELECT month_start, new_accounts FROM kpis ORDER BY 2 DESC, 1 LIMIT 1")
CHECKS["last_month"] = check(["q02"], "SELECT * FROM q02 ORDER BY month_start DESC LIMIT 1")
CHECKS["activation_crosstab"] = check(["detail"], f"""
SELECT signup_channel, {_count('NOT funded_within_30_days')} AS not_funded, {_count('funded_within_30_days')} AS funded
FROM detail GROUP BY signup_channel""")
_MONTHS = 72
CHECKS["retention_matrix"] = check(["q05"], f"""
SELECT strftime(cohort_month, '%Y-%m') AS cohort,
       {', '.join(f'max(retention_pct) FILTER (WHERE months_since_opening = {i}) AS m{i:02d}' for i in range(_MONTHS))},
       string_agg(months_since_opening || ':' || retention_pct, ' ' ORDER BY months_since_opening) FILTER (WHERE months_since_opening < 0) AS before_opening,
       string_agg(months_since_opening || ':' || retention_pct, ' ' ORDER BY months_since_opening) FILTER (WHERE months_since_opening >= {_MONTHS}) AS after_period
FROM q05 GROUP BY cohort_month""")
CHECKS["retention_mean"] = check(["q05"], f"""
SELECT months_since_opening, {n('count(*)')} AS cohorts, {ratio('sum(retention_pct * 10)', 'count(*) * 10', 2, times=1)} AS mean_retention_pct
FROM q05 WHERE months_since_opening IN (1, 3, 6, 12) GROUP BY months_since_opening""")
CHECKS["concentration_curve"] = check(["q06"], """
SELECT CAST(0 AS INTEGER) AS accounts_pct, CAST(0 AS DECIMAL(18,1)) AS balance_pct
UNION ALL SELECT balance_decile * 10, cumulative_share_pct FROM q06""")
CHECKS["top_failures"] = check(["q08"], f"""
SELECT {mapping('event_type', EVENT_LABELS)} || ' : ' || {mapping('failure_reason', REASON_LABELS)} AS label, failures, failure_rate_pct
FROM (SELECT * FROM q08 ORDER BY failures DESC, event_type, failure_reason LIMIT 6) AS t""")
CHECKS["watchlist_summary"] = check(["q11"], f"SELECT {n('count(*)')} AS accounts, {euros('sum(balance_at_period_end)')} AS balance FROM q11")
CHECKS["watchlist_top10"] = check(["q11"], "SELECT * FROM q11 ORDER BY balance_at_period_end DESC, account_id LIMIT 10")
CHECKS["essential_share"] = check(["q07"], f"""
SELECT is_essential, {euros('sum(total_spend)')} AS total_spend,
       {money_ratio('sum(total_spend)', '(SELECT sum(total_spend) FROM q07)')} AS share_pct FROM q07 GROUP BY is_essential""")

# ---------------------------------------------------------------- chi-square
# The upper tail for one degree of freedom is erfc(sqrt(x/2)) = 2/sqrt(pi) * integral of exp(-t^2),
# summed here with Simpson's rule.
_ERFC = """(1 - 2 / sqrt(pi()) * (SELECT sum(CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
            * exp(-power(i * sqrt(chi2 / 2) / 2000, 2))) * sqrt(chi2 / 2) / 2000 / 3 FROM generate_series(0, 2000) AS g(i)))"""


def _chi(where: str) -> str:
    return check(["detail"], f"""
, picked AS (SELECT * FROM detail WHERE {where}),
cells AS (
SELECT c.signup_channel, f.funded, (SELECT count(*) FROM picked d WHERE d.signup_channel = c.signup_channel AND d.funded_within_30_days = f.funded) AS observed,
       CAST((SELECT count(*) FROM picked d WHERE d.signup_channel = c.signup_channel) AS DOUBLE)
       * (SELECT count(*) FROM picked d WHERE d.funded_within_30_days = f.funded) / (SELECT count(*) FROM picked) AS expected
FROM (SELECT DISTINCT signup_channel FROM picked) AS c, (SELECT DISTINCT funded_within_30_days AS funded FROM picked) AS f),
shape AS (SELECT count(DISTINCT signup_channel) AS r, count(DISTINCT funded) AS c, sum(observed) AS n FROM cells),
stat AS (
SELECT sum(power(abs(observed - expected) - CASE WHEN (r - 1) * (c - 1) = 1 THEN least(0.5, abs(observed - expected)) ELSE 0 END, 2) / expected) AS chi2,
       any_value((r - 1) * (c - 1)) AS dof, any_value(n) AS n, any_value(least(r, c) - 1) AS smaller
FROM cells, shape)
SELECT {n('n')} AS n, CAST(round(chi2, 6) AS DECIMAL(18,6)) AS chi2, CAST(dof AS INTEGER) AS dof,
       CAST(round(CASE dof WHEN 2 THEN exp(-chi2 / 2) WHEN 1 THEN {_ERFC} ELSE 1 END, 6) AS DECIMAL(18,6)) AS p_value,
       CAST(round(sqrt(chi2 / nullif(n * smaller, 0)), 6) AS DECIMAL(18,6)) AS cramers_v
FROM stat""")


CHECKS["chi2_channels"] = _chi("true")
CHECKS["chi2_mobile_web"] = _chi("signup_channel <> 'PARTNER'")

# ---------------------------------------------------------------- RFM
relation("scores", ["q12"], """
SELECT q12.*, CAST(CASE WHEN recency_days IS NULL OR recency_days > 90 THEN 1 WHEN recency_days > 60 THEN 2
                   WHEN recency_days > 30 THEN 3 WHEN recency_days > 7 THEN 4 ELSE 5 END AS INTEGER) AS R,
       CAST(greatest(1, ceil(5 * (rf - 1)::DECIMAL(18,0) / nullif(total - 1, 0))) AS INTEGER) AS F,
       CAST(greatest(1, ceil(5 * (rm - 1)::DECIMAL(18,0) / nullif(total - 1, 0))) AS INTEGER) AS M, rb, total
FROM q12 JOIN (SELECT account_id, row_number() OVER (ORDER BY frequency_180d, account_id) AS rf,
                      row_number() OVER (ORDER BY card_spend_180d, account_id) AS rm,
                      row_number() OVER (ORDER BY balance_at_period_end) AS rb, count(*) OVER () AS total FROM q12) AS r
USING (account_id)""")
relation("p75", ["scores"], """
SELECT 4 * lo + (hi - lo) * part AS four_times
FROM (SELECT max(balance_at_period_end) FILTER (WHERE rb = (total - 1) * 3 // 4 + 1) AS lo,
             COALESCE(max(balance_at_period_end) FILTER (WHERE rb = (total - 1) * 3 // 4 + 2),
                      max(balance_at_period_end) FILTER (WHERE rb = (total - 1) * 3 // 4 + 1)) AS hi,
             any_value((total - 1) * 3 % 4) AS part FROM scores) AS e""")
relation("segments", ["scores", "p75"], f"""
SELECT s.* EXCLUDE (rb, total),
       CASE WHEN least(R, F, M) >= 4 THEN '{SEGMENTS[0]}'
            WHEN F < 3 AND balance_at_period_end * 4 >= (SELECT four_times FROM p75) THEN '{SEGMENTS[2]}'
            WHEN R = 1 THEN '{SEGMENTS[5]}' WHEN R < 4 THEN '{SEGMENTS[4]}' WHEN F > 2 THEN '{SEGMENTS[1]}'
            ELSE '{SEGMENTS[3]}' END AS segment
FROM scores s""")
CHECKS["rfm_recency"] = check(["scores"], "SELECT account_id, recency_days, R FROM scores")
CHECKS["rfm_frequency"] = check(["scores"], "SELECT account_id, frequency_180d, F FROM scores")
CHECKS["rfm_monetary"] = check(["scores"], "SELECT account_id, card_spend_180d, M FROM scores")
CHECKS["rfm_high_balance"] = check(["q12"], """
SELECT CAST(quantile_cont(CAST(balance_at_period_end AS DOUBLE), 0.75) AS DECIMAL(18,4)) AS high_balance FROM q12""")
CHECKS["rfm_segments"] = check(["segments"], "SELECT * FROM segments")
CHECKS["segment_profile"] = check(["segments"], f"""
SELECT o.segment, {rank_of('o.segment', SEGMENTS)} AS ordre, comptes, recence_moy_jours, operations_180j, depenses_carte_180j,
       solde_moyen, encours, {ratio('comptes', 'sum(comptes) OVER ()', 1)} AS part_comptes_pct,
       {money_ratio('encours', 'sum(encours) OVER ()')} AS part_encours_pct
FROM (VALUES {', '.join(f"('{s}')" for s in SEGMENTS)}) AS o(segment)
LEFT JOIN (SELECT segment, {n('count(*)')} AS comptes, {ratio('sum(recency_days)', 'count(recency_days)', 1, times=1)} AS recence_moy_jours,
                  {ratio('sum(frequency_180d)', 'count(*)', 1, times=1)} AS operations_180j,
                  {mean('sum(card_spend_180d)', 'count(*)', 1)} AS depenses_carte_180j,
                  {mean('sum(balance_at_period_end)', 'count(*)', 1)} AS solde_moyen, {euros('sum(balance_at_period_end)')} AS encours
           FROM segments GROUP BY segment) AS g USING (segment)""")
# a delivery onto a layer changes how rows are reached, not what is asked
CHECKS["v_account_activity_after_delivery"] = CHECKS["v_account_activity"]
CHECKS["v_monthly_kpis_after_delivery"] = CHECKS["v_monthly_kpis"]
