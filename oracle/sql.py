"""DuckDB SQL for every registered query, over the same Parquet tables.

Each statement is put together from named parts: the derivation of the raw tables, the
cleaned tables, the marts, and a final SELECT. Written for checking, not for speed: wide
joins, integer arithmetic for every rounding, no shared code with the Spark side.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-09-30'"


# ---- small SQL writers ---------------------------------------------------------------


def pad(prefix: str, width: int, key: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"('{prefix}' || CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END)"


def ratio(n: str, d: str, scale: int, places: int) -> str:
    """n * scale / d, half away from zero, by integer division. n and d must be whole numbers, d not negative."""
    k = scale * 10**places
    return f"CAST(sign({n}) * ((2 * {k} * abs({n}) + ({d})) // (2 * nullif({d}, 0))) AS DOUBLE) / {10**places}"


def pct(n: str, d: str, places: int = 2) -> str:
    return ratio(f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)", 100, places)


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def money_pct(n: str, d: str) -> str:
    return ratio(cents(n), cents(d), 100, 2)


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def months_between(later: str, earlier: str) -> str:
    return f"date_diff('month', {earlier}, {later})"


# The states of the derived tables.
STATE = "['wa', 'in', 'oh', 'tx', 'ny', 'ca', 'fl', 'or', 'va', 'nm'][n % 10 + 1]"

# ---- parts ---------------------------------------------------------------------------

PARTS: dict[str, str] = {}

PARTS["a0"] = f"""
SELECT {pad('AGT', 6, 's_suppkey')} AS agent_id, '  ' || s_name || ' ' AS agent_name,
       ' Agency ' || s_nationkey AS agency_name, {STATE.replace('n %', 's_nationkey %')} AS state,
       'Agent' || s_suppkey || '@Example.com' AS email, CAST(NULL AS VARCHAR) AS phone,
       DATE '1990-01-05' + CAST(s_suppkey * 37 % 1900 AS INTEGER) AS hire_date, s_suppkey % 8 <> 0 AS is_active,
       ['Bronze','Bronze','Bronze','Bronze','Silver','Silver','Silver','Gold','Gold','Platinum'][s_suppkey % 10 + 1]
         AS tier
FROM supplier"""

PARTS["m0"] = f"""
SELECT c_custkey, {pad('MEM', 9, 'c_custkey')} AS member_id, ' Customer' AS first_name,
       substr(c_name, 10) || ' ' AS last_name, lower(c_name) || '@Example.com' AS email,
       CAST(NULL AS VARCHAR) AS phone, DATE '1935-01-01' + CAST(c_custkey * 7919 % 24000 AS INTEGER) AS dob,
       {STATE.replace('n %', 'c_nationkey %')} AS state, lpad(CAST(c_custkey * 13 % 100000 AS VARCHAR), 5, '0') AS zip_code,
       DATE '1994-06-15' + CAST(c_custkey % 180 AS INTEGER) AS enrollment_date,
       {pad('AGT', 6, 'c_custkey % ((SELECT count(*) FROM supplier) - 1)')} AS agent_id,
       ['MetLife', 'VSP', 'Zurich'][c_nationkey % 3 + 1] AS carrier,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Dental Basic' WHEN 'BUILDING' THEN 'Dental Premium'
            WHEN 'FURNITURE' THEN 'Vision Basic' WHEN 'HOUSEHOLD' THEN 'Vision Premium'
            ELSE 'Dental+Vision Bundle' END AS plan_type
FROM customer"""

PARTS["price"] = """
SELECT * FROM (VALUES ('Dental Basic', 2999, 0.18), ('Dental Premium', 5499, 0.22), ('Vision Basic', 1999, 0.16),
       ('Vision Premium', 3499, 0.20), ('Dental+Vision Bundle', 7499, 0.25)) v(plan_type, base_cents, rate)"""

PARTS["p1"] = f"""
SELECT o.o_orderkey, {pad('POL', 9, 'o.o_orderkey')} AS policy_id, m0.member_id, m0.agent_id, m0.carrier,
       m0.plan_type, CAST(o.o_orderdate AS DATE) AS signed_on,
       CAST(date_trunc('month', o.o_orderdate) + INTERVAL 1 MONTH AS DATE) AS effective_date,
       CAST(CASE left(o.o_orderpriority, 1) WHEN '1' THEN 6 WHEN '2' THEN 12 WHEN '3' THEN 12 WHEN '4' THEN 24
            WHEN '5' THEN 36 END AS BIGINT) AS term_months,
       CAST(CAST(price.base_cents * (950 + o.o_orderkey % 101) // 1000 AS DECIMAL(12, 0)) / 100 AS DECIMAL(12, 2))
         AS monthly_premium,
       CAST(price.rate AS DECIMAL(5, 4)) AS commission_rate,
       CASE WHEN o.o_orderkey % 33 = 0 THEN 'Pending' WHEN o.o_orderstatus = 'F' THEN 'Cancelled'
            WHEN o.o_orderstatus = 'O' THEN 'Expired' WHEN o.o_orderstatus = 'P' THEN 'Active' END AS status
FROM orders o JOIN m0 ON m0.c_custkey = o.o_custkey JOIN price ON price.plan_type = m0.plan_type"""

PARTS["p0"] = """
SELECT *, CAST(effective_date + to_months(CAST(term_months AS INTEGER)) AS DATE) AS expiry_date,
       CAST(monthly_premium * 12 AS DECIMAL(12, 2)) AS annual_premium,
       CAST(round(monthly_premium * commission_rate, 2) AS DECIMAL(12, 2)) AS monthly_commission
FROM p1"""

PARTS["y1"] = """
SELECT l.*, p0.*,
       CAST(p0.effective_date + to_months(l.l_linenumber - 1) AS DATE) AS due_date,
       CASE WHEN l_returnflag = 'R' AND l_discount > 0.085 THEN 'Failed'
            WHEN l_returnflag = 'A' AND l_discount > 0.075 THEN 'Paid_Late' ELSE 'Paid' END AS payment_status
FROM lineitem l JOIN p0 ON p0.o_orderkey = l.l_orderkey WHERE p0.status <> 'Pending'"""

PARTS["y0"] = """
SELECT 'PAY' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) AS payment_id,
       policy_id, member_id, due_date,
       CASE payment_status WHEN 'Paid' THEN due_date + CAST(l_quantity AS INTEGER) % 4
            WHEN 'Paid_Late' THEN due_date + 4 + CAST(l_quantity AS INTEGER) % 27 END AS paid_date,
       monthly_premium AS amount_due,
       CAST(CASE payment_status WHEN 'Failed' THEN 0 ELSE monthly_premium END AS DECIMAL(12, 2)) AS amount_paid,
       payment_status, ['credit_card', 'ACH', 'check'][l_suppkey % 3 + 1] AS payment_method, carrier, plan_type
FROM y1"""

PARTS["c1"] = f"""
SELECT p0.*, {pad('CAN', 9, 'o_orderkey')} AS cancellation_id,
       effective_date + CAST(30 + o_orderkey * 31 % 300 AS INTEGER) AS cancellation_date,
       CASE WHEN o_orderkey % 20 < 7 THEN 'NON_PAYMENT' WHEN o_orderkey % 20 < 12 THEN 'member_request'
            WHEN o_orderkey % 20 < 15 THEN 'employer_change' WHEN o_orderkey % 20 < 17 THEN 'moved_out_of_area'
            WHEN o_orderkey % 20 < 19 THEN 'plan_upgrade' ELSE 'deceased' END AS cancellation_reason
FROM p0 WHERE status = 'Cancelled'"""

PARTS["c0"] = """
SELECT *, greatest(1, (cancellation_date - effective_date) // 30) AS months_active,
       CAST(monthly_premium * greatest(1, (cancellation_date - effective_date) // 30) AS DECIMAL(12, 2)) AS lifetime_value,
       cancellation_reason = 'NON_PAYMENT' AS was_payment_failure
FROM c1"""

PARTS["sa"] = f"""
SELECT agent_id, trim(agent_name) AS agent_name, trim(agency_name) AS agency_name, upper(state) AS state,
       lower(email) AS email, phone, hire_date, is_active, lower(tier) AS tier,
       {months_between(AS_OF, 'hire_date')} AS months_tenure,
       CAST(coalesce(nullif(list_position(['bronze', 'silver', 'gold', 'platinum'], lower(tier)), 0), 1) AS BIGINT)
         AS tier_rank
FROM a0"""

PARTS["sm"] = f"""
SELECT member_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       trim(first_name) || ' ' || trim(last_name) AS full_name, lower(email) AS email, phone, dob,
       upper(state) AS state, zip_code, enrollment_date, agent_id, carrier, plan_type,
       date_diff('year', dob, {AS_OF}) AS age_years,
       CASE WHEN date_diff('year', dob, {AS_OF}) BETWEEN 0 AND 29 THEN 'under_30'
            WHEN date_diff('year', dob, {AS_OF}) BETWEEN 30 AND 44 THEN '30_to_44'
            WHEN date_diff('year', dob, {AS_OF}) BETWEEN 45 AND 59 THEN '45_to_59' ELSE '60_plus' END AS age_bucket,
       year(enrollment_date) AS enrollment_year, month(enrollment_date) AS enrollment_month,
       CASE split_part(replace(plan_type, 'Dental+Vision Bundle', 'Bundle'), ' ', 1) WHEN 'Bundle' THEN 'bundle'
            WHEN 'Dental' THEN 'dental' ELSE 'vision' END AS plan_category
FROM m0"""

PARTS["sp"] = f"""
SELECT policy_id, member_id, agent_id, carrier, plan_type, effective_date, expiry_date, monthly_premium,
       annual_premium, commission_rate, monthly_commission, lower(status) AS policy_status, term_months,
       CAST(monthly_commission * 12 AS DECIMAL(12, 2)) AS annual_commission,
       status = 'Active' AND effective_date <= {AS_OF} AND {AS_OF} <= expiry_date AS is_currently_eligible,
       CAST(expiry_date - effective_date AS BIGINT) AS policy_duration_days
FROM p0"""

PARTS["sy"] = """
SELECT payment_id, policy_id, member_id, due_date, paid_date, amount_due, amount_paid,
       lower(payment_status) AS payment_status, lower(payment_method) AS payment_method, carrier, plan_type,
       coalesce(payment_status = 'Failed', FALSE) AS is_failed, coalesce(payment_status = 'Paid_Late', FALSE) AS is_late,
       CAST(paid_date - due_date AS BIGINT) AS days_to_pay,
       CAST(amount_due - amount_paid AS DECIMAL(12, 2)) AS payment_gap,
       year(due_date) AS due_year, month(due_date) AS due_month, strftime(due_date, '%Y-%m') AS due_period
FROM y0"""

PARTS["sc"] = """
SELECT cancellation_id, policy_id, member_id, agent_id, cancellation_date,
       lower(cancellation_reason) AS cancellation_reason, months_active, lifetime_value, carrier, plan_type,
       was_payment_failure,
       CASE WHEN lower(cancellation_reason) IN ('non_payment', 'deceased') THEN 'involuntary' ELSE 'voluntary' END
         AS churn_type,
       months_active < 4 AS is_early_cancel, year(cancellation_date) AS cancel_year,
       month(cancellation_date) AS cancel_month, strftime(cancellation_date, '%Y-%m') AS cancel_period
FROM c0"""

PARTS["da"] = f"""
SELECT sa.agent_id, agent_name, agency_name, state, email, hire_date, is_active, tier, tier_rank, months_tenure,
       (SELECT count(DISTINCT member_id) FROM sm WHERE sm.agent_id = sa.agent_id) AS total_members,
       coalesce(np, 0) AS total_policies, coalesce(na, 0) AS active_policies, coalesce(nx, 0) AS cancelled_policies,
       coalesce(v1, 0) AS total_monthly_premium, coalesce(v2, 0) AS total_monthly_commission,
       coalesce(v3, 0) AS total_annual_commission,
       (SELECT count(*) FROM sc WHERE sc.agent_id = sa.agent_id) AS total_cancellations,
       (SELECT count(*) FROM sc WHERE sc.agent_id = sa.agent_id AND churn_type = 'involuntary')
         AS involuntary_cancellations,
       {pct('nx', 'np')} AS cancellation_rate_pct
FROM sa LEFT JOIN (
  SELECT agent_id, count(*) AS np, count(*) FILTER (policy_status = 'active') AS na,
         count(*) FILTER (policy_status = 'cancelled') AS nx, sum(monthly_premium) AS v1,
         sum(monthly_commission) AS v2, sum(annual_commission) AS v3
  FROM sp GROUP BY ALL) t ON t.agent_id = sa.agent_id"""

PARTS["fp"] = """
SELECT sy.payment_id, sy.policy_id, sy.member_id, sm.agent_id, sa.agent_name, sa.agency_name, sa.tier AS agent_tier,
       sy.due_date, sy.paid_date, sy.due_year, sy.due_month, sy.due_period, sy.amount_due, sy.amount_paid,
       sy.payment_gap, sy.payment_status, sy.payment_method, sy.is_failed, sy.is_late, sy.days_to_pay, sy.carrier,
       sy.plan_type, sm.plan_category, sm.state, sm.age_bucket,
       CAST(CASE WHEN payment_status <> 'failed' THEN round(amount_paid * commission_rate, 2) ELSE 0 END
            AS DECIMAL(12, 2)) AS commission_earned,
       CASE payment_status WHEN 'paid_late' THEN 'collected_late' WHEN 'failed' THEN 'uncollected' ELSE 'collected_on_time' END
         AS collection_status
FROM sy LEFT JOIN sp ON sp.policy_id = sy.policy_id LEFT JOIN sm ON sm.member_id = sy.member_id
        LEFT JOIN sa ON sa.agent_id = sm.agent_id"""

PARTS["fc"] = f"""
SELECT sc.cancellation_id, sc.policy_id, sc.member_id, sc.agent_id, sa.agent_name, sa.agency_name,
       sa.tier AS agent_tier, sm.full_name AS member_name, sm.state, sm.age_bucket, sm.plan_category,
       sc.cancellation_date, sc.cancel_period, sc.cancel_year, sc.cancel_month, sc.cancellation_reason,
       sc.churn_type, sc.is_early_cancel, sc.months_active, sc.lifetime_value, sc.was_payment_failure, sc.carrier,
       sc.plan_type, sp.monthly_premium, sp.effective_date AS policy_start_date, lp.d AS last_paid_date,
       {months_between('sc.cancellation_date', 'lp.d')} AS months_since_last_payment,
       CAST(sp.monthly_premium * 12 AS DECIMAL(12, 2)) AS annualized_revenue_lost
FROM sc LEFT JOIN sp ON sp.policy_id = sc.policy_id LEFT JOIN sm ON sm.member_id = sc.member_id
        LEFT JOIN sa ON sa.agent_id = sc.agent_id
        LEFT JOIN (SELECT policy_id, max(paid_date) AS d FROM sy WHERE payment_status <> 'failed' GROUP BY ALL) lp
               ON lp.policy_id = sc.policy_id"""

PARTS["gc"] = """
SELECT agent_id, cancel_period, count(*) AS n, count(*) FILTER (churn_type = 'involuntary') AS ni,
       sum(annualized_revenue_lost) AS lost
FROM fc GROUP BY ALL"""


def _billed(*keys: str) -> str:
    extra = "".join(f", {k}" for k in keys)
    return f"""
SELECT agent_id, agent_name, agency_name, agent_tier, due_period, due_year, due_month{extra},
       count(payment_id) AS np, count(*) FILTER (payment_status = 'paid') AS n1,
       count(*) FILTER (payment_status = 'paid_late') AS n2, count(*) FILTER (payment_status = 'failed') AS n3,
       count(DISTINCT member_id) AS nm, sum(amount_due) AS v1, sum(amount_paid) AS v2, sum(payment_gap) AS v3,
       sum(commission_earned) AS v4
FROM fp GROUP BY ALL"""


PARTS["gb"] = _billed("carrier")
PARTS["gm"] = _billed()

PARTS["cs"] = f"""
SELECT gb.agent_id, agent_name, agency_name, agent_tier, due_period AS period, due_year AS year, due_month AS month,
       carrier, np AS total_payments_due, n1 AS paid_on_time, n2 AS paid_late, n3 AS payments_failed,
       nm AS active_members_billed, v1 AS total_amount_due, v2 AS total_amount_collected, v3 AS total_uncollected,
       v4 AS total_commission_earned, coalesce(gc.n, 0) AS members_churned, coalesce(gc.ni, 0) AS involuntary_churns,
       coalesce(gc.lost, 0) AS revenue_lost_to_churn, {money_pct('v2', 'v1')} AS collection_rate_pct,
       {pct('n3', 'np')} AS failure_rate_pct
FROM gb LEFT JOIN gc ON gc.agent_id = gb.agent_id AND gc.cancel_period = gb.due_period"""

PARTS["cm"] = f"""
SELECT sa.agent_id, sa.agent_name, sa.agency_name, sa.tier AS agent_tier,
       coalesce(due_period, cancel_period) AS period,
       CAST(left(coalesce(due_period, cancel_period), 4) AS BIGINT) AS year,
       CAST(right(coalesce(due_period, cancel_period), 2) AS BIGINT) AS month,
       coalesce(np, 0) AS total_payments_due, coalesce(n1, 0) AS paid_on_time, coalesce(n2, 0) AS paid_late,
       coalesce(n3, 0) AS payments_failed, coalesce(nm, 0) AS active_members_billed,
       coalesce(v1, 0) AS total_amount_due, coalesce(v2, 0) AS total_amount_collected,
       coalesce(v3, 0) AS total_uncollected, coalesce(v4, 0) AS total_commission_earned,
       coalesce(gc.n, 0) AS members_churned, coalesce(gc.ni, 0) AS involuntary_churns,
       coalesce(gc.lost, 0) AS revenue_lost_to_churn, {money_pct('v2', 'v1')} AS collection_rate_pct,
       {pct('n3', 'np')} AS failure_rate_pct
FROM gm FULL JOIN gc ON gc.agent_id = gm.agent_id AND gc.cancel_period = gm.due_period
        JOIN sa ON sa.agent_id = coalesce(gm.agent_id, gc.agent_id)"""

SUMMARY_MONEY = (
    "total_amount_due", "total_amount_collected", "total_uncollected", "total_commission_earned",
    "revenue_lost_to_churn",
)


def shown(part: str, *money: str) -> str:
    """The whole part, its money columns as DOUBLE."""
    return f"SELECT * REPLACE ({dbl(*money)}) FROM {part}" if money else f"SELECT * FROM {part}"


def revenue_by_month(part: str, where: str = "TRUE") -> str:
    return f"""
SELECT due_period, due_year, due_month, CAST(sum(amount_due) AS DOUBLE) AS total_billed,
       CAST(sum(amount_paid) AS DOUBLE) AS total_collected, CAST(sum(payment_gap) AS DOUBLE) AS total_uncollected,
       count(*) FILTER (is_failed) AS failed_payments, {money_pct('sum(amount_paid)', 'sum(amount_due)')}
       AS collection_rate_pct, {pct('count(*) FILTER (is_failed)', 'count(*)')} AS failure_rate_pct
FROM {part} WHERE {where} GROUP BY 1, 2, 3"""


YTD = f"date_trunc('year', {AS_OF})"
MONTH = f"date_trunc('month', {AS_OF})"

PARTS["card"] = f"""
SELECT da.agent_id, da.agent_name, da.agency_name, da.tier, da.is_active,
       (SELECT count(DISTINCT member_id) FROM sp WHERE sp.agent_id = da.agent_id AND policy_status = 'active')
         AS active_members,
       coalesce(v, 0) AS ytd_commission, {money_pct('got', 'due')} AS collection_rate_pct,
       {pct('bad', 'np')} AS failure_rate_pct,
       (SELECT count(*) FROM sc WHERE sc.agent_id = da.agent_id) AS total_churns,
       coalesce(cancellation_rate_pct > (SELECT {pct("count(*) FILTER (policy_status = 'cancelled')", 'count(*)')} FROM sp),
                FALSE) AS is_high_churn
FROM da LEFT JOIN (
  SELECT agent_id, sum(commission_earned) FILTER (due_year = year({AS_OF})) AS v, sum(amount_due) AS due,
         sum(amount_paid) AS got, count(*) AS np, count(*) FILTER (is_failed) AS bad
  FROM fp GROUP BY ALL) t ON t.agent_id = da.agent_id"""

FINAL: dict[str, str] = {}

# raw, terms, schedule
FINAL["raw_agents"] = "SELECT * FROM a0"
FINAL["raw_members"] = "SELECT * EXCLUDE (c_custkey) FROM m0"
FINAL["raw_policies"] = f"""
SELECT policy_id, member_id, agent_id, carrier, plan_type, effective_date, expiry_date, status, term_months,
       {dbl('monthly_premium', 'annual_premium', 'commission_rate', 'monthly_commission')} FROM p0"""
FINAL["raw_payments"] = shown("y0", "amount_due", "amount_paid")
FINAL["raw_cancellations"] = f"""
SELECT cancellation_id, policy_id, member_id, agent_id, cancellation_date, cancellation_reason, months_active,
       {dbl('lifetime_value')}, carrier, plan_type, was_payment_failure FROM c0"""
FINAL["policy_terms"] = f"""
SELECT policy_id, signed_on, term_months, plan_type, effective_date, expiry_date,
       {dbl('monthly_premium', 'annual_premium', 'commission_rate', 'monthly_commission')} FROM p0"""
FINAL["cancellation_terms"] = f"""
SELECT cancellation_id, policy_id, effective_date, cancellation_date, cancellation_reason, months_active,
       {dbl('monthly_premium', 'lifetime_value')}, was_payment_failure FROM c0"""
FINAL["billing_schedule"] = f"""
SELECT policy_id, member_id, k + 1 AS instalment, CAST(effective_date + to_months(CAST(k AS INTEGER)) AS DATE) AS due_date,
       CAST(monthly_premium AS DOUBLE) AS amount_due, carrier, plan_type
FROM sp JOIN range(0, 37) r(k) ON effective_date + to_months(CAST(k AS INTEGER)) <= least(expiry_date, {AS_OF})
WHERE policy_status <> 'pending'"""

# staging and marts
FINAL["stg_agents"] = shown("sa")
FINAL["stg_members"] = shown("sm")
FINAL["stg_policies"] = shown(
    "sp", "monthly_premium", "annual_premium", "commission_rate", "monthly_commission", "annual_commission"
)
FINAL["stg_payments"] = shown("sy", "amount_due", "amount_paid", "payment_gap")
FINAL["stg_cancellations"] = shown("sc", "lifetime_value")
FINAL["dim_agents"] = shown("da", "total_monthly_premium", "total_monthly_commission", "total_annual_commission")
FINAL["fct_payments"] = shown("fp", "amount_due", "amount_paid", "payment_gap", "commission_earned")
FINAL["fct_member_churn"] = shown("fc", "lifetime_value", "monthly_premium", "annualized_revenue_lost")
FINAL["agent_commission_summary"] = shown("cs", *SUMMARY_MONEY)
FINAL["incr_payments"] = FINAL["fct_payments"]
FINAL["incr_member_churn"] = FINAL["fct_member_churn"]
FINAL["incr_dim_agents"] = FINAL["dim_agents"]
FINAL["incr_rejects"] = f"""
SELECT 'payment_id is missing' AS reason, CAST(NULL AS VARCHAR) AS payment_id, policy_id, due_date,
       CAST(amount_due AS DOUBLE) AS amount_due
FROM (SELECT DISTINCT * EXCLUDE (payment_id) FROM y0 WHERE strftime(due_date, '%Y-%m') = '1999-12')
UNION ALL
SELECT 'load time is missing', payment_id, policy_id, due_date, CAST(amount_due AS DOUBLE)
FROM y0 WHERE strftime(due_date, '%Y-%m') = '1999-11'"""
FINAL["incr_commission_summary"] = FINAL["agent_commission_summary"]
FINAL["agent_commission_summary_monthly"] = shown("cm", *SUMMARY_MONEY)
FINAL["incr_commission_summary_monthly"] = FINAL["agent_commission_summary_monthly"]

# analyst questions
FINAL["q1_monthly_revenue"] = revenue_by_month("fp")


def _mean_of_pct(column: str) -> str:
    return ratio(f"sum(CAST(round({column} * 100) AS HUGEINT))", f"count({column})", 1, 0) + " / 100"


FINAL["q2_top_agents"] = f"""
SELECT agent_id, agent_name, agency_name, agent_tier, CAST(sum(total_commission_earned) AS DOUBLE) AS ytd_commission,
       {big('sum(active_members_billed)', 'avg_active_members')},
       {_mean_of_pct('collection_rate_pct')} AS avg_collection_rate,
       {_mean_of_pct('failure_rate_pct')} AS avg_failure_rate, {big('sum(members_churned)', 'total_churns')}
FROM cs WHERE year = year({AS_OF}) GROUP BY 1, 2, 3, 4 ORDER BY sum(total_commission_earned) DESC, agent_id LIMIT 20"""
FINAL["q3_churn_by_reason"] = f"""
SELECT plan_type, cancellation_reason, churn_type, count(*) AS total_cancellations,
       {ratio('sum(months_active)', 'count(months_active)', 1, 1)} AS avg_months_active,
       CAST(sum(lifetime_value) AS DOUBLE) AS total_ltv_lost,
       CAST(sum(annualized_revenue_lost) AS DOUBLE) AS annualized_revenue_lost,
       count(*) FILTER (is_early_cancel) AS early_cancels,
       {pct('count(*) FILTER (is_early_cancel)', 'count(*)')} AS early_cancel_rate_pct
FROM fc GROUP BY 1, 2, 3"""
FINAL["q4_eligibility_gap"] = f"""
SELECT member_id, max(cancellation_date) AS last_cancel_date,
       string_agg(cancellation_reason, ', ' ORDER BY cancellation_date, cancellation_id) AS cancellation_reasons,
       CAST({AS_OF} - max(cancellation_date) AS BIGINT) AS days_since_cancel,
       'eligibility_gap' AS eligibility_status
FROM fc WHERE NOT EXISTS (SELECT 1 FROM fp WHERE fp.member_id = fc.member_id AND fp.payment_status <> 'failed'
                          AND fp.due_date >= {AS_OF} - 60)
GROUP BY member_id"""
FINAL["q5_churn_risk"] = f"""
SELECT member_id, agent_id, agent_name, plan_type, state, count(payment_id) AS payments_last_90d,
       count(*) FILTER (is_failed) AS failures_last_90d, count(*) FILTER (is_late) AS late_last_90d,
       max(due_date) AS most_recent_due_date,
       {pct('count(*) FILTER (is_failed)', 'count(payment_id)', 1)} AS failure_rate_pct,
       CASE WHEN count(*) FILTER (is_failed) > 1 THEN 'high_risk' ELSE 'medium_risk' END AS churn_risk_tier
FROM fp WHERE due_date >= {AS_OF} - 90 GROUP BY 1, 2, 3, 4, 5
HAVING count(*) FILTER (is_failed) > 0 OR count(*) FILTER (is_late) > 1"""
FINAL["q6_carrier_revenue"] = f"""
SELECT carrier, due_year, count(DISTINCT member_id) AS members, CAST(sum(amount_due) AS DOUBLE) AS total_billed,
       CAST(sum(amount_paid) AS DOUBLE) AS total_collected, CAST(sum(commission_earned) AS DOUBLE) AS total_commissions,
       {money_pct('sum(amount_paid)', 'sum(amount_due)')} AS collection_rate_pct
FROM fp GROUP BY 1, 2"""

# dashboard datasets
FINAL["d1_exec_kpis"] = f"""
SELECT (SELECT count(DISTINCT member_id) FROM sp WHERE policy_status = 'active') AS total_active_members,
       CAST(sum(amount_due) FILTER (due_period = strftime({AS_OF}, '%Y-%m')) AS DOUBLE) AS month_billed,
       CAST(sum(amount_paid) FILTER (due_period = strftime({AS_OF}, '%Y-%m')) AS DOUBLE) AS month_collected,
       {money_pct(f"sum(amount_paid) FILTER (due_period = strftime({AS_OF}, '%Y-%m'))",
                  f"sum(amount_due) FILTER (due_period = strftime({AS_OF}, '%Y-%m'))")} AS collection_rate_pct,
       CAST(sum(commission_earned) AS DOUBLE) AS ytd_commission
FROM fp WHERE due_year = year({AS_OF})"""
FINAL["d2_collection_trend"] = f"""
SELECT due_period, {money_pct('sum(amount_paid)', 'sum(amount_due)')} AS collection_rate_pct
FROM fp WHERE due_date >= {MONTH} - INTERVAL 23 MONTH AND due_date < {MONTH} + INTERVAL 1 MONTH GROUP BY 1"""
FINAL["d3_carrier_month"] = """
SELECT due_period, carrier, CAST(sum(amount_paid) AS DOUBLE) AS amount_collected FROM fp GROUP BY 1, 2"""
FINAL["d4_plan_mix"] = f"""
SELECT plan_type, CAST(sum(amount_paid) AS DOUBLE) AS amount_collected,
       {money_pct('sum(amount_paid)', '(SELECT sum(amount_paid) FROM fp)')} AS share_pct
FROM fp GROUP BY 1"""
FINAL["d5_tier_scatter"] = f"""
SELECT agent_tier, tier_rank, {_mean_of_pct('collection_rate_pct')} AS avg_collection_rate_pct,
       {big('sum(active_members_billed)', 'active_members_billed')}
FROM cs LEFT JOIN (SELECT agent_id, tier_rank FROM da) t USING (agent_id) GROUP BY 1, 2"""
FINAL["d6_agent_scorecard"] = """
SELECT * REPLACE (CAST(ytd_commission AS DOUBLE) AS ytd_commission),
       CASE WHEN failure_rate_pct > 5 THEN 'red' WHEN collection_rate_pct > 95 THEN 'green' END AS flag
FROM card"""
FINAL["d7_agent_kpis"] = f"""
SELECT count(*) FILTER (is_active) AS active_agents,
       {ratio(cents('sum(ytd_commission) FILTER (collection_rate_pct IS NOT NULL)'), 'count(collection_rate_pct)', 1, 0)}
         / 100 AS avg_commission_per_agent,
       {pct('count(*) FILTER (collection_rate_pct > 95)', 'count(collection_rate_pct)')} AS agents_above_95_pct
FROM card"""
FINAL["d8_churn_waterfall"] = """
SELECT CAST(list_position(['non_payment', 'member_request', 'employer_change', 'moved_out_of_area', 'plan_upgrade',
       'deceased'], cancellation_reason) AS BIGINT) AS reason_rank, cancellation_reason, churn_type,
       count(*) AS total_cancellations
FROM fc GROUP BY ALL"""
FINAL["d9_churn_rate_plan"] = f"""
SELECT plan_type, coalesce(c, 0) AS churned, coalesce(p, 0) AS total_policies, {pct('coalesce(c, 0)', 'p')} AS churn_rate_pct
FROM (SELECT plan_type, count(*) AS p FROM sp GROUP BY 1) FULL JOIN
     (SELECT plan_type, count(*) AS c FROM fc GROUP BY 1) USING (plan_type)"""
FINAL["d10_churn_monthly"] = f"""
SELECT cancel_period, churn_type, count(*) AS total_cancellations, count(*) FILTER (is_early_cancel) AS early_cancels,
       {pct('count(*) FILTER (is_early_cancel)', 'count(*)')} AS early_cancel_pct
FROM fc GROUP BY 1, 2"""
FINAL["d11_churn_state"] = f"""
SELECT state, coalesce(c, 0) AS churned, coalesce(m, 0) AS total_members, {pct('coalesce(c, 0)', 'm')} AS churn_rate_pct
FROM (SELECT state, count(*) AS m FROM sm GROUP BY 1) FULL JOIN
     (SELECT state, count(*) AS c FROM fc GROUP BY 1) USING (state)"""
FINAL["d11_churn_risk_state"] = f"""
SELECT state, churn_risk_tier, count(DISTINCT member_id) AS members_at_risk
FROM ({FINAL['q5_churn_risk']}) GROUP BY 1, 2"""
FINAL["d12_early_cancel"] = """
SELECT cancellation_id, member_name, plan_type, agent_name, months_active, cancellation_reason AS reason,
       CAST(lifetime_value AS DOUBLE) AS ltv_lost
FROM fc WHERE is_early_cancel"""
FINAL["d13_freshness"] = f"""
SELECT {AS_OF} AS as_of, max(due_date) AS latest, CAST(24 * ({AS_OF} - max(due_date)) AS BIGINT) AS age_hours,
       24 * ({AS_OF} - max(due_date)) > 24 AS is_stale
FROM sy WHERE due_date <= {AS_OF}"""
LOADED = f"""
SELECT carrier, CAST(TIMESTAMP '2001-09-30 12:00:00' - to_minutes(CASE carrier WHEN 'MetLife' THEN 1439 WHEN 'VSP' THEN 1441
         ELSE 690 END) - to_hours(month(due_date) - 1) AS TIMESTAMP) AS loaded
FROM sy WHERE month(due_date) < 12"""
FINAL["d13_load_freshness"] = f"""
SELECT carrier, strftime(max(loaded), '%Y-%m-%d %H:%M:%S') AS latest,
       CAST(floor(epoch(TIMESTAMP '2001-09-30 12:00:00' - max(loaded)) / 3600) AS BIGINT) AS age_hours,
       max(loaded) < TIMESTAMP '2001-09-30 12:00:00' - INTERVAL 1 DAY AS is_stale
FROM ({LOADED}) GROUP BY 1"""
_CUT = (
    "carrier <> 'MetLife' AND plan_type IN ('Dental Basic', 'Dental Premium', 'Dental+Vision Bundle') "
    "AND agent_tier IN ('silver', 'gold')"
)
_SPAN = "BETWEEN DATE '1996-03-01' AND DATE '1998-08-31'"
PARTS["fps"] = f"SELECT * FROM fp WHERE {_CUT} AND due_date {_SPAN}"
PARTS["fcs"] = f"SELECT * FROM fc WHERE {_CUT} AND cancellation_date {_SPAN}"
FINAL["sliced_churn"] = FINAL["q3_churn_by_reason"].replace("FROM fc", "FROM fcs")
FINAL["sliced_scorecard"] = f"""
SELECT *, CASE WHEN failure_rate_pct > 5 THEN 'red' WHEN collection_rate_pct > 95 THEN 'green' END AS flag
FROM (
  SELECT da.agent_id, da.agent_name, da.agency_name, da.tier, da.is_active,
         (SELECT count(DISTINCT member_id) FROM sp WHERE sp.agent_id = da.agent_id AND policy_status = 'active')
           AS active_members,
         CAST(coalesce(v, 0) AS DOUBLE) AS ytd_commission, {money_pct('got', 'due')} AS collection_rate_pct,
         {pct('bad', 'np')} AS failure_rate_pct,
         (SELECT count(*) FROM fcs WHERE fcs.agent_id = da.agent_id) AS total_churns,
         coalesce(cancellation_rate_pct >
                  (SELECT {pct("count(*) FILTER (policy_status = 'cancelled')", 'count(*)')} FROM sp), FALSE) AS is_high_churn
  FROM da LEFT JOIN (
    SELECT agent_id, sum(commission_earned) FILTER (due_year = 1998) AS v, sum(amount_due) AS due, sum(amount_paid) AS got,
           count(*) AS np, count(*) FILTER (is_failed) AS bad
    FROM fps GROUP BY ALL) t ON t.agent_id = da.agent_id
  WHERE da.tier IN ('silver', 'gold'))"""
FINAL["sliced_tier_scatter"] = f"""
SELECT agent_tier, tier_rank, {_mean_of_pct('rate')} AS avg_collection_rate_pct, {big('sum(nm)', 'active_members_billed')}
FROM (SELECT agent_id, agent_tier, due_period, carrier, count(DISTINCT member_id) AS nm,
             {money_pct('sum(amount_paid)', 'sum(amount_due)')} AS rate
      FROM fps GROUP BY 1, 2, 3, 4) LEFT JOIN (SELECT agent_id, tier_rank FROM da) t USING (agent_id)
GROUP BY 1, 2"""
FINAL["sliced_revenue"] = revenue_by_month(
    "fp",
    "due_date BETWEEN DATE '1997-01-01' AND DATE '2000-12-31' AND carrier <> 'Zurich' "
    "AND plan_type IN ('Dental Basic', 'Vision Premium', 'Dental+Vision Bundle') AND agent_tier <> 'bronze' "
    "AND state IN ('IN', 'OH', 'TX', 'CA', 'FL')",
)
FINAL["agent_book"] = shown("fp", "amount_due", "amount_paid", "payment_gap", "commission_earned") + (
    " WHERE agent_id = (SELECT agent_id FROM sa WHERE email = 'agent7@example.com')"
)

# ---- data checks ---------------------------------------------------------------------

TABLES = {
    "agents": "a0", "members": "m0", "policies": "p0", "payments": "y0", "cancellations": "c0", "dim_agents": "da",
    "fct_payments": "fp", "fct_member_churn": "fc", "agent_commission_summary": "cs",
}
_STATUS = ("paid", "paid_late", "failed")
_TIER = ("bronze", "silver", "gold", "platinum")
UNIQUE = [
    ("agents", "agent_id"), ("members", "member_id"), ("policies", "policy_id"), ("payments", "payment_id"),
    ("cancellations", "cancellation_id"), ("dim_agents", "agent_id"), ("fct_payments", "payment_id"),
    ("fct_member_churn", "cancellation_id"),
]
NOT_NULL = UNIQUE + [
    ("agents", "agent_name"), ("members", "agent_id"), ("policies", "member_id"), ("policies", "monthly_premium"),
    ("payments", "policy_id"), ("cancellations", "policy_id"),
]
ACCEPTED = [
    ("agents", "tier", _TIER), ("dim_agents", "tier", _TIER),
    ("members", "plan_type", ("Dental Basic", "Dental Premium", "Vision Basic", "Vision Premium", "Dental+Vision Bundle")),
    ("policies", "status", ("active", "cancelled", "expired", "pending")),
    ("payments", "payment_status", _STATUS), ("fct_payments", "payment_status", _STATUS),
    ("fct_payments", "collection_status", ("collected_on_time", "collected_late", "uncollected")),
    ("cancellations", "cancellation_reason",
     ("non_payment", "member_request", "employer_change", "moved_out_of_area", "plan_upgrade", "deceased")),
    ("fct_member_churn", "churn_type", ("voluntary", "involuntary")),
]
RELATED = [
    ("members", "agent_id", "agents"), ("policies", "member_id", "members"), ("payments", "policy_id", "policies"),
    ("cancellations", "policy_id", "policies"),
]
RANGE = [
    ("dim_agents", "cancellation_rate_pct", "< 0", "> 100"), ("fct_payments", "commission_earned", "< 0", "< 0"),
    ("fct_member_churn", "months_active", "< 0", "< 0"),
    ("agent_commission_summary", "collection_rate_pct", "< 0", "> 100"),
    ("agent_commission_summary", "failure_rate_pct", "< 0", "> 100"),
]


def _quoted(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _bad_rows(kind: str, spec: tuple) -> str:
    """SELECT of the failing values, one row per failing record (per repeated value for unique)."""
    table, column = TABLES[spec[0]], spec[1]
    if kind == "unique":
        return f"SELECT {column} AS v FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    where = {
        "not_null": lambda: f"{column} IS NULL",
        "accepted_values": lambda: f"{column} NOT IN ({_quoted(spec[2])})",
        "relationships": lambda: f"{column} NOT IN (SELECT {column} FROM {TABLES[spec[2]]})",
        "accepted_range": lambda: f"{column} {spec[2]} OR {column} {spec[3]}",
        "no_negative_commission": lambda: f"{column} < 0",
    }[kind]()
    return f"SELECT {column} AS v FROM {table} WHERE {where}"


KINDS = {
    "unique": UNIQUE, "not_null": NOT_NULL, "accepted_values": ACCEPTED, "relationships": RELATED,
    "accepted_range": RANGE, "no_negative_commission": [("fct_payments", "commission_earned")],
}


def _counted(kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS test, '{s[0]}' AS table_name, '{s[1]}' AS column_name, "
        f"(SELECT count(*) FROM {TABLES[s[0]]}) AS rows_checked, (SELECT count(*) FROM ({_bad_rows(kind, s)})) AS failures"
        for s in KINDS[kind]
    )


def _passed(body: str) -> str:
    return f"SELECT *, failures = 0 AS passed FROM ({body})"


for _kind in ("unique", "not_null", "accepted_values", "relationships", "accepted_range"):
    FINAL[f"dq_{_kind}"] = _passed(_counted(_kind))
FINAL["dq_report"] = _passed(" UNION ALL ".join(_counted(kind) for kind in KINDS))
FINAL["dq_composite_unique"] = _passed(" UNION ALL ".join(
    f"SELECT 'unique' AS test, '{name}' AS table_name, '{keys}' AS column_name, (SELECT count(*) FROM {part}) AS rows_checked, "
    f"(SELECT count(*) FROM (SELECT {keys} FROM {part} GROUP BY ALL HAVING count(*) > 1)) AS failures"
    for name, part, keys in (
        ("agent_commission_summary", "cs", "agent_id, period, carrier"), ("agent_commission_summary_monthly", "cm", "agent_id, period"),
        ("stg_policies", "sp", "member_id, effective_date"),
    )
))
FINAL["dq_no_negative_commission"] = f"""
SELECT payment_id, {dbl('amount_paid', 'commission_earned')} FROM fp WHERE commission_earned < 0"""
FINAL["dq_failing_values"] = (
    "SELECT test, table_name, column_name, value, count(*) AS n_records FROM ("
    + " UNION ALL ".join(
        f"SELECT '{kind}' AS test, '{s[0]}' AS table_name, '{s[1]}' AS column_name, CAST(v AS VARCHAR) AS value "
        f"FROM ({_bad_rows(kind, s)})"
        for kind in KINDS
        for s in KINDS[kind]
    )
    + ") GROUP BY ALL"
)


# ---- history, stored summaries, layouts ------------------------------------------------

FINAL["stream_payments"] = FINAL["fct_payments"]
FINAL["catalog_fct_payments"] = FINAL["fct_payments"]
FINAL["d13_stale_spans"] = """
SELECT carrier, strftime(stale_from, '%Y-%m-%d %H:%M:%S') AS stale_from, strftime(stale_until, '%Y-%m-%d %H:%M:%S') AS stale_until,
       date_diff('second', stale_from, stale_until) AS stale_seconds
FROM (SELECT carrier, seen + INTERVAL 24 HOUR AS stale_from,
             coalesce(lead(seen) OVER (PARTITION BY carrier ORDER BY seen), TIMESTAMP '2001-09-30 12:00:00') AS stale_until
      FROM (SELECT carrier, CAST(paid_date AS TIMESTAMP) + to_minutes((days_to_pay * 97 + length(policy_id)) % 1440) AS seen
            FROM sy WHERE paid_date IS NOT NULL) WHERE seen <= TIMESTAMP '2001-09-30 12:00:00')
WHERE stale_until > stale_from"""
FINAL["raw_rejects"] = """
SELECT policy_id, CASE right(policy_id, 2) WHEN '21' THEN 'yesterday' ELSE CAST(effective_date AS VARCHAR) END AS effective_date,
       CASE right(policy_id, 2) WHEN '42' THEN 'n/a' ELSE CAST(monthly_premium AS VARCHAR) END AS monthly_premium, status
FROM p0 WHERE right(policy_id, 2) IN ('21', '42')"""
FINAL["risk_history"] = f"""
SELECT e AS month_end, count(*) AS members_billed, count(*) FILTER (bad > 1) AS high_risk,
       count(*) FILTER (bad = 1 OR (bad = 0 AND slow > 1)) AS medium_risk, count(*) FILTER (good > 0) AS members_paying,
       {pct('sum(bad)', 'sum(n)', 1)} AS failure_rate_pct
FROM (SELECT e, member_id, plan_type, count(payment_id) AS n, count(*) FILTER (is_failed) AS bad, count(*) FILTER (is_late) AS slow,
             count(*) FILTER (payment_status <> 'failed' AND due_date >= e - 60) AS good
      FROM (SELECT last_day(m) AS e FROM (SELECT unnest(generate_series(date_trunc('month', min(due_date)), {AS_OF}, INTERVAL 1 MONTH)) AS m FROM sy))
      JOIN sy ON due_date BETWEEN e - 90 AND e
      WHERE e <= {AS_OF} GROUP BY 1, 2, 3)
GROUP BY 1"""
FINAL["active_members_rollup"] = """
SELECT 'quarter_tier' AS scope, due_year || '-Q' || ((due_month + 2) // 3) AS period, agent_tier AS name, count(DISTINCT member_id) AS active_members
FROM fp GROUP BY 2, 3
UNION ALL SELECT 'year_carrier', CAST(due_year AS VARCHAR), carrier, count(DISTINCT member_id) FROM fp GROUP BY 2, 3
UNION ALL SELECT 'book', 'all', agent_id, count(DISTINCT member_id) FROM fp GROUP BY 3"""
_CUBE = {
    "all": "TRUE",
    "carrier": "carrier = 'VSP'",
    "plan_span": "plan_type IN ('Dental Basic', 'Vision Basic') AND due_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'",
    "tier_state": "agent_tier IN ('gold', 'platinum') AND state IN ('OH', 'TX', 'CA')",
    "carrier_plan": "carrier <> 'VSP' AND plan_type = 'Dental+Vision Bundle'",
    "everything": "due_year IN (1997, 1998) AND carrier <> 'Zurich' AND plan_type IN ('Dental Basic', 'Vision Premium') "
    "AND agent_tier <> 'platinum' AND state IN ('IN', 'OH', 'TX', 'WA', 'NY')",
}
FINAL["cube_sliced_revenue"] = " UNION ALL ".join(f"SELECT *, '{name}' AS slicer FROM ({revenue_by_month('fp', where)})" for name, where in _CUBE.items())
PARTS["mv"] = """
SELECT member_id, DATE '1900-01-01' AS since, CASE WHEN right(member_id, 1) = '7' THEN 'AGT000001' ELSE agent_id END AS agent_id FROM sm
UNION ALL SELECT member_id, DATE '1997-07-01', agent_id FROM sm WHERE right(member_id, 1) = '7'"""
PARTS["av"] = """
SELECT agent_id, DATE '1900-01-01' AS since, agent_name, agency_name, CASE WHEN right(agent_id, 1) = '3' THEN 'bronze' ELSE tier END AS tier FROM sa
UNION ALL SELECT agent_id, DATE '1998-01-15', agent_name, agency_name, tier FROM sa WHERE right(agent_id, 1) = '3'"""
FINAL["asof_fct_payments"] = f"""
SELECT p.* EXCLUDE (agent_id, agent_name, agency_name, agent_tier) REPLACE ({dbl('p.amount_due', 'p.amount_paid', 'p.payment_gap', 'p.commission_earned')}),
       p.owner AS agent_id, av.agent_name, av.agency_name, av.tier AS agent_tier
FROM (SELECT fp.*, mv.agent_id AS owner FROM fp ASOF LEFT JOIN mv ON mv.member_id = fp.member_id AND fp.due_date >= mv.since) p
     ASOF LEFT JOIN av ON av.agent_id = p.owner AND p.due_date >= av.since"""
FINAL["asof_fct_payments"] = f"SELECT * EXCLUDE (owner) FROM ({FINAL['asof_fct_payments']})"
_BY_ROW = ("not_null", "accepted_values", "accepted_range", "no_negative_commission")
FINAL["dq_observed"] = _passed(" UNION ALL ".join(_counted(kind) for kind in _BY_ROW))

# ---- the same with planted defects -----------------------------------------------------

DIRTY = {
    "a0": "SELECT * REPLACE (CASE right(agent_id, 1) WHEN '4' THEN 'Diamond' WHEN '8' THEN NULL ELSE tier END AS tier) FROM ({})",
    "m0": "SELECT * REPLACE (CASE right(member_id, 1) WHEN '5' THEN 'AGT999999' WHEN '6' THEN NULL ELSE agent_id END AS agent_id) FROM ({})",
    "p0": "SELECT * REPLACE (CASE right(policy_id, 2) WHEN '12' THEN 'Lapsed' ELSE status END AS status) FROM ({})",
    "y0": """
SELECT * EXCLUDE (q) REPLACE (
         CASE q WHEN '11' THEN 'Refunded' WHEN '22' THEN NULL ELSE payment_status END AS payment_status,
         CASE q WHEN '33' THEN 'POLX' || policy_id WHEN '44' THEN NULL ELSE policy_id END AS policy_id,
         CAST(CASE q WHEN '55' THEN -5 WHEN '66' THEN 2 * amount_due ELSE amount_paid END AS DECIMAL(12, 2)) AS amount_paid,
         CASE q WHEN '77' THEN NULL ELSE payment_id END AS payment_id, CASE q WHEN '99' THEN 'MEMX' ELSE member_id END AS member_id)
FROM (SELECT y.*, right(policy_id, 2) AS q, unnest(range(CASE right(policy_id, 2) WHEN '88' THEN 2 ELSE 1 END)) AS again FROM ({}) y)""",
    "c0": """
SELECT * REPLACE (
         CASE right(policy_id, 1) WHEN '3' THEN 'AGT000002' ELSE agent_id END AS agent_id,
         CASE right(policy_id, 1) WHEN '7' THEN -months_active ELSE months_active END AS months_active,
         CASE right(policy_id, 1) WHEN '9' THEN NULL ELSE cancellation_reason END AS cancellation_reason)
FROM ({})""",
}
DIRTY["y0"] = DIRTY["y0"].replace("EXCLUDE (q)", "EXCLUDE (q, again)")
DIRTY_KEYS = {
    "dirty_fct_payments": "fct_payments", "dirty_member_churn": "fct_member_churn", "dirty_commission_summary": "agent_commission_summary",
    "dirty_dq_report": "dq_report",
}


# ---- assembly ------------------------------------------------------------------------


def _needed(body: str) -> set[str]:
    found = {part for part in PARTS if re.search(rf"\b{part}\b", body)}
    for part in list(found):
        found |= _needed(PARTS[part])
    return found


def statement(key: str) -> str:
    dirty = key in DIRTY_KEYS
    body = FINAL[DIRTY_KEYS[key] if dirty else key].strip()
    needed = _needed(body)
    parts = []
    for name, text in PARTS.items():
        if name not in needed:
            continue
        if dirty and name in DIRTY:
            # What is derived from a raw table is derived from the clean one; the defects come after.
            parts.append(f"clean_{name} AS MATERIALIZED ({_from_clean(text)})")
            text = DIRTY[name].replace("({})", f"clean_{name}")
        parts.append(f"{name} AS MATERIALIZED ({(_from_clean(text) if dirty and name in _RAW else text).strip()})")
    return f"WITH {', '.join(parts)} {body}"


_RAW = ("price", "p1", "y1", "c1")


def _from_clean(text: str) -> str:
    return re.sub(rf"\b(?<!clean_)({'|'.join(DIRTY)})\b", r"clean_\1", text).strip()


def statements() -> dict[str, str]:
    return {key: statement(key) for key in [*FINAL, *DIRTY_KEYS]}
