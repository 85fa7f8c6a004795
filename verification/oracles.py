"""The same queries as independent SQL over the same tables.

Shared sub-queries are kept by name; each oracle carries the ones it refers to.
"""

from __future__ import annotations

import re

from lapsewise.fixed_values import ACTIONS, DEFAULT_ACTION, DESCRIPTIONS
from lapsewise.schemas import BEHAVIOUR_FEATURES
from verification.stand_ins import BATCHES, BETAS, INTERCEPT


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def r6(expression: str) -> str:
    return f"(round(CAST({expression} AS DOUBLE), 6) + CAST(0 AS DOUBLE))"


def r6_columns(names: list[str]) -> str:
    return ", ".join(f"{r6(n)} AS {n}" for n in names)


RATIOS = [
    "missed_invoice_ratio",
    "failed_invoice_ratio",
    "late_invoice_ratio",
    "avg_days_late",
    "max_days_late",
    "trend_failed_rate_delta",
    "trend_late_rate_delta",
]
COUNTS = ["total_invoices", "missed_invoice_count", "failed_invoice_count", "late_invoice_count"]
STATIC = "policy_num, customer_id, insurance_product, payment_frequency, policy_status, tenure_days, is_churned"


def _score(shift: float) -> str:
    linear = " + ".join([f"CAST({INTERCEPT + shift} AS DOUBLE)"] + [
        f"CAST({b} AS DOUBLE) * {c}" for c, b in BETAS.items()
    ])
    return f"round(1 / (1 + exp(-round({linear}, 9))), 6)"


def _factors(source: str) -> str:
    """Long form of the linear contributions, ranked per policy."""
    means = ", ".join(f"avg({c}) AS m_{c}" for c in BEHAVIOUR_FEATURES)
    parts = " UNION ALL ".join(
        f"SELECT policy_num, {i} AS i, '{c}' AS feature, CAST({BETAS[c]} AS DOUBLE) * ({c} - m_{c}) AS v, CAST({c} AS DOUBLE) AS x"
        f" FROM {source}, (SELECT {means} FROM {source})"
        for i, c in enumerate(BEHAVIOUR_FEATURES)
    )
    return f"SELECT *, row_number() OVER (PARTITION BY policy_num ORDER BY abs(v) DESC, i) AS rank FROM ({parts})"


def _labels(source: str) -> str:
    return f"""
      SELECT c.policy_num, CASE k.place WHEN 1 THEN 'Low risk' WHEN 2 THEN 'Medium risk' ELSE 'High risk' END AS segment_label
      FROM {source} c JOIN (
        SELECT cluster, row_number() OVER (ORDER BY avg(failed_invoice_ratio), cluster) AS place
        FROM {source} GROUP BY cluster) k USING (cluster)"""


def _history() -> str:
    batches = " UNION ALL ".join(
        f"SELECT *, TIMESTAMP '{at}' AS scored_at, {_score(shift)} AS p FROM active_features"
        for at, shift in BATCHES
    )
    return f"""
      SELECT b.policy_num, b.scored_at, round_even(b.p, 4) AS churn_probability, l.segment_label,
             f.n_factors, f.lead_feature, f.lead_value,
             coalesce(a.action, {_text(DEFAULT_ACTION)}) AS recommended_action, w.why
      FROM ({batches}) b
      JOIN active_labels l USING (policy_num)
      JOIN (SELECT policy_num, count(*) AS n_factors, arg_min(feature, rank) AS lead_feature,
                   arg_min(round_even(v, 4), rank) AS lead_value
            FROM active_factors WHERE rank <= 3 GROUP BY policy_num) f USING (policy_num)
      LEFT JOIN (SELECT policy_num, arg_min(action, rank) AS action
                 FROM active_factors JOIN actions USING (feature)
                 WHERE rank <= 3 AND round_even(v, 4) > 0 GROUP BY policy_num) a USING (policy_num)
      LEFT JOIN (SELECT policy_num, string_agg(description, '; ' ORDER BY rank) AS why
                 FROM active_factors JOIN descriptions USING (feature)
                 WHERE rank <= 3 AND round_even(v, 4) > 0 GROUP BY policy_num) w USING (policy_num)"""


def _values(entries: dict[str, str], name: str) -> str:
    rows = ", ".join(f"({_text(k)}, {_text(v)})" for k, v in entries.items())
    return f"SELECT * FROM (VALUES {rows}) AS t(feature, {name})"


POLICY = "(o_custkey * 2 + o_orderkey % 2)"
ARREARS = "(30 * (1 + o_orderkey % 3))"
LAG = "(((date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 75) + 75) % 75)"

FRAGMENTS: dict[str, str] = {
    "policies": """
      SELECT c_mktsegment AS insurance_product, CAST(c_custkey AS VARCHAR) AS customer_id,
             CAST(n AS VARCHAR) AS policy_num, d AS effective_start_date, d + 365 AS effective_end_date,
             CASE n % 3 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'Quarterly' ELSE 'Semi-Annual' END AS payment_frequency,
             CASE WHEN (n * 7919) % 100 < 24 THEN 'Cancelled' WHEN (n * 7919) % 100 < 50 THEN 'Active' ELSE 'Expired' END AS policy_status,
             CASE WHEN (n * 7919) % 100 < 24 THEN d + CAST(30 + (n * 31) % 300 AS INTEGER) END AS cancel_date,
             n
      FROM (SELECT *, DATE '1995-01-01' + CAST((n * 37) % 2000 AS INTEGER) AS d
            FROM (SELECT *, c_custkey * 2 + h AS n FROM customer, (VALUES (0), (1)) AS half(h)))""",
    "invoices": f"""
      SELECT CAST({POLICY} AS VARCHAR) AS policy_num, CAST(o_orderkey AS VARCHAR) AS invoice_num,
             CAST(o_orderdate AS DATE) AS invoice_start_date, {ARREARS} AS days_arrears_allowed,
             date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS installment_num,
             CAST(o_totalprice AS DECIMAL(12,2)) AS premium, o_orderstatus
      FROM orders""",
    "payments": f"""
      SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS transaction_id,
             CAST(l_orderkey AS VARCHAR) AS invoice_num, CAST(l_extendedprice AS DECIMAL(12,2)) AS premium, CAST(o_orderdate AS DATE) + CAST({LAG} AS INTEGER) AS pay_transaction_date,
             CASE WHEN l_returnflag = 'R' AND (l_linestatus = 'O' OR ({POLICY} * 7919) % 100 < 24) THEN 'Failed'
                  WHEN {LAG} > {ARREARS} THEN 'Paid Late' ELSE 'Paid' END AS pay_transaction_status,
             o_orderstatus
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "lateness": """
      SELECT p.transaction_id, p.invoice_num, p.pay_transaction_date, p.pay_transaction_status,
             CASE WHEN p.pay_transaction_status <> 'Failed'
                  THEN greatest(date_diff('day', i.invoice_start_date, p.pay_transaction_date) - i.days_arrears_allowed, 0) END AS days_late
      FROM payments p JOIN invoices i USING (invoice_num)""",
    "summary": """
      SELECT i.invoice_num, i.policy_num, i.installment_num,
             coalesce(a.failed_attempts, 0) AS failed_attempts, coalesce(a.was_paid_late, false) AS was_paid_late,
             a.max_days_late, a.invoice_num IS NULL AS was_missed, coalesce(a.failed_attempts, 0) > 0 AS had_failed_attempt
      FROM invoices i LEFT JOIN (
        SELECT invoice_num, count(*) FILTER (pay_transaction_status = 'Failed') AS failed_attempts,
               bool_or(pay_transaction_status = 'Paid Late') AS was_paid_late, max(days_late) AS max_days_late
        FROM lateness GROUP BY invoice_num) a USING (invoice_num)""",
    "behaviour": """
      SELECT policy_num, count(*) AS total_invoices,
             count(*) FILTER (was_missed) AS missed_invoice_count, avg(CAST(was_missed AS INTEGER)) AS missed_invoice_ratio,
             count(*) FILTER (had_failed_attempt) AS failed_invoice_count, avg(CAST(had_failed_attempt AS INTEGER)) AS failed_invoice_ratio,
             count(*) FILTER (was_paid_late) AS late_invoice_count, avg(CAST(was_paid_late AS INTEGER)) AS late_invoice_ratio,
             coalesce(avg(max_days_late), 0) AS avg_days_late, CAST(coalesce(max(max_days_late), 0) AS DOUBLE) AS max_days_late,
             coalesce(avg(CAST(had_failed_attempt AS INTEGER)) FILTER (place > half)
                    - avg(CAST(had_failed_attempt AS INTEGER)) FILTER (place <= half), 0) AS trend_failed_rate_delta,
             coalesce(avg(CAST(was_paid_late AS INTEGER)) FILTER (place > half)
                    - avg(CAST(was_paid_late AS INTEGER)) FILTER (place <= half), 0) AS trend_late_rate_delta
      FROM (SELECT *, row_number() OVER (PARTITION BY policy_num ORDER BY installment_num, invoice_num) AS place,
                   (count(*) OVER (PARTITION BY policy_num) + 1) // 2 AS half FROM summary)
      GROUP BY policy_num""",
    "static": """
      SELECT policy_num, customer_id, insurance_product, payment_frequency, policy_status,
             CAST(date_diff('day', effective_start_date,
                  CASE WHEN policy_status = 'Cancelled' THEN cancel_date ELSE effective_end_date END) AS INTEGER) AS tenure_days,
             CASE WHEN policy_status = 'Cancelled' THEN 1 ELSE 0 END AS is_churned
      FROM policies""",
    "features": f"""
      SELECT {STATIC}, {", ".join(f"coalesce({c}, 0) AS {c}" for c in [*COUNTS, *RATIOS])}
      FROM static LEFT JOIN behaviour USING (policy_num)""",
    "active_features": "SELECT * FROM features WHERE policy_status = 'Active'",
    "profile": """
      SELECT policy_num, policy_status, CASE WHEN policy_status = 'Cancelled' THEN 'churned'
             WHEN n % 2 = 0 THEN 'at_risk' ELSE 'good' END AS hidden_profile FROM policies""",
    "scored": f"SELECT policy_num, is_churned AS y, {_score(0.0)} AS p FROM features",
    "by_score": "SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p",
    "quality": """
      SELECT sum(pos * (neg_below + neg / 2.0)) / (max(all_pos) * max(all_neg)) AS roc_auc,
             sum(pos * tp / (tp + fp)) / max(all_pos) AS pr_auc
      FROM (SELECT p, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
                   CAST(coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS neg_below,
                   CAST(sum(pos) OVER (ORDER BY p DESC) AS DOUBLE) AS tp, CAST(sum(neg) OVER (ORDER BY p DESC) AS DOUBLE) AS fp,
                   CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg
            FROM by_score)""",
    "cells": """
      SELECT k - 1 AS position, k / CAST(20 AS DOUBLE) AS threshold,
             count(*) FILTER (p < k / CAST(20 AS DOUBLE) AND y = 0) AS true_negative,
             count(*) FILTER (p >= k / CAST(20 AS DOUBLE) AND y = 0) AS false_positive,
             count(*) FILTER (p < k / CAST(20 AS DOUBLE) AND y = 1) AS false_negative,
             count(*) FILTER (p >= k / CAST(20 AS DOUBLE) AND y = 1) AS true_positive
      FROM scored, range(1, 20) AS t(k) GROUP BY k""",
    "swept": """
      SELECT CAST(position AS INTEGER) AS position, threshold,
             coalesce(true_positive / nullif(true_positive + false_positive, 0), 0) AS precision,
             coalesce(true_positive / nullif(true_positive + false_negative, 0), 0) AS recall,
             coalesce(2 * true_positive / nullif(2 * true_positive + false_positive + false_negative, 0), 0) AS f1,
             roc_auc, pr_auc, true_negative, false_positive, false_negative, true_positive,
             false_positive * CAST(1 AS DOUBLE) + false_negative * CAST(5 AS DOUBLE) AS expected_cost
      FROM cells, quality""",
    "ranked_scores": "SELECT p, y, row_number() OVER (ORDER BY p) - 1 AS rn, count(*) OVER () AS n FROM scored",
    "edges": """
      SELECT i, CASE WHEN part < 0.5 THEN a.p + (b.p - a.p) * part ELSE b.p - (b.p - a.p) * (1 - part) END AS edge
      FROM (SELECT i, floor(place) AS low, place - floor(place) AS part
            FROM (SELECT i, i * (CAST(1 AS DOUBLE) / 10) * (n - 1) AS place
                  FROM range(1, 10) AS t(i), (SELECT count(*) AS n FROM scored)))
      JOIN ranked_scores a ON a.rn = low JOIN ranked_scores b ON b.rn = low + 1""",
    "clustered": "SELECT *, CASE WHEN failed_invoice_ratio = 0 THEN 2 WHEN failed_invoice_ratio <= 0.5 THEN 0 ELSE 1 END AS cluster FROM features",
    "active_clustered": "SELECT * FROM clustered WHERE policy_status = 'Active'",
    "labels_of_policies": _labels("clustered"),
    "active_labels": _labels("active_clustered"),
    "factors": _factors("features"),
    "active_factors": _factors("active_features"),
    "actions": _values(ACTIONS, "action"),
    "descriptions": _values(DESCRIPTIONS, "description"),
    "history": _history(),
    "latest": """
      SELECT h.*, p.insurance_product, p.payment_frequency, p.policy_status
      FROM history h JOIN policies p USING (policy_num)
      WHERE h.scored_at = (SELECT max(scored_at) FROM history)""",
    "quotas": """
      SELECT is_churned, n, n - least(n, floor(exact) + CASE WHEN place <= spare THEN 1 ELSE 0 END) AS n_test
      FROM (SELECT *, row_number() OVER (ORDER BY floor(exact) - exact, is_churned) AS place,
                   n_train - sum(floor(exact)) OVER () AS spare
            FROM (SELECT is_churned, n, total - ceil(total * CAST(0.2 AS DOUBLE)) AS n_train,
                         n * (total - ceil(total * CAST(0.2 AS DOUBLE))) / total AS exact
                  FROM (SELECT is_churned, count(*) AS n, sum(count(*)) OVER () AS total FROM features GROUP BY is_churned)))""",
    "split": """
      SELECT policy_num, is_churned, place <= n_test AS is_test
      FROM (SELECT policy_num, is_churned, row_number() OVER (PARTITION BY is_churned ORDER BY md5('42|' || policy_num)) AS place FROM features)
      JOIN quotas USING (is_churned)""",
    "model_inputs": " UNION ALL ".join(
        [f"SELECT '{c}' AS feature" for c in BEHAVIOUR_FEATURES]
        + [f"SELECT DISTINCT '{c}_' || {c} FROM policies" for c in ("insurance_product", "payment_frequency")]
    ),
    "held_out": "SELECT policy_num, is_churned AS y FROM split WHERE is_test",
}


def _needed(sql: str) -> list[str]:
    """Names of the fragments ``sql`` refers to, directly or through others, in order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", pending.pop()))
        for name in words & FRAGMENTS.keys() - found:
            found.add(name)
            pending.append(FRAGMENTS[name])
    return [n for n in FRAGMENTS if n in found]


def _whole(sql: str) -> str:
    parts = ", ".join(f"{n} AS ({FRAGMENTS[n]})" for n in _needed(sql))
    return f"WITH {parts} {sql}" if parts else sql


_FEATURES = f"{STATIC}, {', '.join(COUNTS)}, {r6_columns(RATIOS)}"
_TRENDS = f"SELECT policy_num, {r6_columns(['trend_failed_rate_delta', 'trend_late_rate_delta'])} FROM behaviour"

_STATEMENTS: dict[str, str] = {
    "normalize_dates": f"""
      SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS ts, nullif(event_type, '') AS event_type, {r6('value')} AS value FROM events""",
    "upsert_new_keys": """
      SELECT policy_num, invoice_num, 'Premium' AS invoice_type, CAST(invoice_start_date AS VARCHAR) AS invoice_start_date,
             CAST(invoice_start_date + 30 AS VARCHAR) AS invoice_end_date, CAST(days_arrears_allowed AS INTEGER) AS days_arrears_allowed,
             CAST(installment_num AS INTEGER) AS installment_num, CAST(premium AS DOUBLE) AS premium
      FROM invoices WHERE o_orderstatus <> 'F'""",
    "fk_orphans": """
      SELECT 'payhistory' AS child_table, 'invoice_num' AS foreign_key, invoice_num AS orphan_key, count(*) AS child_rows
      FROM payments WHERE o_orderstatus <> 'F' GROUP BY invoice_num""",
    "seed_counts": """
      SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS file_rows,
             (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) AS new_rows
      UNION ALL SELECT 'policies', (SELECT count(*) FROM policies), (SELECT count(*) FROM policies WHERE policy_status <> 'Expired')
      UNION ALL SELECT 'invoice', (SELECT count(*) FROM invoices), (SELECT count(*) FROM invoices WHERE o_orderstatus <> 'F')
      UNION ALL SELECT 'payhistory', (SELECT count(*) FROM payments), (SELECT count(*) FROM payments WHERE pay_transaction_status <> 'Paid')""",
    "payment_days_late": "SELECT transaction_id, invoice_num, CAST(pay_transaction_date AS VARCHAR) AS pay_transaction_date, pay_transaction_status, CAST(days_late AS INTEGER) AS days_late FROM lateness",
    "invoice_summary": """
      SELECT invoice_num, policy_num, CAST(installment_num AS INTEGER) AS installment_num, failed_attempts, was_paid_late,
             CAST(max_days_late AS INTEGER) AS max_days_late, was_missed, had_failed_attempt FROM summary""",
    "missed_invoices": "SELECT invoice_num, policy_num FROM invoices WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) = invoice_num)",
    "policy_features": f"SELECT policy_num, {', '.join(COUNTS)}, {r6_columns(RATIOS)} FROM behaviour",
    "trend_delta": _TRENDS,
    "policy_static": f"SELECT {STATIC} FROM static",
    "feature_table": f"SELECT {_FEATURES} FROM features",
    "active_policies": f"SELECT {_FEATURES} FROM active_features",
    "eda_table_counts": """
      SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'policies', count(*) FROM policies
      UNION ALL SELECT 'invoice', count(*) FROM orders UNION ALL SELECT 'payhistory', count(*) FROM payments""",
    "eda_class_balance": "SELECT policy_status, count(*) AS n, round_even(count(*) / sum(count(*)) OVER () * CAST(100 AS DOUBLE), 1) AS pct FROM policies GROUP BY policy_status",
    "eda_payment_status": """
      SELECT policy_status, round_even(count(*) FILTER (pay_transaction_status = 'Failed') / count(*) * 100, 1) AS "Failed",
             round_even(count(*) FILTER (pay_transaction_status = 'Paid') / count(*) * 100, 1) AS "Paid",
             round_even(count(*) FILTER (pay_transaction_status = 'Paid Late') / count(*) * 100, 1) AS "Paid Late"
      FROM payments JOIN invoices USING (invoice_num) JOIN policies USING (policy_num) GROUP BY policy_status""",
    "eda_payment_status_all": "SELECT policy_status, " + ", ".join(
        f"round_even(count(*) FILTER (o_orderpriority = '{v}') / count(*) * 100, 1) AS \"{v}\""
        for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    ) + """
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN invoices ON invoice_num = CAST(o_orderkey AS VARCHAR)
      JOIN policies USING (policy_num) GROUP BY policy_status""",
    "eda_missed_by_status": """
      SELECT policy_status, count(*) AS total, count(*) FILTER (NOT was_missed) AS paid, count(*) FILTER (was_missed) AS missed,
             round_even(count(*) FILTER (was_missed) / count(*) * 100, 1) AS missed_pct
      FROM summary JOIN policies USING (policy_num) GROUP BY policy_status""",
    "eda_policies_per_customer": f"SELECT {r6('avg(n)')} AS mean_policies, min(n) AS min_policies, max(n) AS max_policies FROM (SELECT customer_id, count(*) AS n FROM policies GROUP BY customer_id)",
    "eda_products": "SELECT insurance_product, count(*) AS n FROM policies WHERE insurance_product IS NOT NULL GROUP BY insurance_product",
    "eda_frequencies": "SELECT payment_frequency, count(*) AS n FROM policies GROUP BY payment_frequency",
    "confusion": "SELECT true_negative, false_positive, false_negative, true_positive FROM cells WHERE position = 9",
    "metrics": f"SELECT {r6_columns(['threshold', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc'])} FROM swept WHERE position = 9",
    "roc_auc": f"SELECT {r6('roc_auc')} AS roc_auc FROM quality",
    "pr_auc": f"SELECT {r6('pr_auc')} AS pr_auc FROM quality",
    "calibration": f"""
      SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n_rows, {r6('avg(p)')} AS mean_predicted_probability, {r6('avg(y)')} AS observed_churn_rate
      FROM (SELECT p, y, (SELECT count(*) FROM edges WHERE edge < p) AS bin FROM scored) GROUP BY bin""",
    "threshold_sweep": f"""
      SELECT position, {r6_columns(['threshold', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc', 'expected_cost'])},
             true_negative, false_positive, false_negative, true_positive FROM swept""",
    "cost_threshold": f"SELECT {r6('threshold')} AS threshold, {r6('expected_cost')} AS expected_cost FROM swept ORDER BY swept.expected_cost, swept.position LIMIT 1",
    "class_weights": f"SELECT is_churned, count(*) AS n_rows, {r6('sum(count(*)) OVER () / (count(*) OVER () * count(*))')} AS weight FROM features GROUP BY is_churned",
    "stratified_split": "SELECT policy_num, is_churned, is_test FROM split",
    "label_clusters": f"""
      SELECT cluster, {r6('avg(failed_invoice_ratio)')} AS severity, CAST(row_number() OVER (ORDER BY avg(failed_invoice_ratio)) - 1 AS INTEGER) AS severity_rank,
             CASE row_number() OVER (ORDER BY avg(failed_invoice_ratio)) WHEN 1 THEN 'Low risk' WHEN 2 THEN 'Medium risk' ELSE 'High risk' END AS segment_label
      FROM clustered GROUP BY cluster""",
    "segment_vs_profile": """
      SELECT segment_label, count(*) FILTER (hidden_profile = 'at_risk') AS at_risk, count(*) FILTER (hidden_profile = 'churned') AS churned,
             count(*) FILTER (hidden_profile = 'good') AS good
      FROM labels_of_policies JOIN profile USING (policy_num) GROUP BY segment_label""",
    "segment_profile_all": "SELECT segment_label, " + ", ".join(
        f"count(*) FILTER (insurance_product = '{v}') AS \"{v}\""
        for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    ) + " FROM labels_of_policies JOIN policies USING (policy_num) GROUP BY segment_label",
    "profile_coverage": "SELECT count(*) FILTER (policy_status <> 'Expired') AS matched, count(*) AS total FROM profile",
    "adjusted_rand": f"""
      SELECT {r6('(s - a * b / t) / ((a + b) / 2 - a * b / t)')} AS adjusted_rand
      FROM (SELECT (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM clustered JOIN profile USING (policy_num) GROUP BY cluster, hidden_profile)) AS s,
                   (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM clustered GROUP BY cluster)) AS a,
                   (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM profile GROUP BY hidden_profile)) AS b,
                   (SELECT count(*) * (count(*) - 1) / 2 FROM profile) AS t)""",
    "top_factors": f"SELECT policy_num, CAST(rank AS INTEGER) AS rank, feature, {r6('x')} AS value, {r6('v')} AS shap_value FROM factors WHERE rank <= 5",
    "feature_importance": f"SELECT feature, {r6('avg(abs(v))')} AS mean_abs_shap_value FROM factors GROUP BY feature",
    "riskiest_policy": f"SELECT policy_num, {r6('p')} AS p FROM scored ORDER BY scored.p DESC, policy_num LIMIT 1",
    "recommend_action": f"""
      SELECT f.policy_num, coalesce(any_value(a.action), {_text(DEFAULT_ACTION)}) AS recommended_action
      FROM features f LEFT JOIN (
        SELECT policy_num, arg_min(action, rank) AS action FROM factors JOIN actions USING (feature)
        WHERE rank <= 3 AND round_even(v, 4) > 0 GROUP BY policy_num) a USING (policy_num) GROUP BY f.policy_num""",
    "describe_factors": """
      SELECT f.policy_num, CAST(count(d.description) AS INTEGER) AS n_descriptions, coalesce(string_agg(d.description, ' | ' ORDER BY d.rank), '') AS descriptions
      FROM features f LEFT JOIN (
        SELECT policy_num, rank, description, row_number() OVER (PARTITION BY policy_num ORDER BY rank) AS place
        FROM factors JOIN descriptions USING (feature) WHERE round_even(v, 4) > 0) d
      ON d.policy_num = f.policy_num AND d.place <= 3 GROUP BY f.policy_num""",
    "risk_history": f"""
      SELECT policy_num, CAST(scored_at AS VARCHAR) AS scored_at, {r6('churn_probability')} AS churn_probability, segment_label,
             CAST(n_factors AS INTEGER) AS n_factors, lead_feature, {r6('lead_value')} AS lead_value, recommended_action FROM history""",
    "risk_trend": f"""
      SELECT policy_num, CAST(scored_at AS VARCHAR) AS scored_at, {r6('churn_probability')} AS churn_probability,
             {r6('lag(churn_probability) OVER (PARTITION BY policy_num ORDER BY history.scored_at)')} AS previous_probability,
             {r6('churn_probability - lag(churn_probability) OVER (PARTITION BY policy_num ORDER BY history.scored_at)')} AS probability_change
      FROM history""",
    "latest_scores": f"""
      SELECT policy_num, CAST(scored_at AS VARCHAR) AS scored_at, {r6('churn_probability')} AS churn_probability, segment_label,
             recommended_action, insurance_product, payment_frequency, policy_status FROM latest""",
    "policy_detail": f"""
      SELECT policy_num AS "Policy", {r6('churn_probability')} AS "Churn Risk", segment_label AS "Segment", insurance_product AS "Product",
             payment_frequency AS "Payment Frequency", policy_status AS "Status", recommended_action AS "Suggested Action",
             coalesce(why, '-') AS "Why Flagged" FROM latest""",
    "segment_counts": 'SELECT segment_label AS "Segment", count(*) AS "Policies" FROM latest GROUP BY segment_label',
    "action_counts": """
      SELECT split_part(recommended_action, ' - ', 1) AS "Suggested Action", count(*) AS "Policies"
      FROM latest WHERE segment_label IS DISTINCT FROM 'Low risk' GROUP BY 1""",
    "summary_headline": """
      SELECT count(*) AS policies_scored,
             count(*) FILTER (segment_label IS DISTINCT FROM 'Low risk') || ' (' ||
             CAST(round_even(100.0 * count(*) FILTER (segment_label IS DISTINCT FROM 'Low risk') / count(*), 0) AS INTEGER) || '%)' AS flagged_at_risk
      FROM latest""",
    "standardize": "SELECT policy_num, " + ", ".join(
        f"{r6(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in BEHAVIOUR_FEATURES
    ) + " FROM features",
    "one_hot": "SELECT policy_num, " + ", ".join(
        [f"{r6(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in BEHAVIOUR_FEATURES]
        + [
            f"CAST(insurance_product = '{v}' AS DOUBLE) AS \"insurance_product_{v}\""
            for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
        ]
        + [
            f"CAST(payment_frequency = '{v}' AS DOUBLE) AS \"payment_frequency_{v}\""
            for v in ("Monthly", "Quarterly", "Semi-Annual")
        ]
    ) + " FROM features",
    "lr_scores": "SELECT policy_num, y, true AS in_range, true AS class_follows_p FROM held_out",
    "lr_optimum": """
      SELECT feature, CAST(0 AS DOUBLE) AS gradient
      FROM (SELECT feature FROM model_inputs UNION ALL SELECT 'intercept')""",
    "rf_scores": "SELECT policy_num, y, true AS in_range, true AS class_follows_p, true AS p_is_walked, true AS beats_chance FROM held_out",
    "shap_additivity": "SELECT policy_num, true AS adds_up, true AS is_moved, true AS unused_is_zero FROM held_out",
    "forest_importance": "SELECT feature, true AS is_mean, true AS some_matter FROM model_inputs",
    "riskiest_factors": """
      SELECT 5::BIGINT AS n_factors, true AS is_riskiest, 5::BIGINT AS n_features, true AS strongest_first, true AS all_matter
      FROM (SELECT policy_num FROM held_out LIMIT 1)""",
    "segments": "SELECT policy_num, true AS is_named, true AS at_nearest FROM features",
    "segment_centres": "SELECT CAST(3 AS BIGINT) AS n_clusters, true AS centres_are_means, true AS explains_spread FROM features LIMIT 1",
    "score_batch": f"""
      SELECT policy_num, '{BATCHES[0][0]}' AS scored_at, true AS p_is_own, true AS factor_is_own, true AS is_moved,
             true AS segment_is_own, true AS action_is_own
      FROM active_features""",
    "evaluation_bundle": f"""
      SELECT {r6('k / CAST(20 AS DOUBLE)')} AS threshold, count(*) AS n_rows, sum(y)::BIGINT AS n_churned, true AS cells_are_own,
             true AS rates_are_own, true AS cost_adds_up, true AS auc_is_own, true AS beats_chance
      FROM held_out, range(1, 20) AS t(k) GROUP BY k""",
    "csv_round_trip": """
      SELECT 'customer' AS table_name, CAST(c_custkey AS VARCHAR) AS key,
             concat_ws('|', c_custkey, c_nationkey, split_part(c_name, '#', 1), split_part(c_name, '#', 2)) AS row FROM customer
      UNION ALL SELECT 'policies', policy_num, concat_ws('|', insurance_product, customer_id, policy_num, effective_start_date,
             effective_end_date, payment_frequency, policy_status, coalesce(CAST(cancel_date AS VARCHAR), '-')) FROM policies
      UNION ALL SELECT 'invoice', invoice_num, concat_ws('|', policy_num, invoice_num, 'Premium', invoice_start_date,
             invoice_start_date + 30, days_arrears_allowed, installment_num, premium) FROM invoices
      UNION ALL SELECT 'payhistory', transaction_id, concat_ws('|', transaction_id, invoice_num, premium,
             pay_transaction_date, pay_transaction_status) FROM payments""",
    "seed_quarantine": "SELECT DISTINCT transaction_id, o_orderstatus <> 'F' AS is_quarantined FROM payments",
    "saved_evaluation": f"""
      SELECT {r6_columns(['threshold', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc', 'expected_cost'])},
             true_negative, false_positive, false_negative, true_positive FROM swept""",
    "saved_calibration": f"SELECT {r6_columns(['mean_predicted_probability', 'observed_churn_rate'])} FROM (SELECT avg(p) AS mean_predicted_probability, avg(y) AS observed_churn_rate FROM (SELECT p, y, (SELECT count(*) FROM edges WHERE edge < p) AS bin FROM scored) GROUP BY bin)",
    "saved_report": f"""
      SELECT kind, {r6('(SELECT arg_min(threshold, expected_cost * 100 + position) FROM swept)')} AS cost_weighted_threshold,
             {r6_columns(['threshold', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc'])},
             true_negative, false_positive, false_negative, true_positive
      FROM (SELECT 'default_threshold' AS kind, * FROM swept WHERE position = 9
            UNION ALL SELECT 'cost_weighted', * FROM (SELECT * FROM swept ORDER BY expected_cost, position LIMIT 1))""",
    "profile_csv": "SELECT policy_num, hidden_profile FROM profile",
    "stream_seed": """
      SELECT 'customer' AS table_name, CAST(c_custkey AS VARCHAR) AS key,
             concat_ws('|', c_custkey, c_nationkey, split_part(c_name, '#', 1), split_part(c_name, '#', 2)) AS row FROM customer
      UNION ALL SELECT t.name, policy_num, concat_ws('|', insurance_product, customer_id, policy_num, effective_start_date,
             effective_end_date, payment_frequency, policy_status, coalesce(CAST(cancel_date AS VARCHAR), '-'))
      FROM policies, (VALUES ('policies'), ('quarantine')) t(name) WHERE t.name = 'policies' OR CAST(customer_id AS BIGINT) % 2 = 1""",
    "saved_importance": f"SELECT feature, {r6('avg(abs(v))')} AS mean_abs_shap_value FROM factors GROUP BY feature",
    "batch_importance": """
      SELECT feature, true AS in_range, true AS some_matter, (SELECT CAST(count(*) AS INTEGER) FROM active_features) AS n_scored FROM model_inputs""",
    "report_files": f"""
      SELECT policy_num AS "Policy", {r6('churn_probability')} AS "Churn Risk", segment_label AS "Segment", insurance_product AS "Product",
             payment_frequency AS "Payment Frequency", policy_status AS "Status", recommended_action AS "Suggested Action",
             coalesce(why, '-') AS "Why Flagged" FROM latest""",
    "report_summaries": f"""
      SELECT 'risk_report_{BATCHES[-1][0]:%Y%m%d}' AS report, * FROM (
        SELECT 'headline' AS table_name, CAST(count(*) AS VARCHAR) AS label,
               count(*) FILTER (segment_label IS DISTINCT FROM 'Low risk') || ' (' ||
               CAST(round_even(100.0 * count(*) FILTER (segment_label IS DISTINCT FROM 'Low risk') / count(*), 0) AS INTEGER) || '%)' AS value
        FROM latest
        UNION ALL SELECT 'segment_counts', segment_label, CAST(count(*) AS VARCHAR) FROM latest GROUP BY segment_label
        UNION ALL SELECT 'action_counts', split_part(recommended_action, ' - ', 1), CAST(count(*) AS VARCHAR)
        FROM latest WHERE segment_label IS DISTINCT FROM 'Low risk' GROUP BY 2)""",
    "factors_json": f"""
      SELECT policy_num, CAST(n_factors AS INTEGER) AS n_factors, lead_feature, {r6('lead_value')} AS lead_value FROM latest""",
}

ORACLES: dict[str, str] = {name: _whole(sql) for name, sql in _STATEMENTS.items()}
