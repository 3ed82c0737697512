"""One DuckDB statement per registered query that SQL can restate."""

from __future__ import annotations

from .forest import FOREST
from .stages import (
    ANCHOR_SQL,
    CUSUM_SQL,
    DRIFT_SQL,
    FLAG_COLUMNS,
    IQR_SQL,
    METHODS,
    METRIC_NAME,
    METRICS,
    ROLLING_SQL,
    TYPES,
    UNIT,
    Z_SQL,
    compose,
    hu,
    pct,
    spine_view,
)

MEASURED = ("baseline_value", "observed_value", "deviation_abs", "deviation_pct")


def flag_view(source: str, key: str = "") -> str:
    columns = [f"{hu(c, 6)} AS {c}" if c in MEASURED else c for c in FLAG_COLUMNS.split(", ")]
    return f"SELECT {key}{', '.join(columns)} FROM {source}"


def rolling_view(source: str) -> str:
    return f"""
SELECT seller_id, metric_date, {METRIC_NAME} AS metric_name, u / {UNIT} AS observed_value, {hu(f"mean / {UNIT}", 6)} AS rolling_mean_28d,
       {hu(f"std / {UNIT}", 6)} AS rolling_std_28d, n AS rolling_n_28d, {hu("z", 6)} AS self_zscore
FROM {source}"""


COHORT_VIEW = f"""
SELECT seller_id, metric_date, {METRIC_NAME} AS metric_name, u / {UNIT} AS observed_value, tenure_cohort, primary_category, seller_segment,
       {hu(f"mean / {UNIT}", 6)} AS cohort_mean, {hu(f"std / {UNIT}", 6)} AS cohort_std, n AS cohort_n, {hu("z", 6)} AS cohort_zscore
FROM peer_z"""

Q: dict[str, str] = {}

Q["dim_date"] = """
SELECT d AS date_key, CAST(isodow(d) - 1 AS BIGINT) AS day_of_week, dayname(d) AS day_name, CAST(weekofyear(d) AS BIGINT) AS week_of_year,
       CAST(month(d) AS BIGINT) AS month_num, monthname(d) AS month_name, CAST(quarter(d) AS BIGINT) AS quarter, CAST(year(d) AS BIGINT) AS year,
       isodow(d) >= 6 AS is_weekend, strftime(d, '%m-%d') IN ('01-01', '07-04', '11-28', '12-25', '12-31') AS is_holiday,
       'FY' || year(d) || '-Q' || quarter(d) AS fiscal_period
FROM (SELECT CAST(unnest(generate_series(first_date - 365, last_date, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)"""

_COUNTS = {
    "total_sellers": "sellers",
    "total_products": "part",
    "total_customers": "(SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)",
    "total_orders": "lines",
    "total_shipments": "(SELECT 1 FROM lines WHERE NOT is_cancelled)",
    "total_returns": "(SELECT 1 FROM lines WHERE is_returned)",
    "total_reviews": "(SELECT 1 FROM lines WHERE is_reviewed)",
}
_SUMMARY = " UNION ALL ".join(f"SELECT '{k}' AS metric_name, count(*) AS metric_value FROM {t}" for k, t in _COUNTS.items())
Q["dataset_summary"] = f"SELECT s.*, TIMESTAMP '2020-11-15 00:00:00' AS computed_at FROM ({_SUMMARY}) s"
Q["r_summary_counts"] = _SUMMARY

_SHIP = "order_date + 1 + CAST(line_number % 2 AS INTEGER)"
_DELIVERY = "order_date + 3 + CAST(product_id % 5 AS INTEGER) + CAST(CASE WHEN is_late THEN 1 + line_number ELSE 0 END AS INTEGER)"
_CHECKS = {
    "duplicate_orders": "SELECT count(*) FROM (SELECT order_line_id FROM lines GROUP BY 1 HAVING count(*) > 1)",
    "orphan_order_seller_fk": "SELECT count(*) FROM lines o LEFT JOIN sellers s USING (seller_id) WHERE s.seller_name IS NULL",
    "orphan_shipment_order_fk": "SELECT count(*) FROM lines s WHERE NOT is_cancelled AND NOT EXISTS (SELECT 1 FROM lines o WHERE o.order_line_id = s.order_line_id)",
    "orphan_return_order_fk": "SELECT count(*) FROM lines s WHERE is_returned AND NOT EXISTS (SELECT 1 FROM lines o WHERE o.order_line_id = s.order_line_id)",
    "negative_gmv": "SELECT count(*) FROM lines WHERE gmv < 0",
    "negative_refund_amount": "SELECT count(*) FROM lines WHERE is_returned AND gmv < 0",
    "invalid_rating": "SELECT count(*) FROM lines WHERE is_reviewed AND rating NOT BETWEEN 1 AND 5",
    "delivery_before_ship": f"SELECT count(*) FROM lines WHERE NOT is_cancelled AND {_DELIVERY} < {_SHIP}",
    "order_date_before_seller_signup": "SELECT count(*) FROM lines JOIN sellers USING (seller_id) WHERE order_date < signup_date",
    "future_dated_orders": "SELECT count(*) FROM lines WHERE order_date > DATE '2020-11-15'",
    "null_seller_id_orders": "SELECT count(*) FROM lines WHERE seller_id IS NULL",
    "return_without_delivered_shipment": "SELECT count(*) FROM lines r WHERE is_returned AND NOT EXISTS (SELECT 1 FROM lines s WHERE NOT s.is_cancelled AND s.order_line_id = r.order_line_id)",
    "seller_daily_metrics_rate_out_of_bounds": "SELECT count(*) FROM spine_units WHERE defect_rate NOT BETWEEN 0 AND 10000 OR late_shipment_rate NOT BETWEEN 0 AND 10000 OR return_rate NOT BETWEEN 0 AND 10000 OR cancellation_rate NOT BETWEEN 0 AND 10000",
}


def report(checks: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{k}' AS \"check\", ({sql}) AS violations" for k, sql in checks.items())
    return f"SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"


Q["dq_report"] = report(_CHECKS)


def _outside(source: str, column: str, labels) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({', '.join(repr(x) for x in labels)})"


def _repeated(source: str, *keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"


_BUSINESS = "(SELECT (ARRAY['Individual', 'LLC', 'Corporation'])[s_suppkey % 3 + 1] AS business_type FROM supplier)"
_FULFILLMENT = "(SELECT (ARRAY['Marketplace-Fulfilled', 'Self-Ship'])[s_suppkey % 2 + 1] AS fulfillment_type FROM supplier)"
_PRICES = "(SELECT CASE WHEN p_retailprice < 1000 THEN 'Budget' WHEN p_retailprice < 1500 THEN 'Mid' ELSE 'Premium' END AS price_tier FROM part)"
_SEGMENTS = "(SELECT (ARRAY['New', 'Occasional', 'Frequent', 'VIP'])[c_custkey % 4 + 1] AS customer_segment FROM customer)"
_ORDERS = """(SELECT CASE WHEN is_cancelled THEN 'Cancelled' WHEN is_returned THEN 'Returned' WHEN source_status = 'F' THEN 'Delivered'
                       WHEN source_status = 'P' THEN 'Shipped' ELSE 'Placed' END AS order_status FROM lines)"""
_REASONS = "(SELECT CASE WHEN is_defect THEN 'Defective' ELSE 'Changed_Mind' END AS return_reason_code FROM lines WHERE is_returned)"
_SENTIMENT = """(SELECT CASE WHEN rating <= 2 THEN 'Negative' WHEN rating = 3 THEN 'Neutral' ELSE 'Positive' END AS sentiment_flag
                FROM lines WHERE is_reviewed)"""
_REASON_CODES = ("Defective", "Not_As_Described", "Wrong_Item", "Changed_Mind", "Late_Arrival", "Damaged_In_Transit", "Other")
_SEVERITIES = ("Low", "Medium", "High", "Critical")
_STATUSES = ("New", "Investigating", "Action_Required", "Resolved", "False_Positive", "Escalated")
_CAUSES = ("Logistics", "Inventory", "Pricing", "Product_Quality", "Seller_Behavior", "Review_Anomaly", "Data_Quality")
Q["dq_domains"] = report(
    {
        "dim_seller.tenure_cohort:enum": _outside("sellers", "tenure_cohort", ("New", "Growing", "Established", "Veteran")),
        "dim_seller.seller_segment:enum": _outside("sellers", "seller_segment", ("Micro", "Small", "Mid", "Power")),
        "dim_seller.business_type:enum": _outside(_BUSINESS, "business_type", ("Individual", "LLC", "Corporation")),
        "dim_seller.fulfillment_type:enum": _outside(_FULFILLMENT, "fulfillment_type", ("Marketplace-Fulfilled", "Self-Ship")),
        "dim_seller:unique": _repeated("sellers", "seller_id"),
        "dim_product.price_tier:enum": _outside(_PRICES, "price_tier", ("Budget", "Mid", "Premium")),
        "dim_product.list_price:range": "SELECT count(*) FROM part WHERE p_retailprice < 0",
        "dim_product:unique": _repeated("part", "p_partkey"),
        "dim_customer.customer_segment:enum": _outside(_SEGMENTS, "customer_segment", ("New", "Occasional", "Frequent", "VIP")),
        "dim_customer:unique": _repeated("customer", "c_custkey"),
        "fact_orders.order_status:enum": _outside(_ORDERS, "order_status", ("Placed", "Shipped", "Delivered", "Cancelled", "Returned")),
        "fact_orders.quantity:range": "SELECT count(*) FROM lines WHERE quantity < 1",
        "fact_orders.unit_price:range": "SELECT count(*) FROM lines WHERE unit_price < 0",
        "fact_orders.gmv:range": "SELECT count(*) FROM lines WHERE gmv < 0",
        "fact_returns.return_reason_code:enum": _outside(_REASONS, "return_reason_code", _REASON_CODES),
        "fact_returns.refund_amount:range": "SELECT count(*) FROM lines WHERE is_returned AND gmv < 0",
        "fact_reviews.sentiment_flag:enum": _outside(_SENTIMENT, "sentiment_flag", ("Positive", "Neutral", "Negative")),
        "fact_reviews.rating:range": "SELECT count(*) FROM lines WHERE is_reviewed AND rating NOT BETWEEN 1 AND 5",
        "fact_seller_daily_metrics:unique": _repeated("spine_units", "seller_id", "metric_date"),
        "fact_anomaly_flags.anomaly_type:enum": _outside("flags", "anomaly_type", TYPES),
        "fact_anomaly_flags.method:enum": _outside("flags", "method", METHODS),
        "fact_anomaly_flags.severity:enum": _outside("flags", "severity", _SEVERITIES),
        "fact_anomaly_flags:unique": _repeated("flags", "seller_id", "flag_date", "anomaly_type", "method"),
        "investigation_tickets.severity:enum": _outside("tickets", "severity", _SEVERITIES),
        "investigation_tickets.status:enum": _outside("tickets", "status", _STATUSES),
        "investigation_tickets.root_cause_category:enum": _outside("tickets", "root_cause_category", _CAUSES),
        "seller_health_score.health_tier:enum": _outside("health", "health_tier", ("Healthy", "Watch", "At_Risk", "Critical")),
        "seller_health_score.health_score:range": "SELECT count(*) FROM health WHERE health_score NOT BETWEEN 0 AND 100",
        "seller_health_score:unique": _repeated("health", "seller_id", "score_date"),
    }
)


def _nulls(source: str, columns: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE " + " OR ".join(f"{x} IS NULL" for x in columns.split())


def _lost(child: str, column: str, parent: str) -> str:
    """Rows whose value is in no row of the parent; null refers to nothing."""
    return f"SELECT count(*) FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.k = c.{column})"


_SELLER_KEYS = "(SELECT seller_id AS k FROM sellers)"
_PRODUCT_KEYS = "(SELECT p_partkey AS k FROM part)"
_CUSTOMER_KEYS = "(SELECT c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
_DAYS = f"(SELECT date_key AS k FROM ({Q['dim_date']}))"
_LINES = "(SELECT order_line_id AS k FROM lines)"
_ORDERED = "(SELECT l.*, o_custkey AS customer_id FROM lines l JOIN orders ON o_orderkey = CAST(split_part(order_line_id, '-', 1) AS BIGINT))"
_REVIEWED = f"(SELECT *, order_date + 1 + CAST(line_number AS INTEGER) AS review_date FROM {_ORDERED} WHERE is_reviewed)"
_RETURNED = "(SELECT *, order_date + 3 + 2 * CAST(line_number AS INTEGER) AS return_date FROM lines WHERE is_returned)"
_SHIPPED = "(SELECT * FROM lines WHERE NOT is_cancelled)"
_LINE_COLUMNS = "order_line_id seller_id product_id order_date"
Q["dq_keys"] = report(
    {
        "dim_seller:required": _nulls("sellers", "seller_id seller_name signup_date tenure_cohort seller_segment primary_category"),
        "dim_seller:key": _repeated("sellers", "seller_id"),
        "dim_product:required": _nulls("part", "p_partkey p_name p_type p_brand p_retailprice"),
        "dim_product:key": _repeated("part", "p_partkey"),
        "dim_product.seller_id:reference": _lost("(SELECT p_partkey % 10 AS seller_id FROM part)", "seller_id", _SELLER_KEYS),
        "dim_customer:required": _nulls(_CUSTOMER_KEYS, "k"),
        "dim_customer:key": _repeated(_CUSTOMER_KEYS, "k"),
        "dim_date:required": _nulls(_DAYS, "k"),
        "dim_date:key": _repeated(_DAYS, "k"),
        "fact_orders:required": _nulls(_ORDERED, f"{_LINE_COLUMNS} customer_id quantity unit_price gmv is_cancelled"),
        "fact_orders:key": _repeated("lines", "order_line_id"),
        "fact_orders.seller_id:reference": _lost("lines", "seller_id", _SELLER_KEYS),
        "fact_orders.product_id:reference": _lost("lines", "product_id", _PRODUCT_KEYS),
        "fact_orders.customer_id:reference": _lost(_ORDERED, "customer_id", _CUSTOMER_KEYS),
        "fact_orders.order_date:reference": _lost("lines", "order_date", _DAYS),
        "fact_shipments:required": _nulls(_SHIPPED, f"{_LINE_COLUMNS} is_late line_number"),
        "fact_shipments:key": _repeated(_SHIPPED, "order_line_id"),
        "fact_shipments.order_line_id:reference": _lost(_SHIPPED, "order_line_id", _LINES),
        "fact_shipments.seller_id:reference": _lost(_SHIPPED, "seller_id", _SELLER_KEYS),
        "fact_returns:required": _nulls(_RETURNED, f"{_LINE_COLUMNS} return_date gmv is_defect"),
        "fact_returns:key": _repeated(_RETURNED, "order_line_id"),
        "fact_returns.order_line_id:reference": _lost(_RETURNED, "order_line_id", _LINES),
        "fact_returns.seller_id:reference": _lost(_RETURNED, "seller_id", _SELLER_KEYS),
        "fact_returns.return_date:reference": _lost(_RETURNED, "return_date", _DAYS),
        "fact_reviews:required": _nulls(_REVIEWED, f"{_LINE_COLUMNS} customer_id review_date rating"),
        "fact_reviews:key": _repeated(_REVIEWED, "order_line_id"),
        "fact_reviews.product_id:reference": _lost(_REVIEWED, "product_id", _PRODUCT_KEYS),
        "fact_reviews.seller_id:reference": _lost(_REVIEWED, "seller_id", _SELLER_KEYS),
        "fact_reviews.customer_id:reference": _lost(_REVIEWED, "customer_id", _CUSTOMER_KEYS),
        "fact_reviews.review_date:reference": _lost(_REVIEWED, "review_date", _DAYS),
        "fact_seller_daily_metrics:required": _nulls("spine_units", "seller_id metric_date order_volume gmv defect_rate price_volatility"),
        "fact_seller_daily_metrics.seller_id:reference": _lost("spine_units", "seller_id", _SELLER_KEYS),
        "fact_seller_daily_metrics.metric_date:reference": _lost("spine_units", "metric_date", _DAYS),
        "fact_anomaly_flags:required": _nulls("flags", "flag_id seller_id flag_date anomaly_type affected_metric method anomaly_score severity explanation"),
        "fact_anomaly_flags:key": _repeated("flags", "flag_id"),
        "fact_anomaly_flags.seller_id:reference": _lost("flags", "seller_id", _SELLER_KEYS),
        "fact_anomaly_flags.flag_date:reference": _lost("flags", "flag_date", _DAYS),
        "investigation_tickets:required": _nulls("tickets", "case_id seller_id severity priority_score detected_date sla_deadline status"),
        "investigation_tickets:key": _repeated("tickets", "case_id"),
        "investigation_tickets.seller_id:reference": _lost("tickets", "seller_id", _SELLER_KEYS),
        "investigation_tickets.primary_flag_id:reference": _lost("tickets", "primary_flag_id", "(SELECT flag_id AS k FROM flags)"),
        "ground_truth_anomalies:required": _nulls("episodes", "ground_truth_id seller_id anomaly_type start_date end_date"),
        "ground_truth_anomalies:key": _repeated("episodes", "ground_truth_id"),
        "ground_truth_anomalies.seller_id:reference": _lost("episodes", "seller_id", _SELLER_KEYS),
        "seller_health_score:required": _nulls("health", "seller_id score_date health_score health_tier"),
        "seller_health_score.seller_id:reference": _lost("health", "seller_id", _SELLER_KEYS),
        "seller_health_score.score_date:reference": _lost("health", "score_date", _DAYS),
    }
)

Q["trimmed_extract"] = f"SELECT * FROM ({COHORT_VIEW}) WHERE metric_date >= (SELECT max(metric_date) - 60 FROM spine_units)"
Q["daily_metrics"] = spine_view("spine_units")
Q["rolling_baseline"] = rolling_view("self_z")
Q["cohort_baseline"] = COHORT_VIEW
for _t in ("zscore_flags", "iqr_flags", "cusum_flags"):
    Q[_t] = flag_view(_t)
Q["ensemble_flags"] = flag_view("ensemble")
Q["anomaly_flags"] = flag_view("flags", "flag_id, ")
Q["ensemble_votes"] = f"""
SELECT seller_id, flag_date, anomaly_type, n_methods, array_to_string(methods, ',') AS methods, {hu('avg_score', 6)} AS avg_score, max_score,
       n_distinct_types FROM votes"""


def labelled(column: str, labels) -> str:
    return "(VALUES " + ", ".join(f"('{x}')" for x in labels) + f") l({column})"


Q["method_flag_counts"] = f"""
SELECT l.method, count(f.flag_id) AS n FROM {labelled("method", METHODS)} LEFT JOIN flags f ON f.method = l.method GROUP BY 1"""
Q["health_score"] = "SELECT * FROM health"
Q["priority_score"] = "SELECT * FROM priority"
Q["tickets"] = "SELECT * FROM new_tickets"
Q["ticket_merge"] = "SELECT * FROM merged_tickets"
Q["sla_breaches"] = "SELECT * FROM tickets"
Q["sla_summary"] = f"""
SELECT status, count(*) AS n_tickets, count(*) FILTER (is_sla_breached) AS n_breached,
       {pct("count(*) FILTER (is_sla_breached)", "count(*)")} AS pct_breached
FROM tickets GROUP BY status"""

Q["eval_methods"] = f"""
SELECT method, n_flags, n_ground_truth_episodes, {hu("r", 4)} AS recall, {hu("p", 4)} AS precision,
       CASE WHEN p + r > 0 THEN {hu("2 * p * r / (p + r)", 4)} ELSE 0.0 END AS f1,
       CASE WHEN n_flags > 0 THEN {hu("1 - p", 4)} ELSE 0.0 END AS false_positive_rate, {hu("delay", 2)} AS mean_detection_delay_days
FROM (SELECT l.method, (SELECT count(*) FROM flags f WHERE f.method = l.method) AS n_flags,
             (SELECT count(*) FROM episodes) AS n_ground_truth_episodes,
             (SELECT count(*) FROM hits h WHERE h.method = l.method) / CAST((SELECT count(*) FROM episodes) AS DOUBLE) AS r,
             coalesce((SELECT count(*) FILTER (is_true) / CAST(count(*) AS DOUBLE) FROM judged j WHERE j.method = l.method HAVING count(*) > 0), 0.0) AS p,
             (SELECT avg(delay) FROM hits h WHERE h.method = l.method) AS delay
      FROM {labelled("method", METHODS)})"""
Q["eval_type_recall"] = f"""
SELECT l.method, e.anomaly_type, count(*) AS n_episodes, count(h.ground_truth_id) AS n_detected,
       {hu("count(h.ground_truth_id) / CAST(count(*) AS DOUBLE)", 4)} AS recall
FROM {labelled("method", METHODS)} CROSS JOIN episodes e
LEFT JOIN hits h ON h.ground_truth_id = e.ground_truth_id AND h.method = l.method GROUP BY 1, 2"""
Q["eval_severity"] = f"""
SELECT l.severity, count(j.flag_id) AS n_flags,
       CASE WHEN count(j.flag_id) > 0 THEN {hu("count(*) FILTER (j.is_true) / CAST(count(j.flag_id) AS DOUBLE)", 4)} ELSE 0.0 END AS precision
FROM {labelled("severity", _SEVERITIES)} LEFT JOIN (SELECT * FROM judged WHERE method = 'Ensemble') j ON j.severity = l.severity GROUP BY 1"""
Q["eval_confusion"] = f"""
SELECT method, count(*) FILTER (f AND t) AS tp, count(*) FILTER (f AND NOT t) AS fp, count(*) FILTER (t AND NOT f) AS fn,
       count(*) FILTER (NOT f AND NOT t) AS tn
FROM (SELECT l.method, s.seller_id, EXISTS (SELECT 1 FROM flags g WHERE g.seller_id = s.seller_id AND g.method = l.method) AS f,
             EXISTS (SELECT 1 FROM episodes e WHERE e.seller_id = s.seller_id) AS t
      FROM {labelled("method", METHODS)} CROSS JOIN (SELECT seller_id FROM flags UNION SELECT seller_id FROM episodes) s) GROUP BY 1"""

Q["business_impact"] = f"""
SELECT count(*) FILTER (start_date IS NOT NULL) AS n_cases, (SELECT count(*) FROM tickets WHERE status IN ('Resolved', 'Escalated')) AS n_all_resolved_tickets,
       {hu("sum(days) / CAST(nullif(count(start_date), 0) AS DOUBLE)", 1)} AS mean_days_saved,
       CAST(coalesce(sum(saved), 0) AS BIGINT) AS total_orders_protected, CAST(coalesce(sum(saved), 0) AS BIGINT) AS total_customers_protected_estimate,
       {hu("coalesce(sum(exposure), 0)", 2)} AS total_gmv_exposure_avoided, CAST(coalesce(sum(saved), 0) * 8 AS DOUBLE) AS total_defect_cost_avoided_usd,
       count(start_date) * 3 AS investigation_hours_saved, count(start_date) * 3 * 45 AS investigation_cost_saved_usd
FROM (SELECT *, {hu("days * orders", 0)} AS saved, {hu("days * gmv", 2)} AS exposure
      FROM (SELECT e.start_date, greatest(0, 10 - (t.detected_date - e.start_date)) AS days, a.orders, a.gmv
            FROM tickets t JOIN flags f ON f.flag_id = t.primary_flag_id
            JOIN episodes e ON e.seller_id = t.seller_id AND e.anomaly_type = f.anomaly_type AND t.detected_date >= e.start_date
            JOIN (SELECT seller_id, sum(order_volume) / CAST(count(*) AS DOUBLE) AS orders, sum(gmv) / 100.0::DOUBLE / count(*) AS gmv
                  FROM spine_units GROUP BY 1) a ON a.seller_id = t.seller_id
            WHERE t.status IN ('Resolved', 'Escalated')))"""

Q["q1_deteriorating"] = f"""
SELECT seller_id, seller_name, primary_category, seller_segment, before AS health_score_30d_ago, health_score AS health_score_today,
       {hu("health_score - before", 1)} AS score_change_30d
FROM (SELECT *, lag(health_score, 30) OVER (PARTITION BY seller_id ORDER BY score_date) AS before,
             row_number() OVER (PARTITION BY seller_id ORDER BY score_date DESC) AS rn FROM health) JOIN sellers USING (seller_id)
WHERE rn = 1 AND before IS NOT NULL ORDER BY score_change_30d, seller_id LIMIT 25"""
_UNRESOLVED = "status NOT IN ('Resolved', 'False_Positive')"
Q["q2_critical"] = f"""
SELECT seller_id, seller_name, primary_category, seller_segment, health_score, health_tier, defect_component, late_shipment_component,
       return_component, review_component, (SELECT count(*) FROM tickets t WHERE t.seller_id = h.seller_id AND {_UNRESOLVED}) AS open_tickets
FROM latest h JOIN sellers USING (seller_id) WHERE health_tier = 'Critical'"""
Q["q2_critical_before"] = Q["q2_critical"].replace(
    "FROM latest h", "FROM (SELECT * FROM health WHERE score_date = (SELECT max(score_date) FROM health WHERE health_tier = 'Critical')) h"
)
Q["q3_impact"] = """
SELECT case_id, t.seller_id, seller_name, anomaly_type, affected_metric, t.severity, priority_score, detected_date, status,
       m.gmv / 100.0::DOUBLE AS gmv_on_detection_day, m.order_volume AS orders_on_detection_day
FROM tickets t JOIN flags f ON f.flag_id = t.primary_flag_id JOIN sellers s ON s.seller_id = t.seller_id
LEFT JOIN spine_units m ON m.seller_id = t.seller_id AND m.metric_date = t.detected_date
ORDER BY priority_score DESC, case_id LIMIT 25"""
_RECENT = "metric_date >= (SELECT max(metric_date) - 30 FROM spine_units) AND z IS NOT NULL"
Q["q4_vs_peers"] = f"""
SELECT seller_id, s.seller_name, p.tenure_cohort, p.primary_category, p.seller_segment, {hu("avg(abs(z))", 2)} AS avg_abs_cohort_zscore_30d,
       count(*) FILTER (round(abs(z), 9) >= 2.5) AS days_flagged_vs_peers
FROM peer_z p JOIN sellers s USING (seller_id) WHERE metric IN (0, 1, 2) AND {_RECENT}
GROUP BY ALL HAVING count(*) >= 10 ORDER BY avg_abs_cohort_zscore_30d DESC, seller_id LIMIT 25"""
Q["q5_detection_speed"] = f"""
SELECT anomaly_type, count(*) AS n_detected, {hu("avg(delay)", 1)} AS mean_delay_days, CAST(median(delay) AS DOUBLE) AS median_delay_days,
       min(delay) AS best_case_days, max(delay) AS worst_case_days
FROM hits WHERE method = 'Ensemble' GROUP BY 1"""
Q["q6_false_positive"] = f"""
SELECT anomaly_type, count(*) AS total_closed_tickets, count(*) FILTER (status = 'False_Positive') AS false_positives,
       count(*) FILTER (status = 'Resolved') AS resolved, count(*) FILTER (status = 'Escalated') AS escalated,
       {pct("count(*) FILTER (status = 'False_Positive')", "count(*)")} AS false_positive_pct
FROM tickets t JOIN flags f ON f.flag_id = t.primary_flag_id WHERE status IN ('Resolved', 'False_Positive', 'Escalated') GROUP BY 1"""
Q["q7_category_risk"] = f"""
SELECT primary_category, count(*) AS n_sellers, {hu("CAST(sum(CAST(round(health_score * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*)", 1)} AS avg_health_score,
       count(*) FILTER (health_tier IN ('At_Risk', 'Critical')) AS at_risk_or_critical_sellers,
       {pct("count(*) FILTER (health_tier IN ('At_Risk', 'Critical'))", "count(*)")} AS pct_at_risk_or_critical,
       (SELECT count(*) FROM tickets t JOIN sellers s2 USING (seller_id) WHERE s2.primary_category = s.primary_category AND {_UNRESOLVED}) AS open_tickets
FROM latest JOIN sellers s USING (seller_id) GROUP BY primary_category"""
Q["q8_repeat"] = """
SELECT t.seller_id, seller_name, seller_segment, count(*) AS total_tickets, count(*) FILTER (status = 'False_Positive') AS false_positive_tickets,
       count(*) FILTER (status <> 'False_Positive') AS genuine_tickets, count(DISTINCT anomaly_type) AS distinct_anomaly_types,
       min(detected_date) AS first_flagged, max(detected_date) AS most_recent_flagged
FROM tickets t JOIN flags f ON f.flag_id = t.primary_flag_id JOIN sellers s ON s.seller_id = t.seller_id
GROUP BY ALL HAVING count(*) >= 3 ORDER BY genuine_tickets DESC, total_tickets DESC, t.seller_id LIMIT 25"""
_OPEN = "status NOT IN ('Resolved', 'False_Positive', 'Escalated')"
_MEAN_HOURS = hu("sum(date_diff('second', CAST(detected_date AS TIMESTAMP), resolved_at)) / CAST(nullif(count(resolved_at), 0) AS DOUBLE) / 3600", 1)
_BREACH_PCT = pct("count(*) FILTER (is_sla_breached)", "count(*)")
Q["q9_workload"] = f"""
SELECT assigned_investigator, count(*) AS total_cases, count(*) FILTER ({_OPEN}) AS open_cases, count(*) FILTER (is_sla_breached) AS sla_breaches,
       {_BREACH_PCT} AS sla_breach_pct, {_MEAN_HOURS} AS avg_resolution_hours
FROM tickets GROUP BY 1"""
Q["q10_queue"] = f"""
SELECT case_id, t.seller_id, seller_name, anomaly_type, affected_metric, t.severity, priority_score, status, assigned_investigator, sla_deadline,
       {hu("hours", 6)} AS hours_until_sla_deadline,
       CASE WHEN is_sla_breached THEN 'BREACHED' WHEN hours < 24 THEN 'URGENT' ELSE 'ON_TRACK' END AS sla_status, explanation
FROM (SELECT t.*, date_diff('second', CAST(last_date AS TIMESTAMP), sla_deadline) / 3600.0::DOUBLE AS hours FROM tickets t, bounds) t
JOIN flags f ON f.flag_id = t.primary_flag_id JOIN sellers s ON s.seller_id = t.seller_id
WHERE {_UNRESOLVED} ORDER BY priority_score DESC, case_id LIMIT 50"""

_TIERS = ("Healthy", "Watch", "At_Risk", "Critical")
Q["r_tier_mix"] = f"""
SELECT l.health_tier, count(h.seller_id) AS n FROM {labelled("health_tier", _TIERS)} LEFT JOIN latest h ON h.health_tier = l.health_tier GROUP BY 1"""
Q["r_ops_headline"] = f"""
SELECT count(*) FILTER ({_UNRESOLVED}) AS active_investigations, count(*) AS total_tickets, count(*) FILTER (is_sla_breached) AS sla_breaches,
       coalesce({_BREACH_PCT}, 0.0) AS sla_breach_pct FROM tickets"""


def histogram(source: str, column: str, bins: int, by: str = "") -> str:
    return f"""
SELECT {by}bin, {hu(f"low + bin * ((high - low) / {bins})", 4)} AS bin_start, count(*) AS n
FROM (SELECT {by}low, high, CASE WHEN high > low THEN CAST(least(floor(round(({column} - low) / ((high - low) / {bins}), 9)), {bins - 1}) AS BIGINT) ELSE 0 END AS bin
      FROM {source}, (SELECT min({column}) AS low, max({column}) AS high FROM {source}))
GROUP BY {by}bin, low, high"""


Q["r_health_hist"] = histogram("latest", "health_score", 40)
Q["r_priority_hist"] = histogram(f"(SELECT * FROM tickets WHERE {_OPEN})", "priority_score", 30, "severity, ")
_CASES = "flags WHERE method = 'Ensemble'"
Q["r_flag_trend"] = f"SELECT flag_date, count(*) AS n FROM {_CASES} GROUP BY 1"
_ANOMALIES = "(SELECT count(*) FROM flags f WHERE f.method = 'Ensemble' AND f.seller_id = h.seller_id)"
Q["r_top_risk"] = f"""
SELECT seller_id, seller_name, seller_segment, primary_category, health_score, health_tier, {_ANOMALIES} AS anomaly_count
FROM latest h JOIN sellers USING (seller_id) ORDER BY health_score, seller_id LIMIT 5"""
Q["r_risky"] = f"""
SELECT h.seller_id, seller_name, seller_segment, primary_category, health_score, health_tier, m.defect_rate / 10000.0::DOUBLE AS defect_rate,
       m.late_shipment_rate / 10000.0::DOUBLE AS late_shipment_rate, m.return_rate / 10000.0::DOUBLE AS return_rate,
       m.avg_rating / 1000.0::DOUBLE AS avg_rating, {_ANOMALIES} AS anomaly_count,
       (SELECT max(priority_score) FROM tickets t WHERE t.seller_id = h.seller_id AND {_UNRESOLVED}) AS open_priority_score
FROM latest h JOIN sellers s ON s.seller_id = h.seller_id
LEFT JOIN spine_units m ON m.seller_id = h.seller_id AND m.metric_date = h.score_date
ORDER BY health_score, h.seller_id LIMIT 30"""
Q["r_flag_frequency"] = f"""
SELECT seller_id, seller_name, anomaly_count FROM (
  SELECT seller_id, seller_name, {_ANOMALIES} AS anomaly_count FROM latest h JOIN sellers USING (seller_id) ORDER BY health_score, seller_id LIMIT 30)
ORDER BY anomaly_count DESC, seller_id LIMIT 15"""
Q["r_peer_heatmap"] = f"""
SELECT seller_id, seller_name, {", ".join(f"{hu(f'avg(abs(z)) FILTER (metric = {i})', 6)} AS {m[0]}" for i, m in enumerate(METRICS))}
FROM peer_z JOIN sellers USING (seller_id)
WHERE {_RECENT} AND seller_id IN (SELECT seller_id FROM latest ORDER BY health_score, seller_id LIMIT 30) GROUP BY 1, 2"""
Q["r_weekly_types"] = f"SELECT CAST(date_trunc('week', flag_date) AS DATE) AS week, anomaly_type, count(*) AS n FROM {_CASES} GROUP BY 1, 2"
Q["r_type_totals"] = f"SELECT anomaly_type, count(*) AS n FROM {_CASES} GROUP BY 1"
Q["r_ticket_kpi"] = f"""
SELECT count(*) AS total_tickets, count(*) FILTER ({_OPEN}) AS open_tickets, count(*) FILTER (NOT ({_OPEN})) AS closed_tickets,
       count(*) FILTER (severity = 'Critical') AS critical_tickets, count(*) FILTER (is_sla_breached) AS sla_breaches,
       {_BREACH_PCT} AS sla_breach_pct, {_MEAN_HOURS} AS avg_resolution_hours FROM tickets"""
Q["r_assigned_workload"] = "SELECT assigned_investigator, count(*) AS n FROM tickets WHERE assigned_investigator IS NOT NULL GROUP BY 1"
Q["r_queue"] = """
SELECT case_id, t.seller_id, seller_name, anomaly_type, affected_metric, t.severity, priority_score, status, assigned_investigator, detected_date,
       sla_deadline, is_sla_breached, explanation
FROM tickets t JOIN flags f ON f.flag_id = t.primary_flag_id JOIN sellers s ON s.seller_id = t.seller_id
WHERE status IN ('New', 'Investigating', 'Action_Required') AND t.severity IN ('Critical', 'High')"""
Q["r_seller360"] = f"""
SELECT s.seller_id, seller_name, seller_segment, tenure_cohort, primary_category, health_score, health_tier,
       (SELECT count(*) FROM tickets t WHERE t.seller_id = s.seller_id AND {_UNRESOLVED}) AS open_cases,
       (SELECT max(priority_score) FROM tickets t WHERE t.seller_id = s.seller_id AND {_UNRESOLVED}) AS top_priority
FROM sellers s LEFT JOIN (SELECT seller_id, arg_max(health_score, score_date) AS health_score, arg_max(health_tier, score_date) AS health_tier
                          FROM health GROUP BY 1) h ON h.seller_id = s.seller_id"""
Q["r_seller_history"] = "SELECT seller_id, score_date, health_score, health_tier FROM health"
Q["r_seller_metrics"] = """
SELECT seller_id, metric_date, defect_rate / 10000.0::DOUBLE AS defect_rate, late_shipment_rate / 10000.0::DOUBLE AS late_shipment_rate,
       return_rate / 10000.0::DOUBLE AS return_rate, avg_rating / 1000.0::DOUBLE AS avg_rating, order_volume, gmv / 100.0::DOUBLE AS gmv
FROM spine_units"""
Q["r_seller_flags"] = f"""
SELECT seller_id, flag_date, anomaly_type, affected_metric, method, severity, anomaly_score, explanation FROM {_CASES}"""
Q["r_seller_tickets"] = """
SELECT seller_id, case_id, detected_date, severity, priority_score, status, assigned_investigator, root_cause_category, resolution,
       is_sla_breached FROM tickets"""
Q["r_peer_latest"] = f"""
SELECT seller_id, metric_name, observed_value, cohort_mean, cohort_zscore FROM ({COHORT_VIEW})
WHERE metric_date = (SELECT max(metric_date) FROM spine_units)"""
Q["m_flag_mom"] = f"""
SELECT a.month, a.flags, CAST(b.flags AS DOUBLE) AS flags_prior_month, {hu("100.0 * (a.flags - b.flags) / CAST(b.flags AS DOUBLE)", 2)} AS mom_pct
FROM (SELECT CAST(date_trunc('month', flag_date) AS DATE) AS month, count(*) AS flags FROM {_CASES} GROUP BY 1) a
LEFT JOIN (SELECT CAST(date_trunc('month', flag_date) AS DATE) AS month, count(*) AS flags FROM {_CASES} GROUP BY 1) b
  ON b.month = a.month - INTERVAL 1 MONTH"""
Q["m_executive"] = f"""
SELECT (SELECT count(*) FROM sellers) AS total_sellers,
       (SELECT {hu("CAST(sum(CAST(round(health_score * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*)", 2)} FROM latest) AS avg_health_score,
       count(*) FILTER (status IN ('New', 'Investigating', 'Action_Required')) AS active_investigations,
       {pct("count(*) FILTER (is_sla_breached)", "count(*)", 2)} AS sla_breach_rate, {_MEAN_HOURS} AS avg_resolution_hours
FROM tickets"""
Q["m_gmv_at_risk"] = """
SELECT count(DISTINCT seller_id) AS sellers_at_risk, coalesce(sum(gmv), 0) / 100.0::DOUBLE AS gmv_at_risk
FROM spine_units WHERE seller_id IN (SELECT seller_id FROM latest WHERE health_tier IN ('At_Risk', 'Critical'))"""

# The user-event series: metrics 1, 5 and 6 of the registry, and only days with events.
EVENT_STAGES = {
    "event_days": """
SELECT user_id AS seller_id, CAST(ts AS DATE) AS metric_date, count(*) AS volume,
       (2 * 10000 * count(*) FILTER (event_type = 'error') + count(*)) // (2 * count(*)) AS errors,
       CASE WHEN count(value) > 0 THEN (2 * CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) + count(value)) // (2 * count(value)) END AS price
FROM events GROUP BY ALL""",
    "event_units": """
SELECT seller_id, metric_date, 1 AS metric, CAST(errors AS BIGINT) AS u FROM event_days
UNION ALL SELECT seller_id, metric_date, 5, CAST(price AS BIGINT) FROM event_days WHERE price IS NOT NULL
UNION ALL SELECT seller_id, metric_date, 6, CAST(volume AS BIGINT) FROM event_days""",
    "event_rolling": ROLLING_SQL.format(source="event_units"),
    "event_z": Z_SQL.format(source="event_rolling"),
    "event_anchored": ANCHOR_SQL.format(source="event_units"),
    "event_drift": DRIFT_SQL.format(anchored="event_anchored", drift="event_drift"),
    "event_iqr": IQR_SQL.replace("{rolling}", "event_rolling"),
    "event_cusum": CUSUM_SQL.replace("{drift}", "event_drift"),
}
Q["activity_rolling"] = rolling_view("event_z")
Q["activity_flags"] = f"{flag_view('event_iqr')} UNION ALL {flag_view('event_cusum')}"

# The queries in which the isolation forest votes too.
Q["iforest_flags"] = flag_view("forest_flags")
for _name in ("anomaly_flags", "health_score", "eval_methods"):
    Q[f"forest_{_name}"] = Q[_name]
Q["forest_tickets"] = Q["sla_breaches"]


def _stages_of(name: str) -> dict[str, str] | None:
    return EVENT_STAGES if name.startswith("activity_") else FOREST if name.startswith(("forest_", "iforest_")) else None


ORACLES = {name: compose(sql, _stages_of(name)) for name, sql in Q.items()}
