"""The engine's stages restated as DuckDB SQL, each a named table expression.

Written apart from the Spark code: metrics are whole numbers of their stored scale, the drift sum is
a recursion over the days, peers are grouped and joined, episodes are matched as intervals.
"""

from __future__ import annotations

import re

# Metric, anomaly type, bad direction and stored decimals, in order.
METRICS = [
    ("late_shipment_rate", "Late_Shipment_Spike", "up", 4),
    ("defect_rate", "Defect_Rate_Rise", "up", 4),
    ("return_rate", "Return_Rate_Spike", "up", 4),
    ("review_velocity", "Review_Velocity_Spike", "up", 3),
    ("avg_rating", "Rating_Manipulation", "up", 3),
    ("avg_price", "Price_Anomaly", "both", 2),
    ("order_volume", "Order_Volume_Shock", "both", 0),
    ("cancellation_rate", "Multi_Metric_Deterioration", "up", 4),
    ("negative_review_rate", "Multi_Metric_Deterioration", "up", 4),
    ("refund_rate", "Multi_Metric_Deterioration", "up", 4),
]
MULTI = "Multi_Metric_Deterioration"
TYPES = list(dict.fromkeys(m[1] for m in METRICS))
METHODS = ["ZScore", "IQR", "CUSUM", "IsolationForest", "Ensemble"]


def exact(x: str) -> str:
    return f"CAST(round({x}, 9) AS DECIMAL(38,10))"


def hu(x: str, digits: int) -> str:
    """Round half away from zero on the decimal reading of a double."""
    return f"CAST(round({exact(x)}, {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return f"CASE WHEN {whole} > 0 THEN {hu(f'100.0 * ({part}) / CAST({whole} AS DOUBLE)', digits)} END"


def half(numerator: str, denominator: str, scale: int) -> str:
    """numerator / denominator in whole units of 1/scale, half up; both are whole and not negative."""
    return f"((2 * {scale} * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def fmt(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {hu(x, digits)})"


def severity(score: str) -> str:
    return f"CASE WHEN {score} >= 6 THEN 'Critical' WHEN {score} >= 4 THEN 'High' WHEN {score} >= 2.5 THEN 'Medium' ELSE 'Low' END"


def tier(score: str) -> str:
    return f"CASE WHEN {score} >= 80 THEN 'Healthy' WHEN {score} >= 60 THEN 'Watch' WHEN {score} >= 40 THEN 'At_Risk' ELSE 'Critical' END"


def case(column: str, pairs) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in pairs) + " END"


def metric_case(position: int) -> str:
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
    return "CASE metric " + " ".join(f"WHEN {i} THEN {quoted(m[position])}" for i, m in enumerate(METRICS)) + " END"


METRIC_NAME = metric_case(0)
ORDINAL = case("affected_metric", [(m[0], i) for i, m in enumerate(METRICS)])
UNIT = "CASE metric " + " ".join(f"WHEN {i} THEN {10 ** m[3]}.0::DOUBLE" for i, m in enumerate(METRICS)) + " END"
FLAG_COLUMNS = (
    "seller_id, flag_date, anomaly_type, affected_metric, baseline_value, observed_value, deviation_abs, "
    "deviation_pct, method, anomaly_score, severity, reason_code, explanation"
)

STAGES: dict[str, str] = {}

STAGES["lines"] = f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_line_id,
       l_suppkey AS seller_id, l_partkey AS product_id, l_linenumber AS line_number,
       DATE '2020-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 7 AS INTEGER) AS order_date,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS gmv,
       {half("CAST(round(l_extendedprice * 100) AS BIGINT)", "CAST(l_quantity AS BIGINT)", 1)} AS unit_price,
       CAST(l_quantity AS BIGINT) AS quantity, o_orderstatus AS source_status,
       o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AS is_cancelled,
       date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 1500 AS is_late,
       l_returnflag = 'R' AND CAST(round(l_discount * 100) AS BIGINT) >= 8 AS is_returned,
       l_linestatus = 'F' AS is_defect,
       CAST(round(l_tax * 100) AS BIGINT) <= 1 AS is_reviewed,
       1 + (l_partkey + 7 * l_linenumber) % 5 AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

STAGES["sellers"] = """
SELECT s_suppkey AS seller_id, s_name AS seller_name,
       DATE '2020-01-01' + CAST(s_suppkey * 37 % 100 AS INTEGER) AS signup_date,
       CASE WHEN s_suppkey % 2 = 0 THEN 'New' ELSE 'Veteran' END AS tenure_cohort,
       CASE WHEN s_acctbal >= 5000 THEN 'Power' ELSE 'Micro' END AS seller_segment,
       'Category_' || (n_regionkey % 2) AS primary_category
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

STAGES["bounds"] = "SELECT min(order_date) AS first_date, max(order_date) AS last_date FROM lines"

STAGES["activity"] = """
SELECT a.seller_id, a.metric_date,
       coalesce(o.n, 0) AS orders, coalesce(o.gmv, 0) AS gmv, coalesce(o.cancelled, 0) AS cancelled, o.price,
       coalesce(s.n, 0) AS shipments, coalesce(s.late, 0) AS late,
       coalesce(r.n, 0) AS returns, coalesce(r.defects, 0) AS defects, coalesce(r.refund, 0) AS refund,
       coalesce(v.n, 0) AS reviews, v.stars, coalesce(v.negative, 0) AS negative
FROM (SELECT seller_id, CAST(unnest(generate_series(greatest(signup_date, first_date), last_date, INTERVAL 1 DAY)) AS DATE) AS metric_date
      FROM sellers, bounds) a
LEFT JOIN (SELECT seller_id, order_date AS d, count(*) AS n, sum(gmv)::BIGINT AS gmv, count(*) FILTER (is_cancelled) AS cancelled,
                  sum(unit_price)::BIGINT AS price FROM lines GROUP BY ALL) o ON o.seller_id = a.seller_id AND o.d = a.metric_date
LEFT JOIN (SELECT seller_id, order_date + 1 AS d, count(*) AS n, count(*) FILTER (is_late) AS late
           FROM lines WHERE NOT is_cancelled GROUP BY ALL) s ON s.seller_id = a.seller_id AND s.d = a.metric_date
LEFT JOIN (SELECT f.seller_id, f.order_date AS d, count(*) AS n, count(*) FILTER (t.is_defect) AS defects, sum(t.gmv)::BIGINT AS refund
           FROM lines t JOIN lines f USING (order_line_id) WHERE t.is_returned GROUP BY ALL) r
       ON r.seller_id = a.seller_id AND r.d = a.metric_date
LEFT JOIN (SELECT seller_id, order_date + 1 + line_number AS d, count(*) AS n, sum(rating)::BIGINT AS stars,
                  count(*) FILTER (rating <= 2) AS negative FROM lines WHERE is_reviewed GROUP BY ALL) v
       ON v.seller_id = a.seller_id AND v.d = a.metric_date"""


def rate(numerator: str, denominator: str) -> str:
    return f"CASE WHEN {denominator} > 0 THEN {half(numerator, denominator, 10000)} ELSE 0 END"


STAGES["spine_units"] = f"""
SELECT seller_id, metric_date, orders AS order_volume, gmv,
       CASE WHEN orders > 0 THEN {half("gmv", "orders", 1)} ELSE 0 END AS avg_order_value,
       {rate("defects", "orders")} AS defect_rate, {rate("late", "shipments")} AS late_shipment_rate,
       {rate("cancelled", "orders")} AS cancellation_rate, {rate("returns", "orders")} AS return_rate,
       {rate("refund", "gmv")} AS refund_rate,
       CASE WHEN reviews > 0 THEN {half("stars", "reviews", 1000)} END AS avg_rating, reviews AS review_count,
       {half("(sum(reviews) OVER w7)::BIGINT", "count(*) OVER w7", 1000)} AS review_velocity,
       {rate("negative", "reviews")} AS negative_review_rate,
       CASE WHEN orders > 0 THEN {half("price", "orders", 1)} END AS avg_price,
       coalesce({hu("stddev_samp(price / 100.0 / orders) OVER w7", 4)}, 0) AS price_volatility,
       CASE WHEN lag(orders) OVER w > 0 THEN
         sign(orders - lag(orders) OVER w) * {half("abs(orders - lag(orders) OVER w)", "lag(orders) OVER w", 10000)} / 10000.0::DOUBLE END
         AS order_growth_rate_dod
FROM activity
WINDOW w AS (PARTITION BY seller_id ORDER BY metric_date),
       w7 AS (PARTITION BY seller_id ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


def spine_view(source: str) -> str:
    """A spine in units shown with its real values."""
    d = lambda c, s: f"CAST({c} AS DOUBLE) / {s} AS {c}"
    return f"""
SELECT seller_id, metric_date, order_volume, {d("gmv", 100)}, {d("avg_order_value", 100)}, {d("defect_rate", 10000)},
       {d("late_shipment_rate", 10000)}, {d("cancellation_rate", 10000)}, {d("return_rate", 10000)}, {d("refund_rate", 10000)},
       {d("avg_rating", 1000)}, review_count, {d("review_velocity", 1000)}, {d("negative_review_rate", 10000)},
       {d("avg_price", 100)}, price_volatility, order_growth_rate_dod
FROM {source}"""


STAGES["episodes"] = f"""
SELECT seller_id // 3 + 1 AS ground_truth_id, seller_id, (ARRAY[{", ".join(f"'{t}'" for t in TYPES)}])[(seller_id // 3) % 8 + 1] AS anomaly_type,
       last_date - 500 + CAST(seller_id * 37 % 400 AS INTEGER) AS start_date,
       last_date - 500 + CAST(seller_id * 37 % 400 + 60 + seller_id % 40 AS INTEGER) AS end_date
FROM sellers, bounds WHERE seller_id % 3 = 0"""

STAGES["long_units"] = " UNION ALL ".join(
    f"SELECT seller_id, metric_date, {i} AS metric, CAST({m[0]} AS BIGINT) AS u FROM spine_units WHERE {m[0]} IS NOT NULL"
    for i, m in enumerate(METRICS)
)

ROLLING_SQL = """
SELECT seller_id, metric_date, metric, u, n, s / CAST(n AS DOUBLE) AS mean,
       CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (n * (n - 1))) END AS std, q1, q3
FROM (SELECT *, count(u) OVER w AS n, sum(u) OVER w AS s, sum(u * u) OVER w AS q,
             quantile_cont(CAST(u AS DOUBLE), 0.25) OVER w AS q1, quantile_cont(CAST(u AS DOUBLE), 0.75) OVER w AS q3
      FROM {source}
      WINDOW w AS (PARTITION BY seller_id, metric ORDER BY metric_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))"""
Z_SQL = """
SELECT *, CASE WHEN n >= 10 AND std > 0 THEN (u - mean) / std END AS z FROM {source}"""
STAGES["rolling"] = ROLLING_SQL.format(source="long_units")
STAGES["self_z"] = Z_SQL.format(source="rolling")

STAGES["peers"] = """
SELECT tenure_cohort, primary_category, seller_segment, metric_date, metric, n, s / CAST(n AS DOUBLE) AS mean,
       CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (n * (n - 1))) END AS std
FROM (SELECT tenure_cohort, primary_category, seller_segment, metric_date, metric, count(*) AS n, sum(u) AS s, sum(u * u) AS q
      FROM long_units JOIN sellers USING (seller_id) GROUP BY ALL)"""

STAGES["peer_z"] = """
SELECT l.*, tenure_cohort, primary_category, seller_segment, p.n, p.mean, p.std,
       CASE WHEN p.n >= 5 AND p.std > 0 THEN (u - p.mean) / p.std END AS z
FROM long_units l JOIN sellers USING (seller_id)
JOIN peers p USING (tenure_cohort, primary_category, seller_segment, metric_date, metric)"""

DIRECTION = metric_case(2)
TYPE = metric_case(1)


def flag_select(method: str, base: str, dev: str, score: str, suffix: str, text: str, source: str) -> str:
    return f"""
SELECT seller_id, flag_date, anomaly_type, affected_metric, baseline_value, observed_value, deviation_abs,
       CASE WHEN abs(baseline_value) > 1e-9 THEN deviation_abs / abs(baseline_value) * 100 END AS deviation_pct,
       '{method}' AS method, anomaly_score, {severity("anomaly_score")} AS severity, affected_metric || '{suffix}' AS reason_code, explanation
FROM (SELECT seller_id, metric_date AS flag_date, {TYPE} AS anomaly_type, {METRIC_NAME} AS affected_metric,
             ({base}) / unit AS baseline_value, u / unit AS observed_value, ({dev}) / unit AS deviation_abs,
             {score} AS anomaly_score, {text} AS explanation
      FROM {source})"""


STAGES["zscore_flags"] = flag_select(
    "ZScore",
    "mean",
    "u - mean",
    hu("(abs(z) + abs(pz)) / 2", 4),
    "_self_and_cohort_zscore",
    f"{METRIC_NAME} || ' read ' || {fmt('u / unit', 4)} || '; the seller''s last 28 readings average ' || {fmt('mean / unit', 4)} || ' (' || "
    f"{fmt('z', 2)} || ' deviations away), its peers of the day ' || {fmt('pmean / unit', 4)} || ' (' || {fmt('pz', 2)} || ').'",
    f"""(SELECT s.*, p.z AS pz, p.mean AS pmean, {UNIT.replace("metric", "s.metric")} AS unit
         FROM self_z s JOIN peer_z p USING (seller_id, metric_date, metric)
         WHERE round(abs(s.z), 9) >= 3 AND round(abs(p.z), 9) >= 3
           AND ({DIRECTION.replace("metric", "s.metric")} = 'both' OR s.u > s.mean))""",
)

IQR_SQL = flag_select(
    "IQR",
    "(q1 + q3) / 2",
    "distance",
    hu("least(distance / iqr, 50.0)", 4),
    "_iqr_outlier",
    f"{METRIC_NAME} || ' read ' || {fmt('u / unit', 4)} || ', beyond the range ' || {fmt('low / unit', 4)} || ' to ' || "
    f"{fmt('high / unit', 4)} || ' that the quartiles of the last 28 readings allow.'",
    f"""(SELECT *, CASE WHEN u > high THEN u - high ELSE low - u END AS distance, {UNIT} AS unit
         FROM (SELECT *, q3 - q1 AS iqr, q1 - 2 * (q3 - q1) AS low, q3 + 2 * (q3 - q1) AS high FROM {{rolling}} WHERE n >= 10)
         WHERE iqr > 0 AND metric <> 6 AND (u > high OR ({DIRECTION} = 'both' AND u < low)))""",
)
STAGES["iqr_flags"] = IQR_SQL.replace("{rolling}", "rolling")

ANCHOR_SQL = """
SELECT *, CASE WHEN sd > 0 THEN sd END AS sigma FROM (
  SELECT *, avg(CASE WHEN rn <= anchor_n THEN CAST(u AS DOUBLE) END) OVER p AS mu,
         sqrt(CAST(anchor_n * sum(CASE WHEN rn <= anchor_n THEN u * u END) OVER p
                   - pow(sum(CASE WHEN rn <= anchor_n THEN u END) OVER p, 2) AS DOUBLE)) / anchor_n AS sd
  FROM (SELECT *, least(28, greatest(n_obs // 3, 5)) AS anchor_n
        FROM (SELECT *, row_number() OVER (PARTITION BY seller_id, metric ORDER BY metric_date) AS rn,
                     count(*) OVER (PARTITION BY seller_id, metric) AS n_obs FROM {source})
        WHERE n_obs >= 15)
  WINDOW p AS (PARTITION BY seller_id, metric))"""
DRIFT_SQL = """
SELECT seller_id, metric, rn, metric_date, u, mu, sigma, 0.0::DOUBLE AS up, 0.0::DOUBLE AS down FROM {anchored} WHERE rn = 1 AND sigma IS NOT NULL
UNION ALL
SELECT a.seller_id, a.metric, a.rn, a.metric_date, a.u, a.mu, a.sigma,
       greatest(0.0, d.up + (a.u - a.mu) - 0.5 * a.sigma), greatest(0.0, d.down - (a.u - a.mu) - 0.5 * a.sigma)
FROM {drift} d JOIN {anchored} a ON a.seller_id = d.seller_id AND a.metric = d.metric AND a.rn = d.rn + 1"""
STAGES["anchored"] = ANCHOR_SQL.format(source="long_units")
STAGES["drift"] = DRIFT_SQL.format(anchored="anchored", drift="drift")

CUSUM_SQL = flag_select(
    "CUSUM",
    "mu",
    "u - mu",
    hu("c", 4),
    "_cusum_drift",
    f"{METRIC_NAME} || ' keeps moving away from its early mean of ' || {fmt('mu / unit', 4)} || ': the summed drift is ' || "
    f"{fmt('c * sigma / unit', 2)} || ', the limit ' || {fmt('8 * sigma / unit', 2)} || '.'",
    f"""(SELECT *, {UNIT} AS unit FROM (
           SELECT *, lag(metric_date) OVER (PARTITION BY seller_id, metric ORDER BY metric_date) AS before
           FROM (SELECT *, round(CASE WHEN {DIRECTION} = 'up' THEN up ELSE greatest(up, down) END / sigma, 9) AS c FROM {{drift}})
           WHERE c > 8)
         WHERE before IS NULL OR metric_date - before > 3)""",
)
STAGES["cusum_flags"] = CUSUM_SQL.replace("{drift}", "drift")

STAGES["method_flags"] = " UNION ALL ".join(f"SELECT {FLAG_COLUMNS} FROM {t}" for t in ("zscore_flags", "iqr_flags", "cusum_flags"))

STAGES["votes"] = """
SELECT v.*, t.n_distinct_types
FROM (SELECT seller_id, flag_date, anomaly_type, count(DISTINCT method) AS n_methods, list_sort(list(DISTINCT method)) AS methods,
             CAST(sum(CAST(round(anomaly_score * 10000) AS BIGINT)) AS DOUBLE) / 10000 / count(*) AS avg_score, max(anomaly_score) AS max_score
      FROM method_flags GROUP BY ALL) v
JOIN (SELECT seller_id, flag_date, count(DISTINCT anomaly_type) AS n_distinct_types FROM method_flags GROUP BY ALL) t
USING (seller_id, flag_date)"""

STAGES["ensemble"] = f"""
SELECT e.seller_id, e.flag_date, e.new_type AS anomaly_type, d.affected_metric, d.baseline_value, d.observed_value, d.deviation_abs,
       d.deviation_pct, 'Ensemble' AS method, score AS anomaly_score, {severity("score")} AS severity,
       'agreement_of_' || array_to_string(methods, '_') AS reason_code,
       'Raised as ' || lower(replace(e.new_type, '_', ' ')) || ' by ' || array_to_string(methods, ', ')
         || CASE WHEN n_distinct_types >= 3 THEN ', with ' || n_distinct_types || ' kinds of anomaly that day' ELSE '' END
         || '; mean score ' || {fmt("score", 2)} || '.' AS explanation
FROM (SELECT *, {hu("avg_score", 4)} AS score,
             row_number() OVER (PARTITION BY seller_id, flag_date, new_type ORDER BY max_score DESC, anomaly_type) AS rn
      FROM (SELECT *, CASE WHEN n_distinct_types >= 3 THEN '{MULTI}' ELSE anomaly_type END AS new_type
            FROM votes v WHERE n_methods >= 2 AND EXISTS (
              SELECT 1 FROM method_flags f WHERE f.seller_id = v.seller_id AND f.anomaly_type = v.anomaly_type
                AND f.flag_date <> v.flag_date AND abs(f.flag_date - v.flag_date) <= 3))) e
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seller_id, flag_date ORDER BY anomaly_score DESC, coalesce({ORDINAL}, -1),
             {case("method", [(m, i) for i, m in enumerate(METHODS)])}) AS pick FROM method_flags) WHERE pick = 1) d
  ON d.seller_id = e.seller_id AND d.flag_date = e.flag_date
WHERE e.rn = 1"""

STAGES["flags"] = f"""
SELECT row_number() OVER (ORDER BY flag_date, seller_id, anomaly_type, method) AS flag_id, {FLAG_COLUMNS}
FROM (SELECT *, row_number() OVER (PARTITION BY seller_id, flag_date, anomaly_type, method ORDER BY {ORDINAL}) AS pick
      FROM (SELECT {FLAG_COLUMNS} FROM method_flags UNION ALL SELECT {FLAG_COLUMNS} FROM ensemble))
WHERE pick = 1"""

STAGES["penalized"] = f"""
SELECT s.seller_id, s.metric_date, s.defect_rate / 10000.0::DOUBLE AS defect_rate, s.late_shipment_rate / 10000.0::DOUBLE AS late_shipment_rate,
       s.return_rate / 10000.0::DOUBLE AS return_rate, s.cancellation_rate / 10000.0::DOUBLE AS cancellation_rate,
       s.negative_review_rate / 10000.0::DOUBLE AS negative_review_rate, s.avg_rating / 1000.0::DOUBLE AS avg_rating,
       CAST(coalesce(sum({case("f.severity", [("Low", 1), ("Medium", 2), ("High", 4), ("Critical", 8)])}), 0) AS DOUBLE) AS penalty
FROM spine_units s LEFT JOIN (SELECT * FROM flags WHERE method = 'Ensemble') f
  ON f.seller_id = s.seller_id AND f.flag_date <= s.metric_date AND f.flag_date > s.metric_date - 30
GROUP BY ALL"""

_BAD = ["defect_rate", "late_shipment_rate", "return_rate", "cancellation_rate", "negative_review_rate", "penalty"]
STAGES["limits"] = "SELECT " + ", ".join(
    f"CASE WHEN quantile_cont({c}, 0.95) > 0 THEN quantile_cont({c}, 0.95) ELSE max({c}) END AS {c}_top" for c in _BAD
) + " FROM penalized"


def bad_is_high(column: str) -> str:
    return f"CASE WHEN {column}_top > 0 THEN 100 * (1 - least(greatest({column}, 0.0), {column}_top) / {column}_top) ELSE 100.0 END"


_COMPONENTS = {
    "defect": (bad_is_high("defect_rate"), "0.30"),
    "late_shipment": (bad_is_high("late_shipment_rate"), "0.20"),
    "return": (bad_is_high("return_rate"), "0.15"),
    "cancellation": (bad_is_high("cancellation_rate"), "0.10"),
    "review": (
        f"(100 * (least(greatest(coalesce(avg_rating, 4.3::DOUBLE), 1.0), 5.0) - 1) / 4 + {bad_is_high('negative_review_rate')}) / 2",
        "0.15",
    ),
    "anomaly_penalty": (bad_is_high("penalty"), "0.10"),
}
STAGES["health"] = f"""
SELECT seller_id, score_date, health_score, {tier("health_score")} AS health_tier,
       {", ".join(f"{hu(f'{k}_raw', 2)} AS {k}_component" for k in _COMPONENTS)}
FROM (SELECT *, {hu(" + ".join(f"{w}::DOUBLE * {k}_raw" for k, (_, w) in _COMPONENTS.items()), 2)} AS health_score
      FROM (SELECT seller_id, metric_date AS score_date, {", ".join(f"{e} AS {k}_raw" for k, (e, _) in _COMPONENTS.items())}
            FROM penalized, limits))"""

STAGES["priority"] = f"""
SELECT flag_id, seller_id, flag_date, anomaly_type, affected_metric, severity,
       {hu("0.35::DOUBLE * severity_component + 0.25::DOUBLE * financial_component + 0.20::DOUBLE * customer_impact_component + 0.20::DOUBLE * confidence_component", 2)} AS priority_score,
       severity_component, financial_component, customer_impact_component, confidence_component,
       CAST({case("severity", [("Critical", 24), ("High", 72), ("Medium", 120), ("Low", 240)])} AS BIGINT) AS sla_hours,
       gmv_30d / 100.0::DOUBLE AS gmv_30d, CAST(orders_30d AS BIGINT) AS orders_30d, explanation
FROM (SELECT *, CAST({case("severity", [("Low", 25), ("Medium", 50), ("High", 75), ("Critical", 100)])} AS DOUBLE) AS severity_component,
             {hu("(rank() OVER (ORDER BY gmv_30d) + (count(*) OVER (PARTITION BY gmv_30d) - 1) / 2.0::DOUBLE) / CAST(count(*) OVER () AS DOUBLE) * 100", 2)} AS financial_component,
             {hu("(rank() OVER (ORDER BY orders_30d) + (count(*) OVER (PARTITION BY orders_30d) - 1) / 2.0::DOUBLE) / CAST(count(*) OVER () AS DOUBLE) * 100", 2)} AS customer_impact_component,
             least(len(list_filter(string_split(reason_code, '_'), lambda x: x IN ('ZScore', 'IQR', 'CUSUM', 'IsolationForest'))), 4) * 25.0::DOUBLE AS confidence_component
      FROM (SELECT f.*, t.gmv_30d, t.orders_30d FROM flags f
            JOIN (SELECT seller_id, metric_date, sum(gmv) OVER w AS gmv_30d, sum(order_volume) OVER w AS orders_30d FROM spine_units
                  WINDOW w AS (PARTITION BY seller_id ORDER BY metric_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) t
              ON t.seller_id = f.seller_id AND t.metric_date = f.flag_date
            WHERE f.method = 'Ensemble'))"""

STAGES["new_tickets"] = """
SELECT row_number() OVER (ORDER BY detected_date, seller_id) AS case_id, seller_id, ids[1] AS primary_flag_id,
       array_to_string(ids[2:], ',') AS related_flag_ids, severity, priority_score, detected_date, sla_hours,
       CAST(detected_date AS TIMESTAMP) + to_hours(CAST(sla_hours AS INTEGER)) AS sla_deadline, 'New' AS status,
       CAST(NULL AS VARCHAR) AS assigned_investigator, CAST(NULL AS VARCHAR) AS root_cause_category, CAST(NULL AS VARCHAR) AS notes,
       CAST(NULL AS VARCHAR) AS resolution, CAST(NULL AS TIMESTAMP) AS resolved_at, FALSE AS is_sla_breached,
       CAST(detected_date AS TIMESTAMP) AS created_at, CAST(detected_date AS TIMESTAMP) AS updated_at
FROM (SELECT seller_id, flag_date AS detected_date, list(flag_id ORDER BY priority_score DESC, flag_id) AS ids,
             first(severity ORDER BY priority_score DESC, flag_id) AS severity, max(priority_score) AS priority_score,
             first(sla_hours ORDER BY priority_score DESC, flag_id) AS sla_hours
      FROM priority WHERE severity IN ('High', 'Critical') GROUP BY ALL)"""

_CAUSES = ["Logistics", "Inventory", "Pricing", "Product_Quality", "Seller_Behavior", "Review_Anomaly", "Data_Quality"]
STAGES["status_updates"] = f"""
SELECT case_id, 'Investigating' AS status, CAST(NULL AS VARCHAR) AS root_cause, 'Under review' AS notes, CAST(NULL AS VARCHAR) AS resolution,
       'Investigator ' || (case_id % 8) AS investigator, CAST(detected_date AS TIMESTAMP) AS moment
FROM new_tickets WHERE case_id % 3 = 0
UNION ALL
SELECT case_id, outcome, CASE WHEN case_id % 10 <= 7 THEN (ARRAY[{", ".join(f"'{x}'" for x in _CAUSES)}])[case_id % 7 + 1] END, NULL,
       CASE WHEN case_id % 10 <= 7 THEN 'Closed as ' || outcome END, 'Investigator ' || (case_id % 8),
       CAST(detected_date AS TIMESTAMP) + to_minutes(CAST(sla_hours * 6 * (case_id % 15) AS INTEGER))
FROM (SELECT *, CASE WHEN case_id % 10 <= 2 THEN 'False_Positive' WHEN case_id % 10 = 3 THEN 'Escalated'
                     WHEN case_id % 10 <= 7 THEN 'Resolved' ELSE 'Action_Required' END AS outcome
      FROM new_tickets WHERE case_id % 10 <= 8)"""

STAGES["merged_tickets"] = """
SELECT t.* REPLACE (
  coalesce(u.status, t.status) AS status, coalesce(u.investigator, t.assigned_investigator) AS assigned_investigator,
  u.root_cause AS root_cause_category, u.notes AS notes, u.resolution AS resolution,
  CASE WHEN u.status IN ('Resolved', 'False_Positive', 'Escalated') THEN u.moment END AS resolved_at, coalesce(u.moment, t.updated_at) AS updated_at)
FROM new_tickets t LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY moment DESC, status DESC) AS rn
  FROM status_updates) WHERE rn = 1) u ON u.case_id = t.case_id"""

STAGES["tickets"] = """
SELECT t.* REPLACE (coalesce(
    (status NOT IN ('Resolved', 'False_Positive', 'Escalated') AND sla_deadline < as_of)
    OR (status IN ('Resolved', 'False_Positive', 'Escalated') AND resolved_at > sla_deadline)
    OR (status = 'Escalated' AND sla_deadline < as_of), FALSE) AS is_sla_breached)
FROM merged_tickets t, (SELECT CAST(last_date AS TIMESTAMP) AS as_of FROM bounds)"""

MATCH = f"(f.anomaly_type = e.anomaly_type OR f.anomaly_type = '{MULTI}' OR e.anomaly_type = '{MULTI}')"
STAGES["hits"] = f"""
SELECT e.ground_truth_id, e.anomaly_type, f.method, min(f.flag_date) - e.start_date AS delay
FROM episodes e JOIN flags f ON f.seller_id = e.seller_id AND f.flag_date BETWEEN e.start_date AND e.end_date AND {MATCH}
GROUP BY e.ground_truth_id, e.anomaly_type, e.start_date, f.method"""
STAGES["judged"] = f"""
SELECT f.*, EXISTS (SELECT 1 FROM episodes e WHERE e.seller_id = f.seller_id AND f.flag_date BETWEEN e.start_date AND e.end_date AND {MATCH}) AS is_true
FROM flags f"""
STAGES["latest"] = "SELECT * FROM health WHERE score_date = (SELECT max(score_date) FROM health)"

MATERIALIZED = {
    "lines", "spine_units", "long_units", "rolling", "peers", "anchored", "method_flags", "flags", "penalized", "health",
    "priority", "new_tickets", "tickets", "votes", "forest_rows", "forest_sizes", "forest_sample", "forest_nodes", "forest_scores", "forest_flags",
}


def _uses(sql: str, stages: dict[str, str]) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [name for name in stages if name in words]


def compose(final: str, extra: dict[str, str] | None = None) -> str:
    """The final select with the stages it needs, in order, as one statement."""
    stages = {**STAGES, **(extra or {})}
    needed: list[str] = []

    def visit(sql: str, me: str | None = None) -> None:
        for name in _uses(sql, stages):
            if name != me and name not in needed:
                visit(stages[name], name)
                needed.append(name)

    visit(final)
    parts = [f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({stages[n]})" for n in needed]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final if parts else final
