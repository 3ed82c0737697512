"""The isolation forest restated as DuckDB SQL: draws from MD5 digests, trees by recursion over the drawn rows.

A drawn row goes down its tree level by level, and windows over the rows of one node give its ranges and split. All rows
are then walked through the nodes by eight joins.
"""

from __future__ import annotations

from .stages import FLAG_COLUMNS, MULTI, STAGES, fmt, hu, severity

# Features in order with the units of the spine, and the forest's parameters.
FEATURES = [
    ("order_volume", 1), ("gmv", 100), ("defect_rate", 10000), ("late_shipment_rate", 10000), ("cancellation_rate", 10000),
    ("return_rate", 10000), ("refund_rate", 10000), ("avg_rating", 1000), ("review_velocity", 1000),
    ("negative_review_rate", 10000), ("price_volatility", None), ("order_growth_rate_dod", None),
]
TREES, SAMPLE, DEPTH, SEED, PRIME = 200, 256, 8, 42, 2**31 - 1
WIDTH = len(FEATURES)


def hex_number(digest: str, start: int, size: int) -> str:
    return f"CAST('0x' || substr({digest}, {start}, {size}) AS BIGINT)"


def average_path(n: str) -> str:
    return (
        f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1) / CAST({n} AS DOUBLE) "
        f"WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    )


def _feature(name: str, unit: int | None) -> str:
    value = f"CAST({name} AS DOUBLE) / {unit}" if unit else f"CAST({name} AS DOUBLE)"
    return f"coalesce({value}, 0.0::DOUBLE)"


FOREST: dict[str, str] = {}

FOREST["forest_rows"] = f"""
SELECT seller_id, metric_date, cohort, f, {hex_number("h", 1, 7)} AS x, {hex_number("h", 8, 7)} AS y
FROM (SELECT seller_id, metric_date, tenure_cohort || '|' || seller_segment AS cohort, md5(seller_id || '|' || metric_date) AS h,
             [{", ".join(_feature(*f) for f in FEATURES)}] AS f
      FROM spine_units JOIN sellers USING (seller_id))"""

FOREST["forest_sizes"] = "SELECT cohort, count(*) AS n FROM forest_rows GROUP BY cohort HAVING count(*) >= 200"

FOREST["forest_trees"] = f"""
SELECT t, {hex_number("h", 1, 7)} AS a, {hex_number("h", 8, 7)} AS b, {hex_number("h", 15, 13)} % {PRIME} AS c
FROM (SELECT t, md5('{SEED}|' || t) AS h FROM (SELECT unnest(range({TREES})) AS t))"""

FOREST["forest_sample"] = f"""
SELECT cohort, t, f FROM (
  SELECT *, row_number() OVER (PARTITION BY cohort, t ORDER BY draw, seller_id, metric_date) AS rn
  FROM (SELECT r.*, t, (x * a + y * b + c) % {PRIME} AS draw, least({PRIME}, {SAMPLE * 3 // 2 * PRIME} // n) AS most
        FROM forest_rows r JOIN forest_sizes USING (cohort), forest_trees)
  WHERE draw < most)
WHERE rn <= {SAMPLE}"""

_LOW = ", ".join(f"min(f[{i + 1}]) OVER w" for i in range(WIDTH))
_HIGH = ", ".join(f"max(f[{i + 1}]) OVER w" for i in range(WIDTH))


def _split(source: str) -> str:
    """The rows of a level with their node's count, and its split if it has one."""
    return f"""
(SELECT *, CASE WHEN k IS NOT NULL THEN low[k] + u * (high[k] - low[k]) END AS threshold
 FROM (SELECT *, {hex_number("h", 15, 13)} / 4503599627370496.0::DOUBLE AS u,
              CASE WHEN depth < {DEPTH} AND len(varied) > 0 THEN varied[1 + {hex_number("h", 1, 7)} % len(varied)] END AS k
       FROM (SELECT *, list_filter(range(1, {WIDTH + 1}), lambda i: high[i] > low[i]) AS varied,
                    md5('{SEED}|' || cohort || '|' || t || '|' || node) AS h
             FROM (SELECT *, [{_LOW}] AS low, [{_HIGH}] AS high, count(*) OVER w AS n
                   FROM {source} WINDOW w AS (PARTITION BY cohort, t, node)))))"""


FOREST["forest_grown"] = f"""
SELECT cohort, t, 0 AS node, 0 AS depth, f FROM forest_sample
UNION ALL
SELECT cohort, t, 2 * node + CASE WHEN f[k] > threshold THEN 2 ELSE 1 END, depth + 1, f
FROM {_split("forest_grown")} WHERE k IS NOT NULL"""

FOREST["forest_nodes"] = f"""
SELECT cohort, t, node, any_value(k) AS k, any_value(threshold) AS threshold,
       CAST(floor((any_value(depth) + any_value({average_path("n")})) / 1e-6::DOUBLE + 0.5) AS BIGINT) AS path
FROM {_split("forest_grown")} GROUP BY cohort, t, node"""


def _walk() -> str:
    """Each row of each tree at its leaf, by one join a level."""
    at = "SELECT r.seller_id, r.metric_date, r.cohort, r.f, t, 0 AS node FROM forest_rows r JOIN forest_sizes USING (cohort), forest_trees"
    for _ in range(DEPTH):
        at = f"""SELECT a.seller_id, a.metric_date, a.cohort, a.f, a.t,
          CASE WHEN s.k IS NULL THEN a.node WHEN a.f[s.k] > s.threshold THEN 2 * a.node + 2 ELSE 2 * a.node + 1 END AS node
        FROM ({at}) a JOIN forest_nodes s ON s.cohort = a.cohort AND s.t = a.t AND s.node = a.node"""
    return at


FOREST["forest_scores"] = f"""
SELECT seller_id, metric_date, cohort,
       floor(pow(2.0::DOUBLE, -(total / ({TREES} / 1e-6::DOUBLE)) / ({average_path(f"least(n, {SAMPLE})")})) * 1e6::DOUBLE + 0.5) / 1e6::DOUBLE AS raw_score
FROM (SELECT a.seller_id, a.metric_date, a.cohort, CAST(sum(s.path) AS BIGINT) AS total
      FROM ({_walk()}) a JOIN forest_nodes s ON s.cohort = a.cohort AND s.t = a.t AND s.node = a.node GROUP BY ALL)
JOIN forest_sizes USING (cohort)"""

FOREST["forest_outliers"] = """
SELECT s.seller_id, s.metric_date, raw_score, min(raw_score) OVER () AS low, max(raw_score) OVER () AS high
FROM forest_scores s JOIN (
  SELECT cohort, raw_score AS cut FROM (
    SELECT cohort, raw_score, row_number() OVER (PARTITION BY cohort ORDER BY raw_score) - 1 AS place, count(*) OVER (PARTITION BY cohort) AS n
    FROM forest_scores) WHERE place = (n - 1) * 970000 // 1000000) c ON c.cohort = s.cohort
WHERE raw_score > cut"""

_NAMES = "[" + ", ".join(f"'{name}'" for name, _ in FEATURES) + "]"
_SPREADS = ", ".join(
    f"CASE WHEN s.sd[{i + 1}] > 0 THEN coalesce(round(abs(r.f[{i + 1}] - s.mid[{i + 1}]) / s.sd[{i + 1}], 9), 0) ELSE 0 END" for i in range(WIDTH)
)
FOREST["forest_top"] = f"""
SELECT *, list_max(z) AS top, list_position(z, list_max(z)) AS k
FROM (SELECT o.*, [{_SPREADS}] AS z
      FROM forest_outliers o JOIN forest_rows r ON r.seller_id = o.seller_id AND r.metric_date = o.metric_date
      JOIN (SELECT seller_id, [{", ".join(f"median(f[{i + 1}])" for i in range(WIDTH))}] AS mid,
                   [{", ".join(f"stddev_samp(f[{i + 1}])" for i in range(WIDTH))}] AS sd
            FROM forest_rows GROUP BY seller_id) s ON s.seller_id = o.seller_id)"""

FOREST["forest_flags"] = f"""
SELECT seller_id, metric_date AS flag_date, '{MULTI}' AS anomaly_type, {_NAMES}[k] AS affected_metric, CAST(NULL AS DOUBLE) AS baseline_value,
       CAST(NULL AS DOUBLE) AS observed_value, CAST(NULL AS DOUBLE) AS deviation_abs, CAST(NULL AS DOUBLE) AS deviation_pct,
       'IsolationForest' AS method, anomaly_score, {severity("anomaly_score")} AS severity,
       'isolation_forest_multivariate_outlier' AS reason_code,
       'The day''s readings stand apart from the cohort (isolation ' || {fmt("anomaly_score", 2)} || ' of 10); ' || {_NAMES}[k]
         || ' is farthest from the seller''s median (z=' || {fmt("top", 2)} || ').' AS explanation
FROM (SELECT *, {hu("(raw_score - low) / (high - low + 1e-9::DOUBLE) * 10", 4)} AS anomaly_score FROM forest_top)"""

#: The stages of all four detectors: the forest's flags join the others'.
FOREST["method_flags"] = f"{STAGES['method_flags']} UNION ALL SELECT {FLAG_COLUMNS} FROM forest_flags"
