"""Data-quality checks: violation counts per rule, and the gate that stops a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..registry import ANOMALY_TYPES, ENSEMBLE, HEALTH_TIERS, METHODS, SEVERITIES, TICKET_STATUSES


class DataQualityError(RuntimeError):
    """Raised by the gate when a check fails."""


def _one(name: str, frame: DataFrame, count: Column) -> DataFrame:
    return frame.agg(F.coalesce(count, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def _many(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All row-level rules of one table in one scan."""
    counted = frame.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], [f"`{name}`" for name in rules], "check", "violations")


def _copies(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Rows per value of a key, one column `n0`, `n1`, ... for each given table and its column of that key.

    The tables are stacked and counted once: partial counts before a single exchange, so a hot value is one row a task,
    and no exchange at all where all of them are stored in buckets of the key.
    """
    names = [f"n{i}" for i in range(len(columns))]
    parts = [
        frame.select(F.col(column).alias("key"), *[F.lit(int(i == j)).cast("long").alias(n) for j, n in enumerate(names)])
        for i, (frame, column) in enumerate(columns)
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("key").agg(*[F.sum(n).alias(n) for n in names])


def _repeated(count: str) -> Column:
    """Number of key values that a table has more than once."""
    return F.count_if(F.col(count) > 1)


def _lost(child: str, parent: str) -> Column:
    """Number of rows whose key has no parent. A null key has none, as in an outer join followed by a null test."""
    return F.sum(F.when((F.col(parent) == 0) | F.col("key").isNull(), F.col(child)))


def _counted(copies: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All rules on the counts of one key: (check, violations)."""
    found = copies.agg(*[F.coalesce(count, F.lit(0)).cast("long").alias(name) for name, count in rules.items()])
    return found.unpivot([], [f"`{name}`" for name in rules], "check", "violations")


def raw_checks(star: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """The twelve checks on the loaded tables: (check, violations)."""
    orders, shipments = star["fact_orders"], star["fact_shipments"]
    returns, reviews, sellers = star["fact_returns"], star["fact_reviews"], star["dim_seller"]
    c = F.col
    line = "order_line_id"
    days = orders.groupBy("seller_id", "order_date").agg(F.count("*").alias("n"))
    early = days.join(sellers.select("seller_id", "signup_date"), "seller_id").where(c("order_date") < c("signup_date"))
    parts = [
        _counted(
            _copies((orders, line), (shipments, line), (returns, line)),
            {
                "duplicate_orders": _repeated("n0"),
                "orphan_shipment_order_fk": _lost("n1", "n0"),
                "orphan_return_order_fk": _lost("n2", "n0"),
                "return_without_delivered_shipment": _lost("n2", "n1"),
            },
        ),
        _one("orphan_order_seller_fk", days.join(sellers, "seller_id", "left_anti"), F.sum("n")),
        _many(
            orders,
            {
                "negative_gmv": c("gmv") < 0,
                "future_dated_orders": c("order_date") > as_of,
                "null_seller_id_orders": c("seller_id").isNull(),
            },
        ),
        _many(returns, {"negative_refund_amount": c("refund_amount") < 0}),
        _many(reviews, {"invalid_rating": ~c("rating").between(1, 5)}),
        _many(shipments, {"delivery_before_ship": c("actual_delivery_date") < c("actual_ship_date")}),
        _one("order_date_before_seller_signup", early, F.sum("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


def spine_check(spine: DataFrame) -> DataFrame:
    """Rates of the spine outside 0..1; run after the transform that fills the spine."""
    rates = ("defect_rate", "late_shipment_rate", "return_rate", "cancellation_rate")
    outside = reduce(lambda a, b: a | b, [~F.col(r).between(0, 1) for r in rates])
    return _many(spine, {"seller_daily_metrics_rate_out_of_bounds": outside})


def report(*checks: DataFrame) -> DataFrame:
    """(check, violations, status)."""
    return reduce(DataFrame.unionByName, checks).withColumn(
        "status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    )


def gate(dq_report: DataFrame) -> None:
    """Raise when any check failed. The report has one row per check."""
    failed = dq_report.where("status = 'FAIL'").orderBy("check").collect()
    if failed:
        raise DataQualityError("; ".join(f"{r['check']}: {r['violations']}" for r in failed))


# Allowed labels of the enumerated columns.
ROOT_CAUSES = (
    "Logistics",
    "Inventory",
    "Pricing",
    "Product_Quality",
    "Seller_Behavior",
    "Review_Anomaly",
    "Data_Quality",
)
ENUMS = {
    "dim_seller": {
        "tenure_cohort": ("New", "Growing", "Established", "Veteran"),
        "seller_segment": ("Micro", "Small", "Mid", "Power"),
        "business_type": ("Individual", "LLC", "Corporation"),
        "fulfillment_type": ("Marketplace-Fulfilled", "Self-Ship"),
    },
    "dim_product": {"price_tier": ("Budget", "Mid", "Premium")},
    "dim_customer": {"customer_segment": ("New", "Occasional", "Frequent", "VIP")},
    "fact_orders": {"order_status": ("Placed", "Shipped", "Delivered", "Cancelled", "Returned")},
    "fact_returns": {
        "return_reason_code": (
            "Defective",
            "Not_As_Described",
            "Wrong_Item",
            "Changed_Mind",
            "Late_Arrival",
            "Damaged_In_Transit",
            "Other",
        )
    },
    "fact_reviews": {"sentiment_flag": ("Positive", "Neutral", "Negative")},
    "fact_anomaly_flags": {
        "anomaly_type": ANOMALY_TYPES,
        "method": (*METHODS, ENSEMBLE),
        "severity": SEVERITIES,
    },
    "investigation_tickets": {
        "severity": SEVERITIES,
        "status": TICKET_STATUSES,
        "root_cause_category": ROOT_CAUSES,
    },
    "seller_health_score": {"health_tier": HEALTH_TIERS},
}
RANGES = {
    "dim_product": {"list_price": (0, None)},
    "fact_orders": {"quantity": (1, None), "unit_price": (0, None), "gmv": (0, None)},
    "fact_returns": {"refund_amount": (0, None)},
    "fact_reviews": {"rating": (1, 5)},
    "seller_health_score": {"health_score": (0, 100)},
}
UNIQUE = {
    "dim_seller": ("seller_id",),
    "dim_product": ("product_id",),
    "dim_customer": ("customer_id",),
    "fact_seller_daily_metrics": ("seller_id", "metric_date"),
    "fact_anomaly_flags": ("seller_id", "flag_date", "anomaly_type", "method"),
    "seller_health_score": ("seller_id", "score_date"),
}


def domain_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared column domains and unique keys: (check, violations, status).

    Null passes a domain rule. All rules of one table share one scan; a unique key adds a grouping.
    """
    parts = []
    for name, frame in tables.items():
        rules = {}
        for column, labels in ENUMS.get(name, {}).items():
            rules[f"{name}.{column}:enum"] = ~F.col(column).isin(*labels)
        for column, (low, high) in RANGES.get(name, {}).items():
            bad = F.col(column) < low if high is None else ~F.col(column).between(low, high)
            rules[f"{name}.{column}:range"] = bad
        if rules:
            parts.append(_many(frame, rules))
        if name in UNIQUE:
            groups = frame.groupBy(*UNIQUE[name]).agg(F.count("*").alias("n")).where("n > 1")
            parts.append(_one(f"{name}:unique", groups, F.count("*")))
    return report(*parts)


# Single-column keys, the columns that may be null, and the references of each table.
KEYS = {
    "dim_seller": "seller_id",
    "dim_product": "product_id",
    "dim_customer": "customer_id",
    "dim_date": "date_key",
    "fact_orders": "order_line_id",
    "fact_shipments": "shipment_id",
    "fact_returns": "return_id",
    "fact_reviews": "review_id",
    "fact_anomaly_flags": "flag_id",
    "investigation_tickets": "case_id",
    "ground_truth_anomalies": "ground_truth_id",
}
OPTIONAL = {
    "dim_seller": ("effective_end_date",),
    "fact_shipments": ("actual_ship_date", "actual_delivery_date"),
    "fact_seller_daily_metrics": ("avg_rating", "avg_price", "order_growth_rate_dod"),
    "fact_anomaly_flags": ("baseline_value", "observed_value", "deviation_abs", "deviation_pct"),
    "investigation_tickets": (
        "primary_flag_id",
        "related_flag_ids",
        "assigned_investigator",
        "root_cause_category",
        "notes",
        "resolution",
        "resolved_at",
    ),
    "ground_truth_anomalies": ("notes",),
}
REFERENCES = {
    "dim_product": {"seller_id": "dim_seller"},
    "fact_orders": {
        "seller_id": "dim_seller",
        "product_id": "dim_product",
        "customer_id": "dim_customer",
        "order_date": "dim_date",
    },
    "fact_shipments": {"order_line_id": "fact_orders", "seller_id": "dim_seller"},
    "fact_returns": {"order_line_id": "fact_orders", "seller_id": "dim_seller", "return_date": "dim_date"},
    "fact_reviews": {
        "product_id": "dim_product",
        "seller_id": "dim_seller",
        "customer_id": "dim_customer",
        "review_date": "dim_date",
    },
    "fact_seller_daily_metrics": {"seller_id": "dim_seller", "metric_date": "dim_date"},
    "fact_anomaly_flags": {"seller_id": "dim_seller", "flag_date": "dim_date"},
    "investigation_tickets": {"seller_id": "dim_seller", "primary_flag_id": "fact_anomaly_flags"},
    "ground_truth_anomalies": {"seller_id": "dim_seller"},
    "seller_health_score": {"seller_id": "dim_seller", "score_date": "dim_date"},
}


def key_parts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """By table: its required columns, its key and all references to it, as (check, violations)."""
    parts = {}
    for name, frame in tables.items():
        required = [F.col(x).isNull() for x in frame.columns if x not in OPTIONAL.get(name, ())]
        parts[name] = _many(frame, {f"{name}:required": reduce(lambda a, b: a | b, required)})
        if name in KEYS:
            uses = [(child, x) for child in tables for x, parent in REFERENCES.get(child, {}).items() if parent == name]
            columns = [(frame, KEYS[name]), *[(tables[child].where(F.col(x).isNotNull()), x) for child, x in uses]]
            rules = {f"{name}:key": _repeated("n0")}
            rules |= {f"{child}.{x}:reference": _lost(f"n{i}", "n0") for i, (child, x) in enumerate(uses, 1)}
            parts[name] = parts[name].unionByName(_counted(_copies(*columns), rules))
    return parts


def key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared keys, references and required columns: (check, violations, status).

    `table:key` counts repeated key values, `table:required` the rows with a null in a column that must be filled,
    `table.column:reference` the rows whose value has no parent (null refers to nothing). A parent and all that refer
    to it are counted per value together, in one exchange. A reference to a table that is not given is left out.
    """
    return report(*key_parts(tables).values())
