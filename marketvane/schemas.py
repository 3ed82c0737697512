"""Declared schemas of the input star and of the result tables."""

from __future__ import annotations

# Column lists as DDL, in the column order of the input files.
STAR_SCHEMAS = {
    "dim_seller": """seller_id BIGINT, seller_name STRING, signup_date DATE, tenure_cohort STRING,
        seller_segment STRING, primary_category STRING, business_type STRING, fulfillment_type STRING,
        country STRING, region STRING, is_active BOOLEAN, effective_start_date DATE,
        effective_end_date DATE, is_current BOOLEAN""",
    "dim_product": """product_id BIGINT, seller_id BIGINT, product_name STRING, category STRING,
        subcategory STRING, price_tier STRING, list_price DECIMAL(10,2), launch_date DATE,
        is_active BOOLEAN""",
    "dim_customer": "customer_id BIGINT, signup_date DATE, region STRING, customer_segment STRING",
    "dim_date": """date_key DATE, day_of_week SMALLINT, day_name STRING, week_of_year SMALLINT,
        month_num SMALLINT, month_name STRING, quarter SMALLINT, year SMALLINT, is_weekend BOOLEAN,
        is_holiday BOOLEAN, fiscal_period STRING""",
    "fact_orders": """order_line_id BIGINT, order_id BIGINT, seller_id BIGINT, product_id BIGINT,
        customer_id BIGINT, order_date DATE, quantity INT, unit_price DECIMAL(10,2),
        gmv DECIMAL(12,2), order_status STRING, is_cancelled BOOLEAN""",
    "fact_shipments": """shipment_id BIGINT, order_line_id BIGINT, seller_id BIGINT,
        promised_ship_date DATE, actual_ship_date DATE, promised_delivery_date DATE,
        actual_delivery_date DATE, is_late BOOLEAN, delay_days INT""",
    "fact_returns": """return_id BIGINT, order_line_id BIGINT, seller_id BIGINT, return_date DATE,
        return_reason_code STRING, refund_amount DECIMAL(12,2), is_defect_related BOOLEAN""",
    "fact_reviews": """review_id BIGINT, product_id BIGINT, seller_id BIGINT, customer_id BIGINT,
        review_date DATE, rating SMALLINT, is_verified_purchase BOOLEAN, text_length INT,
        sentiment_flag STRING""",
    "ground_truth_anomalies": """ground_truth_id BIGINT, seller_id BIGINT, anomaly_type STRING,
        affected_metric STRING, start_date DATE, end_date DATE, injected_magnitude DECIMAL(10,4),
        notes STRING""",
}

# Stored type of every spine column: values are rounded to these scales when the spine is built.
# Counts and precisions are wide enough for a seller that holds a large share of all orders.
SPINE_TYPES = {
    "seller_id": "bigint",
    "metric_date": "date",
    "order_volume": "bigint",
    "gmv": "decimal(22,2)",
    "avg_order_value": "decimal(14,2)",
    "defect_rate": "decimal(10,4)",
    "late_shipment_rate": "decimal(10,4)",
    "cancellation_rate": "decimal(10,4)",
    "return_rate": "decimal(10,4)",
    "refund_rate": "decimal(14,4)",
    "avg_rating": "decimal(4,3)",
    "review_count": "bigint",
    "review_velocity": "decimal(14,3)",
    "negative_review_rate": "decimal(6,4)",
    "avg_price": "decimal(14,2)",
    "price_volatility": "decimal(14,4)",
    "order_growth_rate_dod": "decimal(18,4)",
}

FLAG_TYPES = {
    "seller_id": "bigint",
    "flag_date": "date",
    "anomaly_type": "string",
    "affected_metric": "string",
    "baseline_value": "double",
    "observed_value": "double",
    "deviation_abs": "double",
    "deviation_pct": "double",
    "method": "string",
    "anomaly_score": "double",
    "severity": "string",
    "reason_code": "string",
    "explanation": "string",
}
FLAG_SCHEMA = ", ".join(f"{c} {t}" for c, t in FLAG_TYPES.items())

UPDATE_SCHEMA = (
    "case_id BIGINT, status STRING, root_cause STRING, notes STRING, resolution STRING, "
    "assigned_investigator STRING, updated_at TIMESTAMP_NTZ"
)
