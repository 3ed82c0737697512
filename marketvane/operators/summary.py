"""Named row counts and the trimmed extract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTED = {
    "total_sellers": "dim_seller",
    "total_products": "dim_product",
    "total_customers": "dim_customer",
    "total_orders": "fact_orders",
    "total_shipments": "fact_shipments",
    "total_returns": "fact_returns",
    "total_reviews": "fact_reviews",
}
EXTRACT_DAYS = 60


def dataset_summary(star: dict[str, DataFrame], computed_at: Column | None = None) -> DataFrame:
    """(metric_name, metric_value, computed_at) of the seven counted tables."""
    parts = [
        star[table].agg(F.count("*").alias("metric_value")).select(F.lit(name).alias("metric_name"), "metric_value")
        for name, table in COUNTED.items()
    ]
    moment = F.current_timestamp() if computed_at is None else computed_at
    return reduce(DataFrame.unionByName, parts).withColumn("computed_at", moment.cast("timestamp_ntz"))


def upsert_summary(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh counts replace those of the same name; other names stay."""
    return existing.join(fresh.select("metric_name"), "metric_name", "left_anti").unionByName(fresh)

