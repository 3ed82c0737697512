"""User events as a daily series: any entity with daily readings can be monitored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import ratio_or_zero
from ..registry import METRICS

ACTIVITY_METRICS = tuple(m for m in METRICS if m.name in ("defect_rate", "avg_price", "order_volume"))


def activity_series(spark: SparkSession, folder: str) -> DataFrame:
    """Per user and day: events, share of errors and mean value, under the metric names they play.

    Only days with events are present.
    """
    events = spark.read.parquet(f"{folder}/events.parquet")
    value = F.col("value").cast("decimal(12,2)")
    daily = events.groupBy(F.col("user_id").alias("seller_id"), F.to_date("ts").alias("metric_date")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.sum(value).alias("total"),
        F.count(value).alias("valued"),
    )
    return daily.select(
        "seller_id",
        "metric_date",
        F.col("n").cast("int").alias("order_volume"),
        ratio_or_zero(F.col("errors"), F.col("n")).cast("decimal(10,4)").alias("defect_rate"),
        F.try_divide("total", "valued").cast("decimal(10,2)").alias("avg_price"),
    )
