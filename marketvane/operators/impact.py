"""What earlier detection was worth, under stated assumptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up

# Assumptions of the estimate.
REACTIVE_DAYS = 10
HOURLY_COST = 45
REACTIVE_HOURS = 6
PROACTIVE_HOURS = 3
COST_PER_ORDER = 8


def business_impact(tickets: DataFrame, flags: DataFrame, spine: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row of totals over closed tickets that belong to a labelled episode of their type.

    A case is a (ticket, episode) pair with the episode started by the detection day. Pairs are
    counted with a running count of episode starts, and the days saved, which only episodes of the
    last ten days can give, by an equi-join on the day; no frame of all pairs is built.
    """
    key = ["seller_id", "anomaly_type"]
    cases = (
        tickets.where(F.col("status").isin("Resolved", "Escalated"))
        .join(flags.select(F.col("flag_id").alias("primary_flag_id"), "anomaly_type"), "primary_flag_id")
        .select("case_id", *key, F.col("detected_date").alias("day"))
    )
    starts = episodes.groupBy(*key, F.col("start_date").alias("day")).agg(F.count("*").alias("started"))
    so_far = Window.partitionBy(*key).orderBy("day").rangeBetween(Window.unboundedPreceding, 0)
    pairs = (
        cases.unionByName(starts, allowMissingColumns=True)
        .withColumn("pairs", F.coalesce(F.sum("started").over(so_far), F.lit(0)))
        .where("case_id IS NOT NULL AND pairs > 0")
        .agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("n_cases"))
    )
    recent = starts.select(
        *key, "started", F.col("day").alias("_start"), F.explode(F.sequence(F.lit(0), F.lit(REACTIVE_DAYS - 1))).alias("delay")
    ).select(*key, "started", F.date_add("_start", F.col("delay")).alias("day"), (REACTIVE_DAYS - F.col("delay")).alias("saved"))
    usual = spine.groupBy("seller_id").agg(
        (F.sum("order_volume") / F.count("*")).alias("orders"),
        (F.sum("gmv").cast("double") / F.count("*")).alias("gmv"),
    )
    n = F.col("started")
    saved_orders = half_up(F.col("saved") * F.coalesce("orders", F.lit(0.0)), 0)
    saved_gmv = half_up(F.col("saved") * F.coalesce("gmv", F.lit(0.0)), 2).cast("decimal(18,2)")
    saved = (
        cases.join(recent, [*key, "day"])
        .join(usual, "seller_id", "left")
        .agg(
            F.coalesce(F.sum(F.col("saved") * n), F.lit(0)).alias("days"),
            F.coalesce(F.sum(saved_orders.cast("long") * n), F.lit(0)).alias("orders"),
            F.coalesce(F.sum(saved_gmv * n).cast("double"), F.lit(0.0)).alias("gmv"),
        )
    )
    closed = cases.agg(F.count("*").alias("n"))
    hours = F.col("n_cases") * (REACTIVE_HOURS - PROACTIVE_HOURS)
    s = F.col("_s")
    return pairs.select(
        "n_cases",
        closed.select("n").scalar().alias("n_all_resolved_tickets"),
        saved.select(F.struct("days", "orders", "gmv")).scalar().alias("_s"),
    ).select(
        "n_cases",
        "n_all_resolved_tickets",
        half_up(F.try_divide(s["days"], F.col("n_cases")), 1).alias("mean_days_saved"),
        s["orders"].alias("total_orders_protected"),
        s["orders"].alias("total_customers_protected_estimate"),
        half_up(s["gmv"], 2).alias("total_gmv_exposure_avoided"),
        (s["orders"] * COST_PER_ORDER).cast("double").alias("total_defect_cost_avoided_usd"),
        hours.alias("investigation_hours_saved"),
        (hours * HOURLY_COST).alias("investigation_cost_saved_usd"),
    )
