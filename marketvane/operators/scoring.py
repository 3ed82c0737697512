"""Seller health score and investigation priority score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..functions.scale import quantiles, rank_table, with_rank
from ..registry import (
    DEFAULT_RATING,
    ENSEMBLE,
    HEALTH_WEIGHTS,
    LOOKBACK_DAYS,
    METHODS,
    PRIORITY_WEIGHTS,
    SEVERITY_PENALTY,
    SEVERITY_POINTS,
    SLA_HOURS,
    coded,
    health_tier,
)

RATES = ("defect_rate", "late_shipment_rate", "return_rate", "cancellation_rate", "negative_review_rate")


def bad_is_high(value: Column, ceiling: Column) -> Column:
    """100 at zero, 0 at the ceiling or worse; without a positive ceiling all are healthy."""
    share = F.least(F.greatest(value, F.lit(0.0)), ceiling) / ceiling
    return F.when(ceiling > 0, 100 * (1 - share)).otherwise(F.lit(100.0))


def bad_is_low(value: Column, floor: float = 1.0, best: float = 5.0) -> Column:
    """100 at the best rating, 0 at the floor."""
    clipped = F.least(F.greatest(value, F.lit(floor)), F.lit(best))
    return 100 * (clipped - floor) / (best - floor)


def ceilings(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row with a struct: the 95th percentile of every column, or its maximum where that is zero."""
    found = quantiles(frame, columns, 0.95)
    tops = [F.when(F.col(f"{c}.at") > 0, F.col(f"{c}.at")).otherwise(F.col(f"{c}.top")).alias(c) for c in columns]
    return found.select(F.struct(*tops).alias("ceilings"))


def with_penalty(spine: DataFrame, flags: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Severity-weighted Ensemble flags of the seller in the trailing `days` calendar days.

    Flags are stacked onto the spine and summed by one range window per seller, so the spine is
    exchanged once and not joined.
    """
    weights = flags.where(F.col("method") == ENSEMBLE).select(
        "seller_id",
        F.col("flag_date").alias("metric_date"),
        coded(F.col("severity"), SEVERITY_PENALTY).cast("double").alias("_weight"),
    )
    readings = spine.select("seller_id", "metric_date", "avg_rating", *RATES, F.lit(True).alias("_reading"))
    trailing = (
        Window.partitionBy("seller_id").orderBy(F.unix_date("metric_date")).rangeBetween(-(days - 1), 0)
    )
    return (
        readings.unionByName(weights, allowMissingColumns=True)
        .withColumn("penalty", F.coalesce(F.sum("_weight").over(trailing), F.lit(0.0)))
        .where("_reading")
        .select(
            "seller_id",
            "metric_date",
            F.col("avg_rating").cast("double").alias("avg_rating"),
            *[F.col(c).cast("double").alias(c) for c in RATES],
            "penalty",
        )
    )


def health_scores(measured: DataFrame) -> DataFrame:
    """Health score 0-100, tier and components per seller and day.

    `measured` is read twice, for the limits and for the scores: pass a stored frame.
    """
    limits = ceilings(measured, (*RATES, "penalty")).scalar()
    limited = measured.withColumn("_c", limits)

    def high(column: str) -> Column:
        return bad_is_high(F.col(column), F.col(f"_c.{column}"))

    rating = bad_is_low(F.coalesce(F.col("avg_rating"), F.lit(DEFAULT_RATING)))
    components = {
        "defect": high("defect_rate"),
        "late_shipment": high("late_shipment_rate"),
        "return": high("return_rate"),
        "cancellation": high("cancellation_rate"),
        "review": (rating + high("negative_review_rate")) / 2,
        "anomaly_penalty": high("penalty"),
    }
    parts = limited.select(
        "seller_id", "metric_date", *[v.alias(f"{k}_component") for k, v in components.items()]
    )
    total = sum((F.col(f"{k}_component") * w for k, w in HEALTH_WEIGHTS.items()), F.lit(0.0))
    scored = parts.withColumn("health_score", half_up(total, 2))
    return scored.select(
        "seller_id",
        F.col("metric_date").alias("score_date"),
        "health_score",
        health_tier(F.col("health_score")).alias("health_tier"),
        *[half_up(F.col(f"{k}_component"), 2).alias(f"{k}_component") for k in HEALTH_WEIGHTS],
    )


def with_exposure(spine: DataFrame, flags: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Flags with the seller's sales and orders of the trailing 30 days.

    The spine is dense, so 30 rows are 30 days, and flags can be stacked onto it for one range
    window instead of joining the windowed spine.
    """
    readings = spine.select("seller_id", F.col("metric_date").alias("flag_date"), "gmv", "order_volume")
    trailing = Window.partitionBy("seller_id").orderBy(F.unix_date("flag_date")).rangeBetween(-(days - 1), 0)
    return (
        readings.unionByName(flags.withColumn("_flag", F.lit(True)), allowMissingColumns=True)
        .withColumns({"gmv_30d": F.sum("gmv").over(trailing), "orders_30d": F.sum("order_volume").over(trailing)})
        .where("_flag")
        .select(*flags.columns, "gmv_30d", "orders_30d")
    )


def methods_agreed(reason_code: Column) -> Column:
    """Number of detectors named in an Ensemble reason code."""
    names = F.array(*[F.lit(m) for m in METHODS])
    return F.size(F.filter(F.split(reason_code, "_"), lambda part: F.array_contains(names, part)))


def exposed_cases(spine: DataFrame, flags: DataFrame) -> DataFrame:
    """Ensemble flags with their trailing exposure."""
    cases = flags.where(F.col("method") == ENSEMBLE).select(
        "flag_id", "seller_id", "flag_date", "anomaly_type", "affected_metric", "severity", "reason_code", "explanation"
    )
    return with_exposure(spine, cases)


def priority_scores(cases: DataFrame) -> DataFrame:
    """Queue priority 0-100 of exposed cases. The cases are read several times: pass a stored frame."""
    money = F.coalesce(F.col("gmv_30d"), F.lit(0)).cast("double")
    orders = F.coalesce(F.col("orders_30d"), F.lit(0)).cast("double")
    valued = cases.withColumns({"_gmv": money, "_orders": orders})
    ranks = {c: rank_table(valued, c) for c in ("_gmv", "_orders")}
    ranked = valued
    for column, name in (("_gmv", "_financial"), ("_orders", "_customers")):
        ranked = with_rank(ranked, ranks[column], column, name, ["flag_id"])
    parts = ranked.withColumns(
        {
            "severity_component": coded(F.col("severity"), SEVERITY_POINTS).cast("double"),
            "financial_component": half_up(F.col("_financial"), 2),
            "customer_impact_component": half_up(F.col("_customers"), 2),
            "confidence_component": half_up(F.least(methods_agreed(F.col("reason_code")), F.lit(4)) / 4 * 100, 2),
        }
    )
    total = sum((F.col(f"{k}_component") * w for k, w in PRIORITY_WEIGHTS.items()), F.lit(0.0))
    return parts.select(
        "flag_id",
        "seller_id",
        "flag_date",
        "anomaly_type",
        "affected_metric",
        "severity",
        half_up(total, 2).alias("priority_score"),
        *[f"{k}_component" for k in PRIORITY_WEIGHTS],
        coded(F.col("severity"), SLA_HOURS).alias("sla_hours"),
        "gmv_30d",
        "orders_30d",
        "explanation",
    )
