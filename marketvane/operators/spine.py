"""Dense daily metric series per seller from the raw facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, ratio_or_zero
from ..schemas import SPINE_TYPES

# Sellers whose days one task lays out, at most: a few hundred thousand rows if the series is a year long.
SELLERS_A_TASK = 1_000


def order_bounds(orders: DataFrame) -> DataFrame:
    """One row: first and last order date."""
    return orders.agg(F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))


def active_days(sellers: DataFrame, orders: DataFrame, sellers_a_task: int = SELLERS_A_TASK) -> DataFrame:
    """Every (seller, day) from the later of signup and first order date to the last order date.

    The sellers are a small table in few files, but their days are as many rows as the spine. They are dealt to tasks
    before they are laid out, by their number and not by their bytes, so a task's days are bounded.
    """
    bounds = order_bounds(orders).select(F.struct("first_date", "last_date").alias("b")).scalar()
    start = F.greatest(F.col("signup_date"), F.col("_b.first_date"))
    tasks = max(int(sellers.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sellers.count() // sellers_a_task))
    return (
        sellers.select("seller_id", "signup_date")
        .repartition(tasks, "seller_id")
        .select("seller_id", "signup_date", bounds.alias("_b"))
        .where(start <= F.col("_b.last_date"))
        .select("seller_id", F.explode(F.sequence(start, F.col("_b.last_date"))).alias("metric_date"))
    )


def returns_by_order_day(orders: DataFrame, returns: DataFrame, bucketed: bool = False) -> DataFrame:
    """Returns counted on the day of the order they belong to.

    Returns are reduced to one row per order line first, so the join never multiplies copies. Where both tables are
    stored in buckets of the line key, neither the reduction nor the join needs an exchange. Elsewhere the hash as a
    second key gives the reduced side an exchange of its own; with an exchange on both sides, adaptive execution can
    split the copies of a hot line among tasks.
    """
    per_line = returns.groupBy("order_line_id").agg(
        F.count("*").alias("return_count"),
        F.count_if("is_defect_related").alias("defect_returns"),
        F.sum("refund_amount").alias("refund_amount"),
    )
    lines, keys = orders.select("order_line_id", "seller_id", "order_date"), ["order_line_id"]
    if not bucketed:
        hashed, keys = F.xxhash64("order_line_id"), [*keys, "_hash"]
        lines, per_line = lines.withColumn("_hash", hashed), per_line.withColumn("_hash", hashed)
    return lines.join(per_line, keys).select(
        "seller_id", F.col("order_date").alias("metric_date"), "return_count", "defect_returns", "refund_amount"
    )


def daily_activity(
    orders: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    reviews: DataFrame,
    sellers: DataFrame,
    bucketed: bool = False,
) -> DataFrame:
    """Daily counts and sums, zero-activity days included.

    The four facts and the day grid are stacked and aggregated once: each input is reduced on its
    own side of a single exchange, where separate aggregates and joins would need one each.
    """
    one = F.lit(1).cast("long")
    parts = [
        active_days(sellers, orders).withColumn("active", F.lit(True)),
        orders.select(
            "seller_id",
            F.col("order_date").alias("metric_date"),
            one.alias("order_volume"),
            "gmv",
            F.when(F.col("gmv").isNotNull(), one).alias("gmv_rows"),
            "unit_price",
            F.when(F.col("unit_price").isNotNull(), one).alias("price_rows"),
            F.when(F.col("is_cancelled"), one).alias("cancelled_orders"),
        ),
        shipments.select(
            "seller_id",
            F.col("promised_ship_date").alias("metric_date"),
            one.alias("shipment_count"),
            F.when(F.col("is_late"), one).alias("late_shipments"),
        ),
        returns_by_order_day(orders, returns, bucketed),
        reviews.select(
            "seller_id",
            F.col("review_date").alias("metric_date"),
            one.alias("review_count"),
            F.col("rating").cast("long").alias("rating_sum"),
            F.when(F.col("rating").isNotNull(), one).alias("rating_rows"),
            F.when(F.col("rating") <= 2, one).alias("negative_reviews"),
        ),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = [c for c in stacked.columns if c not in ("seller_id", "metric_date", "active")]
    return (
        stacked.groupBy("seller_id", "metric_date")
        .agg(F.max("active").alias("active"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measures])
        .where("active")
        .drop("active")
    )


def daily_metrics(
    orders: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    reviews: DataFrame,
    sellers: DataFrame,
    bucketed: bool = False,
) -> DataFrame:
    """The 17-column spine: one row per seller and active day, rounded to the stored types.

    `bucketed` says that orders and returns are stored in buckets of the line key.
    """
    by_day = Window.partitionBy("seller_id").orderBy("metric_date")
    week = by_day.rowsBetween(-6, 0)
    c = F.col
    daily = daily_activity(orders, shipments, returns, reviews, sellers, bucketed).select(
        "*",
        F.try_divide(c("unit_price").cast("double"), c("price_rows")).alias("mean_price"),
    )
    windowed = daily.select(
        "*",
        F.avg("review_count").over(week).alias("velocity"),
        F.stddev_samp("mean_price").over(week).alias("volatility"),
        F.lag("order_volume").over(by_day).alias("previous_volume"),
    )
    columns = {
        "seller_id": c("seller_id"),
        "metric_date": c("metric_date"),
        "order_volume": c("order_volume"),
        "gmv": c("gmv"),
        "avg_order_value": F.coalesce(F.try_divide(c("gmv"), c("gmv_rows")), F.lit(0)),
        "defect_rate": ratio_or_zero(c("defect_returns"), c("order_volume")),
        "late_shipment_rate": ratio_or_zero(c("late_shipments"), c("shipment_count")),
        "cancellation_rate": ratio_or_zero(c("cancelled_orders"), c("order_volume")),
        "return_rate": ratio_or_zero(c("return_count"), c("order_volume")),
        "refund_rate": half_up(ratio_or_zero(c("refund_amount").cast("double"), c("gmv").cast("double")), 4),
        "avg_rating": F.try_divide(c("rating_sum"), c("rating_rows")),
        "review_count": c("review_count"),
        "review_velocity": F.coalesce(c("velocity"), F.lit(0)),
        "negative_review_rate": ratio_or_zero(c("negative_reviews"), c("review_count")),
        "avg_price": F.try_divide(c("unit_price"), c("price_rows")),
        "price_volatility": F.coalesce(c("volatility"), F.lit(0)),
        "order_growth_rate_dod": F.when(
            c("previous_volume") > 0, (c("order_volume") - c("previous_volume")) / c("previous_volume")
        ),
    }
    return windowed.select(*[columns[name].cast(t).alias(name) for name, t in SPINE_TYPES.items()])
