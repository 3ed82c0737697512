"""The order, part, customer and supplier tables read as a seller star.

Supplier-days are sparse in these tables, so one engine day is one real week. Order lines have no
key of their own; a struct of the four whole numbers that identify a line is their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import pick
from ..operators.calendar import calendar
from ..operators.spine import order_bounds
from ..workspace import Workspace
from .fixture import labelled_episodes

LATE_AFTER_DAYS = 1500
CALENDAR_LEAD_DAYS = 365


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with its order's date, under engine days and decimal money."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    ordered = F.to_date("o_orderdate")
    real_days = F.datediff(ordered, _day("1995-01-01"))
    gmv = F.col("l_extendedprice").cast("decimal(12,2)")
    quantity = F.col("l_quantity").cast("int")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_line_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.date_add(_day("2020-01-01"), F.floor(real_days / 7).cast("int")).alias("order_date"),
        quantity.alias("quantity"),
        (gmv / quantity).cast("decimal(10,2)").alias("unit_price"),
        gmv.alias("gmv"),
        F.col("o_orderstatus").alias("source_status"),
        ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")).alias("is_cancelled"),
        F.col("l_linenumber").alias("line_number"),
        (F.datediff(F.to_date("l_shipdate"), ordered) > LATE_AFTER_DAYS).alias("is_late"),
        ((F.col("l_returnflag") == "R") & (F.col("l_discount").cast("decimal(4,2)") >= 0.08)).alias("is_returned"),
        (F.col("l_linestatus") == "F").alias("is_defect"),
        (F.col("l_tax").cast("decimal(4,2)") <= 0.01).alias("is_reviewed"),
    )


def _facts(lines: DataFrame) -> dict[str, DataFrame]:
    c = F.col
    status = (
        F.when(c("is_cancelled"), "Cancelled")
        .when(c("is_returned"), "Returned")
        .when(c("source_status") == "F", "Delivered")
        .when(c("source_status") == "P", "Shipped")
        .otherwise("Placed")
    )
    promised_ship = F.date_add("order_date", 1)
    promised = F.date_add(promised_ship, (2 + c("product_id") % 5).cast("int"))
    delay = F.when(c("is_late"), 1 + c("line_number")).otherwise(0)
    rating = 1 + (c("product_id") + 7 * c("line_number")) % 5
    return {
        "fact_orders": lines.select(
            "order_line_id", "order_id", "seller_id", "product_id", "customer_id", "order_date", "quantity",
            "unit_price", "gmv", status.alias("order_status"), "is_cancelled",
        ),
        "fact_shipments": lines.where(~c("is_cancelled")).select(
            c("order_line_id").alias("shipment_id"),
            "order_line_id",
            "seller_id",
            promised_ship.alias("promised_ship_date"),
            F.date_add(promised_ship, (c("line_number") % 2).cast("int")).alias("actual_ship_date"),
            promised.alias("promised_delivery_date"),
            F.date_add(promised, delay).alias("actual_delivery_date"),
            "is_late",
            delay.alias("delay_days"),
        ),
        "fact_returns": lines.where("is_returned").select(
            c("order_line_id").alias("return_id"),
            "order_line_id",
            "seller_id",
            F.date_add("order_date", (3 + 2 * c("line_number")).cast("int")).alias("return_date"),
            F.when(c("is_defect"), "Defective").otherwise("Changed_Mind").alias("return_reason_code"),
            c("gmv").alias("refund_amount"),
            c("is_defect").alias("is_defect_related"),
        ),
        "fact_reviews": lines.where("is_reviewed").select(
            c("order_line_id").alias("review_id"),
            "product_id",
            "seller_id",
            "customer_id",
            F.date_add("order_date", (1 + c("line_number")).cast("int")).alias("review_date"),
            rating.cast("smallint").alias("rating"),
            F.lit(True).alias("is_verified_purchase"),
            (20 + c("product_id") % 100).cast("int").alias("text_length"),
            F.when(rating <= 2, "Negative").when(rating == 3, "Neutral").otherwise("Positive").alias("sentiment_flag"),
        ),
    }


def _dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    c = F.col
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    places = nation.join(region, c("n_regionkey") == c("r_regionkey"))
    key = c("s_suppkey")
    signup = F.date_add(_day("2020-01-01"), (key * 37 % 100).cast("int"))
    sellers = (
        spark.read.parquet(f"{folder}/supplier.parquet")
        .join(places, c("s_nationkey") == c("n_nationkey"))
        .select(
            key.alias("seller_id"),
            c("s_name").alias("seller_name"),
            signup.alias("signup_date"),
            F.when(key % 2 == 0, "New").otherwise("Veteran").alias("tenure_cohort"),
            F.when(c("s_acctbal") >= 5000, "Power").otherwise("Micro").alias("seller_segment"),
            F.concat(F.lit("Category_"), c("n_regionkey") % 2).alias("primary_category"),
            pick(("Individual", "LLC", "Corporation"), key % 3).alias("business_type"),
            pick(("Marketplace-Fulfilled", "Self-Ship"), key % 2).alias("fulfillment_type"),
            c("n_name").alias("country"),
            c("r_name").alias("region"),
            F.lit(True).alias("is_active"),
            signup.alias("effective_start_date"),
            F.lit(None).cast("date").alias("effective_end_date"),
            F.lit(True).alias("is_current"),
        )
    )
    products = spark.read.parquet(f"{folder}/part.parquet").select(
        c("p_partkey").alias("product_id"),
        (c("p_partkey") % 10).alias("seller_id"),
        c("p_name").alias("product_name"),
        c("p_type").alias("category"),
        c("p_brand").alias("subcategory"),
        F.when(c("p_retailprice") < 1000, "Budget")
        .when(c("p_retailprice") < 1500, "Mid")
        .otherwise("Premium")
        .alias("price_tier"),
        c("p_retailprice").cast("decimal(10,2)").alias("list_price"),
        _day("2020-01-01").alias("launch_date"),
        F.lit(True).alias("is_active"),
    )
    customers = (
        spark.read.parquet(f"{folder}/customer.parquet")
        .join(places, c("c_nationkey") == c("n_nationkey"))
        .select(
            c("c_custkey").alias("customer_id"),
            F.date_add(_day("2019-01-01"), (c("c_custkey") % 365).cast("int")).alias("signup_date"),
            c("r_name").alias("region"),
            pick(("New", "Occasional", "Frequent", "VIP"), c("c_custkey") % 4).alias("customer_segment"),
        )
    )
    return {"dim_seller": sellers, "dim_product": products, "dim_customer": customers}


def commerce_star(spark: SparkSession, folder: str, workspace: Workspace) -> dict[str, DataFrame]:
    """All nine star tables. The lines are joined with their orders once and stored in buckets of the line key.

    Every fact is a selection of the lines, so facts meet each other by line without an exchange.
    """
    lines = workspace.bucketed("order_lines", lambda: order_lines(spark, folder), "order_line_id")
    star = {**_dimensions(spark, folder), **_facts(lines)}
    bounds = workspace.table("order_bounds", lambda: order_bounds(star["fact_orders"]))
    star["dim_date"] = calendar(bounds, CALENDAR_LEAD_DAYS)
    star["ground_truth_anomalies"] = labelled_episodes(star["dim_seller"], bounds)
    return star
