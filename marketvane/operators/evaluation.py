"""Detection quality against labelled episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..registry import ANOMALY_TYPES, ENSEMBLE, METHODS, MULTI_METRIC, SEVERITIES

ALL_METHODS = (*METHODS, ENSEMBLE)


def _labels(spark, column: str, values) -> DataFrame:
    schema = f"{column} string, position int"
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], schema)


def episode_days(episodes: DataFrame, flags: DataFrame) -> DataFrame:
    """Every (seller, day, flag type) an episode accounts for.

    A flag matches an episode of its own type, and either side being multi-metric matches any.
    Turning the interval into days makes the match an equi-join that never pairs all flags of a
    seller with all its episodes. Days are limited to the dates that carry flags.
    """
    span = flags.agg(F.struct(F.min("flag_date").alias("low"), F.max("flag_date").alias("high"))).scalar()
    own = F.array(F.col("anomaly_type"), F.lit(MULTI_METRIC))
    every = F.array(*[F.lit(t) for t in ANOMALY_TYPES])
    accepted = F.when(F.col("anomaly_type") == MULTI_METRIC, every).otherwise(own)
    first = F.greatest("start_date", F.col("_s.low"))
    last = F.least("end_date", F.col("_s.high"))
    return (
        episodes.select("ground_truth_id", "seller_id", "anomaly_type", "start_date", "end_date", span.alias("_s"))
        .where(first <= last)
        .select("ground_truth_id", "seller_id", F.explode(F.sequence(first, last)).alias("flag_date"), accepted.alias("_t"))
        .select("ground_truth_id", "seller_id", "flag_date", F.explode("_t").alias("anomaly_type"))
    )


def episode_hits(flags: DataFrame, episodes: DataFrame) -> DataFrame:
    """First matching flag of each method per episode it detected."""
    return (
        episode_days(episodes, flags)
        .join(flags.select("seller_id", "flag_date", "anomaly_type", "method"), ["seller_id", "flag_date", "anomaly_type"])
        .groupBy("ground_truth_id", "method")
        .agg(F.min("flag_date").alias("first_flag_date"))
    )


def judged_flags(flags: DataFrame, episodes: DataFrame) -> DataFrame:
    """Flags with `is_true`: inside some episode of the seller that its type matches."""
    inside = episode_days(episodes, flags).select("seller_id", "flag_date", "anomaly_type").distinct()
    return flags.join(inside.withColumn("is_true", F.lit(True)), ["seller_id", "flag_date", "anomaly_type"], "left").withColumn(
        "is_true", F.coalesce("is_true", F.lit(False))
    )


def evaluate_methods(flags: DataFrame, episodes: DataFrame, methods=ALL_METHODS) -> DataFrame:
    """Flags, recall, precision, F1, false-positive rate and mean delay of every method."""
    spark = flags.sparkSession
    delays = (
        episode_hits(flags, episodes)
        .join(episodes.select("ground_truth_id", "start_date"), "ground_truth_id")
        .groupBy("method")
        .agg(
            F.count("*").alias("n_hits"),
            F.avg(F.datediff("first_flag_date", "start_date")).alias("mean_delay"),
        )
    )
    precise = (
        judged_flags(flags, episodes)
        .groupBy("method")
        .agg(F.count("*").alias("n_flags"), F.count_if("is_true").alias("n_true"))
    )
    n_episodes = episodes.agg(F.count("*")).scalar()
    c = F.col
    joined = (
        _labels(spark, "method", methods)
        .join(precise, "method", "left")
        .join(delays, "method", "left")
        .na.fill(0, ["n_flags", "n_true", "n_hits"])
        .withColumn("n_ground_truth_episodes", n_episodes)
        .withColumn("r", F.coalesce(F.try_divide(c("n_hits"), c("n_ground_truth_episodes")), F.lit(0.0)))
        .withColumn("p", F.coalesce(F.try_divide(c("n_true"), c("n_flags")), F.lit(0.0)))
    )
    f1 = F.when(c("p") + c("r") > 0, 2 * c("p") * c("r") / (c("p") + c("r"))).otherwise(F.lit(0.0))
    return joined.orderBy("position").select(
        "method",
        "n_flags",
        "n_ground_truth_episodes",
        half_up(c("r"), 4).alias("recall"),
        half_up(c("p"), 4).alias("precision"),
        half_up(f1, 4).alias("f1"),
        F.when(c("n_flags") > 0, half_up(1 - c("p"), 4)).otherwise(F.lit(0.0)).alias("false_positive_rate"),
        half_up(c("mean_delay"), 2).alias("mean_detection_delay_days"),
    )


def recall_by_type(flags: DataFrame, episodes: DataFrame, methods=ALL_METHODS) -> DataFrame:
    """Share of detected episodes by method and episode type."""
    spark = flags.sparkSession
    detected = (
        episode_hits(flags, episodes)
        .join(episodes.select("ground_truth_id", "anomaly_type"), "ground_truth_id")
        .groupBy("method", "anomaly_type")
        .agg(F.count("*").alias("n_detected"))
    )
    return (
        episodes.groupBy("anomaly_type")
        .agg(F.count("*").alias("n_episodes"))
        .withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
        .join(detected, ["method", "anomaly_type"], "left")
        .na.fill(0, ["n_detected"])
        .select(
            "method",
            "anomaly_type",
            "n_episodes",
            "n_detected",
            half_up(F.col("n_detected") / F.col("n_episodes"), 4).alias("recall"),
        )
    )


def precision_by_severity(flags: DataFrame, episodes: DataFrame, method: str = ENSEMBLE) -> DataFrame:
    """Flags and precision per severity; all four severities are present."""
    chosen = flags.where(F.col("method") == method)
    counted = (
        judged_flags(chosen, episodes)
        .groupBy("severity")
        .agg(F.count("*").alias("n_flags"), F.count_if("is_true").alias("n_true"))
    )
    return (
        _labels(flags.sparkSession, "severity", SEVERITIES)
        .join(counted, "severity", "left")
        .na.fill(0, ["n_flags", "n_true"])
        .orderBy("position")
        .select(
            "severity",
            "n_flags",
            half_up(F.coalesce(F.try_divide("n_true", "n_flags"), F.lit(0.0)), 4).alias("precision"),
        )
    )


def seller_confusion(flags: DataFrame, episodes: DataFrame, methods=ALL_METHODS) -> DataFrame:
    """Sellers flagged against sellers labelled, per method, over sellers that are either."""
    by_method = [F.coalesce(F.max(F.col("method") == m), F.lit(False)).alias(m) for m in methods]
    flagged = flags.groupBy("seller_id").agg(*by_method)
    labelled = episodes.select("seller_id").distinct().withColumn("labelled", F.lit(True))
    everyone = flagged.join(labelled, "seller_id", "full_outer").na.fill(False)
    long = everyone.unpivot(["seller_id", "labelled"], list(methods), "method", "flagged")
    f, t = F.col("flagged"), F.col("labelled")
    return long.groupBy("method").agg(
        F.count_if(f & t).alias("tp"),
        F.count_if(f & ~t).alias("fp"),
        F.count_if(~f & t).alias("fn"),
        F.count_if(~f & ~t).alias("tn"),
    )
