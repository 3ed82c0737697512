"""A fixture: labels and case work for tables that hold none.

Evaluation and case handling need labelled episodes and status updates, which no given table has. Both are derived
here from keys alone, by rule, and change no reading: an episode is only a window of days that an evaluation looks at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pick
from ..operators.quality import ROOT_CAUSES
from ..registry import ANOMALY_TYPES, METRICS, MULTI_METRIC

# Every third seller has one episode, which starts in the first 400 of the last 500 days and lasts 60 to 99 days.
EPISODE_SELLERS, EPISODE_REACH, EPISODE_STARTS, EPISODE_DAYS, EPISODE_DAYS_SPREAD = 3, 500, 400, 60, 40


def labelled_episodes(sellers: DataFrame, bounds: DataFrame) -> DataFrame:
    """One episode for every third seller, before the last day of `bounds`."""
    key, number = F.col("seller_id"), F.floor(F.col("seller_id") / EPISODE_SELLERS)
    first_metric = {m.anomaly_type: m.name for m in reversed(METRICS)} | {MULTI_METRIC: "multiple"}
    chosen = sellers.where(key % EPISODE_SELLERS == 0).select(
        (number + 1).alias("ground_truth_id"),
        "seller_id",
        (number % len(ANOMALY_TYPES)).alias("_kind"),
        F.date_add(
            F.date_sub(bounds.select("last_date").scalar(), EPISODE_REACH), (key * 37 % EPISODE_STARTS).cast("int")
        ).alias("start_date"),
    )
    return chosen.select(
        "ground_truth_id",
        "seller_id",
        pick(ANOMALY_TYPES, F.col("_kind")).alias("anomaly_type"),
        pick([first_metric[t] for t in ANOMALY_TYPES], F.col("_kind")).alias("affected_metric"),
        "start_date",
        F.date_add("start_date", (EPISODE_DAYS + key % EPISODE_DAYS_SPREAD).cast("int")).alias("end_date"),
        F.lit(1).cast("decimal(10,4)").alias("injected_magnitude"),
        F.concat(F.lit("Labelled episode: "), pick(ANOMALY_TYPES, F.col("_kind"))).alias("notes"),
    )


def status_updates(tickets: DataFrame) -> DataFrame:
    """Case work derived from the case number: a first look at every third case, then outcomes."""
    case = F.col("case_id")
    digit = case % 10
    minutes = F.col("sla_hours") * 6 * (case % 15)
    worked = F.col("detected_date").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))
    investigator = F.concat(F.lit("Investigator "), case % 8)
    none = F.lit(None).cast("string")
    looked_at = tickets.where(case % 3 == 0).select(
        "case_id",
        F.lit("Investigating").alias("status"),
        none.alias("root_cause"),
        F.lit("Under review").alias("notes"),
        none.alias("resolution"),
        investigator.alias("assigned_investigator"),
        F.col("detected_date").cast("timestamp_ntz").alias("updated_at"),
    )
    outcome = (
        F.when(digit <= 2, "False_Positive")
        .when(digit == 3, "Escalated")
        .when(digit <= 7, "Resolved")
        .otherwise("Action_Required")
    )
    closed = digit <= 7
    decided = tickets.where(digit <= 8).select(
        "case_id",
        outcome.alias("status"),
        F.when(closed, pick(ROOT_CAUSES, case % 7)).alias("root_cause"),
        none.alias("notes"),
        F.when(closed, F.concat(F.lit("Closed as "), outcome)).alias("resolution"),
        investigator.alias("assigned_investigator"),
        worked.alias("updated_at"),
    )
    return looked_at.unionByName(decided)
