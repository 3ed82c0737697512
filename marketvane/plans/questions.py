"""The ten business questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import at_least, half_up, percent
from ..operators.evaluation import episode_hits
from ..registry import CLOSED_STATUSES, ENSEMBLE, is_open, is_unresolved
from .pipeline import Warehouse

c = F.col
HOUR = 3600.0


def latest_health(w: Warehouse, day: Column | None = None) -> DataFrame:
    """Health scores of a day, the last one unless given."""
    return w.health_on(day)


def last_critical_day(w: Warehouse) -> Column:
    return w.health.where("health_tier = 'Critical'").agg(F.max("score_date")).scalar()


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds between two zoneless moments, whatever the session's time zone."""

    def of_day(t: Column) -> Column:
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    return F.datediff(end, start).cast("long") * 86400 + of_day(end) - of_day(start)


def with_lead_flag(w: Warehouse, tickets: DataFrame, *columns: str) -> DataFrame:
    """Tickets with columns of the flag that leads the case."""
    return tickets.join(w.flags.select(c("flag_id").alias("primary_flag_id"), *columns), "primary_flag_id")


def complete_cases(w: Warehouse, tickets: DataFrame) -> DataFrame:
    """Tickets whose lead flag and seller are known, so a top list keeps its length through the joins."""
    lead = w.flags.select(c("flag_id").alias("primary_flag_id"))
    return tickets.join(lead, "primary_flag_id", "left_semi").join(w.sellers, "seller_id", "left_semi")


def unresolved_counts(w: Warehouse) -> DataFrame:
    return w.tickets.where(is_unresolved(c("status"))).groupBy("seller_id").agg(F.count("*").alias("open_tickets"))


def fastest_deteriorating(w: Warehouse, top: int = 25) -> DataFrame:
    """Q1: steepest fall of the health score against 30 rows earlier."""
    history = Window.partitionBy("seller_id").orderBy("score_date")
    latest = (
        w.health.select("seller_id", "score_date", "health_score", F.lag("health_score", 30).over(history).alias("before"))
        .groupBy("seller_id")
        .agg(F.max_by(F.struct("health_score", "before"), "score_date").alias("h"))
    )
    before, today = c("h.before"), c("h.health_score")
    return (
        latest.where(before.isNotNull())
        .join(w.sellers, "seller_id")
        .select(
            "seller_id",
            "seller_name",
            "primary_category",
            "seller_segment",
            before.alias("health_score_30d_ago"),
            today.alias("health_score_today"),
            half_up(today - before, 1).alias("score_change_30d"),
        )
        .orderBy("score_change_30d", "seller_id")
        .limit(top)
    )


def currently_critical(w: Warehouse, day: Column | None = None) -> DataFrame:
    """Q2: sellers in the Critical tier on a day, the latest unless given, with their unresolved tickets."""
    return (
        latest_health(w, day)
        .where("health_tier = 'Critical'")
        .join(w.sellers, "seller_id")
        .join(unresolved_counts(w), "seller_id", "left")
        .select(
            "seller_id",
            "seller_name",
            "primary_category",
            "seller_segment",
            "health_score",
            "health_tier",
            "defect_component",
            "late_shipment_component",
            "return_component",
            "review_component",
            F.coalesce("open_tickets", F.lit(0)).alias("open_tickets"),
        )
        .orderBy("health_score", "seller_id")
    )


def highest_impact(w: Warehouse, top: int = 25) -> DataFrame:
    """Q3: tickets of highest priority with that day's sales and orders."""
    best = complete_cases(w, w.tickets).orderBy(F.desc("priority_score"), "case_id").limit(top)
    day = w.spine.select("seller_id", c("metric_date").alias("detected_date"), "gmv", "order_volume")
    return (
        with_lead_flag(w, best, "anomaly_type", "affected_metric")
        .join(w.sellers.select("seller_id", "seller_name"), "seller_id")
        .join(day, ["seller_id", "detected_date"], "left")
        .select(
            "case_id",
            "seller_id",
            "seller_name",
            "anomaly_type",
            "affected_metric",
            "severity",
            "priority_score",
            "detected_date",
            "status",
            c("gmv").cast("double").alias("gmv_on_detection_day"),
            c("order_volume").cast("long").alias("orders_on_detection_day"),
        )
        .orderBy(F.desc("priority_score"), "case_id")
    )


def recent_cohort(w: Warehouse, days: int = 30) -> DataFrame:
    """Peer scores of the last `days` days."""
    return w.cohort_baseline(days).where(c("cohort_zscore").isNotNull())


def unusual_vs_peers(w: Warehouse, top: int = 25) -> DataFrame:
    """Q4: mean absolute peer score over three rates and 30 days, at least ten readings."""
    z = F.abs(c("cohort_zscore"))
    return (
        recent_cohort(w)
        .where(c("metric_name").isin("defect_rate", "late_shipment_rate", "return_rate"))
        .groupBy("seller_id", "tenure_cohort", "primary_category", "seller_segment")
        .agg(
            half_up(F.avg(z), 2).alias("avg_abs_cohort_zscore_30d"),
            F.count_if(at_least(z, 2.5)).alias("days_flagged_vs_peers"),
            F.count("*").alias("n"),
        )
        .where("n >= 10")
        .join(w.sellers.select("seller_id", "seller_name"), "seller_id")
        .drop("n")
        .orderBy(F.desc("avg_abs_cohort_zscore_30d"), "seller_id")
        .limit(top)
    )


def detection_speed(w: Warehouse) -> DataFrame:
    """Q5: days from the start of an episode to its first Ensemble flag, by type."""
    cases = w.flags.where(c("method") == ENSEMBLE)
    delay = F.datediff("first_flag_date", "start_date")
    return (
        episode_hits(cases, w.episodes)
        .join(w.episodes.select("ground_truth_id", "anomaly_type", "start_date"), "ground_truth_id")
        .withColumn("delay", delay.cast("long"))
        .groupBy("anomaly_type")
        .agg(
            F.count("*").alias("n_detected"),
            half_up(F.avg("delay"), 1).alias("mean_delay_days"),
            F.median("delay").alias("median_delay_days"),
            F.min("delay").alias("best_case_days"),
            F.max("delay").alias("worst_case_days"),
        )
        .orderBy("mean_delay_days", "anomaly_type")
    )


def false_positive_rate(w: Warehouse) -> DataFrame:
    """Q6: share of closed tickets found to be false positives, by type."""
    closed = w.tickets.where(c("status").isin(*CLOSED_STATUSES))
    return (
        with_lead_flag(w, closed, "anomaly_type")
        .groupBy("anomaly_type")
        .agg(
            F.count("*").alias("total_closed_tickets"),
            F.count_if(c("status") == "False_Positive").alias("false_positives"),
            F.count_if(c("status") == "Resolved").alias("resolved"),
            F.count_if(c("status") == "Escalated").alias("escalated"),
        )
        .withColumn("false_positive_pct", percent(c("false_positives"), c("total_closed_tickets")))
        .orderBy(F.desc("false_positive_pct"), "anomaly_type")
    )


def category_risk(w: Warehouse) -> DataFrame:
    """Q7: health and unresolved tickets by category on the latest day."""
    categories = w.sellers.select("seller_id", "primary_category")
    load = (
        unresolved_counts(w).join(categories, "seller_id").groupBy("primary_category").agg(F.sum("open_tickets").alias("open_tickets"))
    )
    score = c("health_score").cast("decimal(5,2)")
    return (
        latest_health(w)
        .join(categories, "seller_id")
        .groupBy("primary_category")
        .agg(
            F.count("*").alias("n_sellers"),
            half_up(F.sum(score).cast("double") / F.count(score), 1).alias("avg_health_score"),
            F.count_if(c("health_tier").isin("At_Risk", "Critical")).alias("at_risk_or_critical_sellers"),
        )
        .join(load, "primary_category", "left")
        .select(
            "primary_category",
            "n_sellers",
            "avg_health_score",
            "at_risk_or_critical_sellers",
            percent(c("at_risk_or_critical_sellers"), c("n_sellers")).alias("pct_at_risk_or_critical"),
            F.coalesce("open_tickets", F.lit(0)).alias("open_tickets"),
        )
        .orderBy(F.desc("pct_at_risk_or_critical"), "primary_category")
    )


def repeat_offenders(w: Warehouse, top: int = 25) -> DataFrame:
    """Q8: sellers with three tickets or more."""
    return (
        with_lead_flag(w, w.tickets, "anomaly_type")
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("total_tickets"),
            F.count_if(c("status") == "False_Positive").alias("false_positive_tickets"),
            F.count_if(c("status") != "False_Positive").alias("genuine_tickets"),
            F.size(F.collect_set("anomaly_type")).cast("long").alias("distinct_anomaly_types"),
            F.min("detected_date").alias("first_flagged"),
            F.max("detected_date").alias("most_recent_flagged"),
        )
        .where("total_tickets >= 3")
        .join(w.sellers.select("seller_id", "seller_name", "seller_segment"), "seller_id")
        .orderBy(F.desc("genuine_tickets"), F.desc("total_tickets"), "seller_id")
        .limit(top)
    )


def mean_hours(start: Column, end: Column) -> Column:
    """Mean hours between two moments, from whole seconds."""
    seconds = seconds_between(start.cast("timestamp_ntz"), end)
    return half_up(F.try_divide(F.sum(seconds), F.count(seconds)) / HOUR, 1)


def investigator_workload(w: Warehouse) -> DataFrame:
    """Q9: cases, breaches and mean resolution time per investigator."""
    return (
        w.tickets.groupBy("assigned_investigator")
        .agg(
            F.count("*").alias("total_cases"),
            F.count_if(is_open(c("status"))).alias("open_cases"),
            F.count_if("is_sla_breached").alias("sla_breaches"),
            percent(F.count_if("is_sla_breached"), F.count("*")).alias("sla_breach_pct"),
            mean_hours(c("detected_date"), c("resolved_at")).alias("avg_resolution_hours"),
        )
        .orderBy(F.desc("total_cases"), "assigned_investigator")
    )


def investigation_queue(w: Warehouse, top: int = 50) -> DataFrame:
    """Q10: unresolved cases by priority with the time left to their deadline."""
    left = seconds_between(c("as_of"), c("sla_deadline")) / HOUR
    waiting = complete_cases(w, w.tickets.where(is_unresolved(c("status"))))
    best = waiting.orderBy(F.desc("priority_score"), "case_id").limit(top)
    return (
        with_lead_flag(w, best, "anomaly_type", "affected_metric", "explanation")
        .join(w.sellers.select("seller_id", "seller_name"), "seller_id")
        .withColumn("as_of", w.reporting_time)
        .select(
            "case_id",
            "seller_id",
            "seller_name",
            "anomaly_type",
            "affected_metric",
            "severity",
            "priority_score",
            "status",
            "assigned_investigator",
            "sla_deadline",
            left.alias("hours_until_sla_deadline"),
            F.when(c("is_sla_breached"), "BREACHED").when(left < 24, "URGENT").otherwise("ON_TRACK").alias("sla_status"),
            "explanation",
        )
        .orderBy(F.desc("priority_score"), "case_id")
    )
