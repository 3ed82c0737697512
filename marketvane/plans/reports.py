"""Report queries of the monitoring pages and the measures of the BI model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, percent, snap
from ..registry import ENSEMBLE, HEALTH_TIERS, METHODS, METRIC_NAMES, SEVERITIES, TICKET_STATUSES, is_open, is_unresolved
from .pipeline import Warehouse
from .questions import latest_health, mean_hours, recent_cohort, with_lead_flag

c = F.col
METHOD_ORDER = (*METHODS, ENSEMBLE)
QUEUE_SORTS = ("priority_score", "sla_deadline", "detected_date")


def _labels(w: Warehouse, column: str, values: Sequence[str]) -> DataFrame:
    spark = w.workspace.spark
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{column} string, position int")


def _cases(w: Warehouse) -> DataFrame:
    return w.flags.where(c("method") == ENSEMBLE)


def _case_counts(w: Warehouse) -> DataFrame:
    return _cases(w).groupBy("seller_id").agg(F.count("*").alias("anomaly_count"))


def _histogram(values: DataFrame, column: str, bins: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value; the top edge is inclusive."""
    span = values.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    low, high = c("_s.low"), c("_s.high")
    width = (high - low) / bins
    slot = F.when(high > low, F.least(F.floor(snap((c(column) - low) / width)), F.lit(bins - 1))).otherwise(F.lit(0))
    return (
        values.withColumn("_s", span)
        .groupBy(*by, slot.cast("long").alias("bin"), low.alias("low"), width.alias("width"))
        .agg(F.count("*").alias("n"))
        .select(*by, "bin", half_up(c("low") + c("bin") * c("width"), 4).alias("bin_start"), "n")
        .orderBy(*by, "bin")
    )


def summary_counts(w: Warehouse) -> DataFrame:
    """Headline volumes, read from the stored summary."""
    return w.dataset_summary().select("metric_name", "metric_value")


def tier_mix(w: Warehouse) -> DataFrame:
    """Sellers per health tier on the latest day; empty tiers count 0."""
    counts = latest_health(w).groupBy("health_tier").agg(F.count("*").alias("n"))
    return (
        _labels(w, "health_tier", HEALTH_TIERS)
        .join(counts, "health_tier", "left")
        .orderBy("position")
        .select("health_tier", F.coalesce("n", F.lit(0)).alias("n"))
    )


def ops_headline(w: Warehouse) -> DataFrame:
    """Active cases, all tickets, breaches and breach share."""
    return w.tickets.agg(
        F.count_if(is_unresolved(c("status"))).alias("active_investigations"),
        F.count("*").alias("total_tickets"),
        F.count_if("is_sla_breached").alias("sla_breaches"),
        F.coalesce(percent(F.count_if("is_sla_breached"), F.count("*")), F.lit(0.0)).alias("sla_breach_pct"),
    )


def health_histogram(w: Warehouse, bins: int = 40) -> DataFrame:
    return _histogram(latest_health(w).select("health_score"), "health_score", bins)


def flag_trend(w: Warehouse) -> DataFrame:
    """Ensemble flags per day."""
    return _cases(w).groupBy("flag_date").agg(F.count("*").alias("n")).orderBy("flag_date")


def top_risk(w: Warehouse, top: int = 5) -> DataFrame:
    """Lowest health scores on the latest day with flag counts."""
    known = latest_health(w).join(w.sellers, "seller_id", "left_semi")
    worst = known.orderBy("health_score", "seller_id").limit(top)
    return (
        worst.join(w.sellers, "seller_id")
        .join(_case_counts(w), "seller_id", "left")
        .select(
            "seller_id",
            "seller_name",
            "seller_segment",
            "primary_category",
            "health_score",
            "health_tier",
            F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
        )
        .orderBy("health_score", "seller_id")
    )


def risky_sellers(w: Warehouse, top: int = 30) -> DataFrame:
    """Lowest health scores with that day's metrics, flag count and highest open priority."""
    known = latest_health(w).join(w.sellers, "seller_id", "left_semi")
    worst = known.orderBy("health_score", "seller_id").limit(top)
    day = w.spine.select(
        "seller_id", c("metric_date").alias("score_date"), "defect_rate", "late_shipment_rate", "return_rate", "avg_rating"
    )
    urgent = (
        w.tickets.where(is_unresolved(c("status"))).groupBy("seller_id").agg(F.max("priority_score").alias("open_priority_score"))
    )
    return (
        worst.join(w.sellers, "seller_id")
        .join(day, ["seller_id", "score_date"], "left")
        .join(_case_counts(w), "seller_id", "left")
        .join(urgent, "seller_id", "left")
        .select(
            "seller_id",
            "seller_name",
            "seller_segment",
            "primary_category",
            "health_score",
            "health_tier",
            *[c(m).cast("double").alias(m) for m in ("defect_rate", "late_shipment_rate", "return_rate", "avg_rating")],
            F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
            "open_priority_score",
        )
        .orderBy("health_score", "seller_id")
    )


def flag_frequency(w: Warehouse, top: int = 30, shown: int = 15) -> DataFrame:
    """Most flagged among the risky sellers."""
    return (
        risky_sellers(w, top)
        .select("seller_id", "seller_name", "anomaly_count")
        .orderBy(F.desc("anomaly_count"), "seller_id")
        .limit(shown)
    )


def peer_heatmap(w: Warehouse, top: int = 30, days: int = 30) -> DataFrame:
    """Mean absolute peer score of the risky sellers, one column per metric."""
    chosen = latest_health(w).orderBy("health_score", "seller_id").limit(top).select("seller_id")
    return (
        recent_cohort(w, days)
        .join(chosen, "seller_id", "left_semi")
        .groupBy("seller_id")
        .pivot("metric_name", sorted(METRIC_NAMES))
        .agg(F.avg(F.abs(c("cohort_zscore"))))
        .join(w.sellers.select("seller_id", "seller_name"), "seller_id")
    )


def weekly_types(w: Warehouse) -> DataFrame:
    """Ensemble flags per week (from Monday) and type."""
    week = F.date_trunc("week", "flag_date").cast("date")
    return _cases(w).groupBy(week.alias("week"), "anomaly_type").agg(F.count("*").alias("n")).orderBy("week", "anomaly_type")


def type_totals(w: Warehouse) -> DataFrame:
    return _cases(w).groupBy("anomaly_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "anomaly_type")


def method_totals(w: Warehouse) -> DataFrame:
    """Stored flags per method, in method order; a method without flags counts 0."""
    counts = w.flags.groupBy("method").agg(F.count("*").alias("n"))
    return (
        _labels(w, "method", METHOD_ORDER)
        .join(counts, "method", "left")
        .orderBy("position")
        .select("method", F.coalesce("n", F.lit(0)).alias("n"))
    )


def ticket_kpis(w: Warehouse) -> DataFrame:
    """Seven measures of the ticket table in one row."""
    status = c("status")
    return w.tickets.agg(
        F.count("*").alias("total_tickets"),
        F.count_if(is_open(status)).alias("open_tickets"),
        F.count_if(~is_open(status)).alias("closed_tickets"),
        F.count_if(c("severity") == "Critical").alias("critical_tickets"),
        F.count_if("is_sla_breached").alias("sla_breaches"),
        percent(F.count_if("is_sla_breached"), F.count("*")).alias("sla_breach_pct"),
        mean_hours(c("detected_date"), c("resolved_at")).alias("avg_resolution_hours"),
    )


def priority_histogram(w: Warehouse, bins: int = 30) -> DataFrame:
    """Open tickets by severity and priority bin."""
    return _histogram(
        w.tickets.where(is_open(c("status"))).select("severity", "priority_score"), "priority_score", bins, ("severity",)
    )


def assigned_workload(w: Warehouse) -> DataFrame:
    return (
        w.tickets.where("assigned_investigator IS NOT NULL")
        .groupBy("assigned_investigator")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "assigned_investigator")
    )


def filtered_queue(
    w: Warehouse,
    statuses: Sequence[str] = ("New", "Investigating", "Action_Required"),
    severities: Sequence[str] = ("Critical", "High"),
    sort_by: str = "priority_score",
) -> DataFrame:
    """Cases of the chosen statuses and severities; an empty choice means all."""
    if sort_by not in QUEUE_SORTS:
        raise ValueError(f"sort_by must be one of {QUEUE_SORTS}")
    chosen = w.tickets.where(
        c("status").isin(*(statuses or TICKET_STATUSES)) & c("severity").isin(*(severities or SEVERITIES))
    )
    return (
        with_lead_flag(w, chosen, "anomaly_type", "affected_metric", "explanation")
        .join(w.sellers.select("seller_id", "seller_name"), "seller_id")
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
            "detected_date",
            "sla_deadline",
            "is_sla_breached",
            "explanation",
        )
        .orderBy(F.desc(sort_by), "case_id")
    )


def health_history(w: Warehouse) -> DataFrame:
    return w.health.select("seller_id", "score_date", "health_score", "health_tier")


def metric_history(w: Warehouse) -> DataFrame:
    shown = ("defect_rate", "late_shipment_rate", "return_rate", "avg_rating", "order_volume", "gmv")
    return w.spine.select("seller_id", "metric_date", *shown)


def flag_history(w: Warehouse) -> DataFrame:
    """Ensemble flags of all sellers as the seller page lists them."""
    shown = ("anomaly_type", "affected_metric", "method", "severity", "anomaly_score", "explanation")
    return _cases(w).select("seller_id", "flag_date", *shown)


def ticket_history(w: Warehouse) -> DataFrame:
    """Tickets of all sellers as the seller page lists them."""
    outcome = ("status", "assigned_investigator", "root_cause_category", "resolution", "is_sla_breached")
    return w.tickets.select("seller_id", "case_id", "detected_date", "severity", "priority_score", *outcome)


def seller_360(w: Warehouse, seller_id: int) -> dict[str, DataFrame]:
    """Everything known about one seller; the filter reaches every scan."""
    mine = c("seller_id") == seller_id

    def own(history: DataFrame, *order) -> DataFrame:
        return history.where(mine).drop("seller_id").orderBy(*order)

    return {
        "profile": w.sellers.where(mine),
        "health": own(health_history(w), "score_date"),
        "metrics": own(metric_history(w), "metric_date"),
        "flags": own(flag_history(w), F.desc("flag_date"), "anomaly_type"),
        "tickets": own(ticket_history(w), F.desc("detected_date"), "case_id"),
        "cases": w.tickets.where(mine & is_unresolved(c("status"))).agg(
            F.count("*").alias("open_cases"), F.max("priority_score").alias("top_priority")
        ),
    }


def seller_headlines(w: Warehouse) -> DataFrame:
    """The headline row of the seller page for every seller: latest health, open cases, top priority."""
    open_cases = (
        w.tickets.where(is_unresolved(c("status")))
        .groupBy("seller_id")
        .agg(F.count("*").alias("open_cases"), F.max("priority_score").alias("top_priority"))
    )
    latest = w.health.groupBy("seller_id").agg(
        F.max_by(F.struct("health_score", "health_tier"), "score_date").alias("h")
    )
    return (
        w.sellers.join(latest, "seller_id", "left")
        .join(open_cases, "seller_id", "left")
        .select(
            "seller_id",
            "seller_name",
            "seller_segment",
            "tenure_cohort",
            "primary_category",
            c("h.health_score").alias("health_score"),
            c("h.health_tier").alias("health_tier"),
            F.coalesce("open_cases", F.lit(0)).alias("open_cases"),
            "top_priority",
        )
    )


def peer_latest(w: Warehouse, seller_id: int | None = None) -> DataFrame:
    """Peer comparison on the latest day, for one seller or all."""
    rows = w.cohort_baseline(days=0)
    if seller_id is not None:
        rows = rows.where(c("seller_id") == seller_id)
    return rows.select("seller_id", "metric_name", "observed_value", "cohort_mean", "cohort_zscore").orderBy(
        "seller_id", "metric_name"
    )


def monthly_flags(w: Warehouse) -> DataFrame:
    """Ensemble flags per month against the month before."""
    month = F.trunc("flag_date", "month")
    counts = _cases(w).groupBy(month.alias("month")).agg(F.count("*").alias("flags"))
    before = F.last("flags").over(
        Window.orderBy(F.months_between("month", F.lit("2000-01-01").cast("date")).cast("int")).rangeBetween(-1, -1)
    )
    return (
        counts.withColumn("flags_prior_month", before.cast("double"))
        .withColumn("mom_pct", percent(c("flags") - c("flags_prior_month"), c("flags_prior_month"), 2))
        .orderBy("month")
    )


def executive_measures(w: Warehouse) -> DataFrame:
    """Sellers, mean health, active investigations, breach share and resolution time in one row."""
    latest = latest_health(w)
    score = c("health_score").cast("decimal(5,2)")
    active = ("New", "Investigating", "Action_Required")
    return w.tickets.agg(
        F.count_if(c("status").isin(*active)).alias("active_investigations"),
        percent(F.count_if("is_sla_breached"), F.count("*"), 2).alias("sla_breach_rate"),
        mean_hours(c("detected_date"), c("resolved_at")).alias("avg_resolution_hours"),
    ).select(
        w.sellers.agg(F.count("*")).scalar().alias("total_sellers"),
        latest.agg(half_up(F.sum(score).cast("double") / F.count(score), 2)).scalar().alias("avg_health_score"),
        "*",
    )


def gmv_at_risk(w: Warehouse) -> DataFrame:
    """All sales of the sellers that are At_Risk or Critical on the latest day."""
    at_risk = latest_health(w).where(c("health_tier").isin("At_Risk", "Critical")).select("seller_id")
    return w.spine.join(at_risk, "seller_id", "left_semi").agg(
        F.count_distinct("seller_id").alias("sellers_at_risk"),
        F.coalesce(F.sum("gmv").cast("double"), F.lit(0.0)).alias("gmv_at_risk"),
    )
