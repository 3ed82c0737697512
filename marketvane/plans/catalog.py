"""Every query of the engine on the order, part, customer and supplier tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, ShortType

from ..functions.numeric import half_up
from ..operators import baselines, detectors
from ..registry import METHODS
from ..sources.activity import ACTIVITY_METRICS, activity_series
from ..sources.commerce import commerce_star
from ..sources.fixture import status_updates
from ..workspace import Workspace
from . import questions, reports
from .pipeline import Warehouse

# The detectors of most queries; the forest joins them in the `forest_*` queries.
SQL_METHODS = METHODS[:3]

# The load's moment of the registered queries. It lies inside the star's days, so the check for later orders finds some.
LOADED_AT = "2020-11-15 00:00:00"

_workspaces: dict[tuple[str, str], Workspace] = {}
_warehouses: dict[tuple[str, str, tuple[str, ...]], Warehouse] = {}


def _workspace(spark: SparkSession, folder: str) -> Workspace:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark)
    return _workspaces[key]


def warehouse(spark: SparkSession, folder: str, methods: tuple[str, ...] = SQL_METHODS) -> Warehouse:
    """The warehouse of a folder; its stored tables are shared by all queries of the application."""
    key = (spark.sparkContext.applicationId, folder, methods)
    if key not in _warehouses:
        workspace = _workspace(spark, folder)
        star = commerce_star(spark, folder, workspace)
        loaded_at = F.lit(LOADED_AT).cast("timestamp_ntz")
        _warehouses[key] = Warehouse(star, workspace, methods, status_updates, loaded_at, bucketed=True)
    return _warehouses[key]


def plain(frame: DataFrame) -> DataFrame:
    """Portable column types: whole numbers as bigint, decimals as doubles."""
    out = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (IntegerType, ShortType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, DecimalType) and field.dataType.scale == 0:
            column = column.cast("bigint")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        out.append(column.alias(field.name))
    return frame.select(*out)


def _flag_view(frame: DataFrame) -> DataFrame:
    """Flags with their measured values at six decimals."""
    measured = ("baseline_value", "observed_value", "deviation_abs", "deviation_pct")
    return frame.withColumns({m: half_up(F.col(m), 6) for m in measured}).drop("metric")


def _rounded(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({x: half_up(F.col(x), 6) for x in columns})


def _ticket_view(frame: DataFrame) -> DataFrame:
    """Tickets with the attached flags as text."""
    return frame.withColumn(
        "related_flag_ids", F.array_join(F.transform("related_flag_ids", lambda i: i.cast("string")), ",")
    )


def _votes_view(frame: DataFrame) -> DataFrame:
    return _rounded(frame.withColumn("methods", F.array_join("methods", ",")), "avg_score")


def _with_forest(build: Callable[[Warehouse], DataFrame]):
    return lambda spark, folder: plain(build(warehouse(spark, folder, METHODS)))


def _on(build: Callable[[Warehouse], DataFrame]):
    return lambda spark, folder: plain(build(warehouse(spark, folder)))


ROLLING = ("rolling_mean_28d", "rolling_std_28d", "self_zscore")
COHORT = ("cohort_mean", "cohort_std", "cohort_zscore")


def _activity_rolling(spark, folder):
    return plain(_rounded(baselines.rolling_baseline(activity_series(spark, folder), ACTIVITY_METRICS), *ROLLING))


def _activity_flags(spark, folder):
    found = _workspace(spark, folder).table(
        "activity_candidates",
        lambda: detectors.candidates(
            baselines.detector_profile(activity_series(spark, folder), ACTIVITY_METRICS), ACTIVITY_METRICS
        ),
    )
    flags = detectors.iqr_flags(found, ACTIVITY_METRICS).unionByName(detectors.cusum_flags(found, ACTIVITY_METRICS))
    return plain(_flag_view(flags))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # loading, quality, summaries
    "dim_date": _on(lambda w: w.star["dim_date"]),
    "dataset_summary": _on(lambda w: w.dataset_summary()),
    "dq_report": _on(Warehouse.dq_report),
    "dq_domains": _on(Warehouse.domain_report),
    "dq_keys": _on(Warehouse.key_report),
    "trimmed_extract": _on(lambda w: _rounded(w.trimmed_extract(), *COHORT)),
    # series and baselines
    "daily_metrics": _on(lambda w: w.spine),
    "rolling_baseline": _on(lambda w: _rounded(w.rolling_baseline(), *ROLLING)),
    "cohort_baseline": _on(lambda w: _rounded(w.cohort_baseline(), *COHORT)),
    # detection
    "zscore_flags": _on(lambda w: _flag_view(w.zscore_flags())),
    "iqr_flags": _on(lambda w: _flag_view(w.iqr_flags())),
    "cusum_flags": _on(lambda w: _flag_view(w.cusum_flags())),
    "method_flag_counts": _on(reports.method_totals),
    "ensemble_votes": _on(lambda w: _votes_view(w.votes())),
    "ensemble_flags": _on(lambda w: _flag_view(w.ensemble_flags())),
    "anomaly_flags": _on(lambda w: _flag_view(w.flags)),
    # scoring and investigation
    "health_score": _on(lambda w: w.health),
    "priority_score": _on(Warehouse.priority),
    "tickets": _on(lambda w: _ticket_view(w.new_tickets)),
    "ticket_merge": _on(lambda w: _ticket_view(w.merged_tickets())),
    "sla_breaches": _on(lambda w: _ticket_view(w.tickets)),
    "sla_summary": _on(Warehouse.sla_summary),
    # evaluation
    "eval_methods": _on(Warehouse.evaluation),
    "eval_type_recall": _on(Warehouse.type_recall),
    "eval_severity": _on(Warehouse.severity_precision),
    "eval_confusion": _on(Warehouse.confusion),
    "business_impact": _on(Warehouse.business_impact),
    # business questions
    "q1_deteriorating": _on(questions.fastest_deteriorating),
    "q2_critical": _on(questions.currently_critical),
    "q2_critical_before": _on(lambda w: questions.currently_critical(w, questions.last_critical_day(w))),
    "q3_impact": _on(questions.highest_impact),
    "q4_vs_peers": _on(questions.unusual_vs_peers),
    "q5_detection_speed": _on(questions.detection_speed),
    "q6_false_positive": _on(questions.false_positive_rate),
    "q7_category_risk": _on(questions.category_risk),
    "q8_repeat": _on(questions.repeat_offenders),
    "q9_workload": _on(questions.investigator_workload),
    "q10_queue": _on(lambda w: _rounded(questions.investigation_queue(w), "hours_until_sla_deadline")),
    # reports
    "r_summary_counts": _on(reports.summary_counts),
    "r_tier_mix": _on(reports.tier_mix),
    "r_ops_headline": _on(reports.ops_headline),
    "r_health_hist": _on(reports.health_histogram),
    "r_flag_trend": _on(reports.flag_trend),
    "r_top_risk": _on(reports.top_risk),
    "r_risky": _on(reports.risky_sellers),
    "r_flag_frequency": _on(reports.flag_frequency),
    "r_peer_heatmap": _on(
        lambda w: _rounded(reports.peer_heatmap(w), *[m for m in reports.METRIC_NAMES])
    ),
    "r_weekly_types": _on(reports.weekly_types),
    "r_type_totals": _on(reports.type_totals),
    "r_ticket_kpi": _on(reports.ticket_kpis),
    "r_priority_hist": _on(reports.priority_histogram),
    "r_assigned_workload": _on(reports.assigned_workload),
    "r_queue": _on(reports.filtered_queue),
    "r_seller360": _on(reports.seller_headlines),
    "r_seller_history": _on(reports.health_history),
    "r_seller_metrics": _on(reports.metric_history),
    "r_seller_flags": _on(reports.flag_history),
    "r_seller_tickets": _on(reports.ticket_history),
    "r_peer_latest": _on(lambda w: _rounded(reports.peer_latest(w), "cohort_mean", "cohort_zscore")),
    "m_flag_mom": _on(reports.monthly_flags),
    "m_executive": _on(reports.executive_measures),
    "m_gmv_at_risk": _on(reports.gmv_at_risk),
    # a second series
    "activity_rolling": _activity_rolling,
    "activity_flags": _activity_flags,
    # with the isolation forest
    "iforest_flags": _with_forest(lambda w: _flag_view(w.forest_flags())),
    "forest_anomaly_flags": _with_forest(lambda w: _flag_view(w.flags)),
    "forest_health_score": _with_forest(lambda w: w.health),
    "forest_tickets": _with_forest(lambda w: _ticket_view(w.tickets)),
    "forest_eval_methods": _with_forest(Warehouse.evaluation),
}
