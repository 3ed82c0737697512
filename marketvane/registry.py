"""Metrics, thresholds and enumerations the engine is parameterized by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    """A daily metric: what a bad reading means and how many decimals are stored."""

    name: str
    anomaly_type: str
    direction: str
    decimals: int


# --- fixed values -----------------------------------------------------------
# Metric -> (anomaly type, bad direction, stored decimals); primary metrics
# first, then the three supporting ones. The order is also the tie-break order.
METRICS = (
    Metric("late_shipment_rate", "Late_Shipment_Spike", "up", 4),
    Metric("defect_rate", "Defect_Rate_Rise", "up", 4),
    Metric("return_rate", "Return_Rate_Spike", "up", 4),
    Metric("review_velocity", "Review_Velocity_Spike", "up", 3),
    Metric("avg_rating", "Rating_Manipulation", "up", 3),
    Metric("avg_price", "Price_Anomaly", "both", 2),
    Metric("order_volume", "Order_Volume_Shock", "both", 0),
    Metric("cancellation_rate", "Multi_Metric_Deterioration", "up", 4),
    Metric("negative_review_rate", "Multi_Metric_Deterioration", "up", 4),
    Metric("refund_rate", "Multi_Metric_Deterioration", "up", 4),
)
MULTI_METRIC = "Multi_Metric_Deterioration"
ANOMALY_TYPES = (
    "Late_Shipment_Spike",
    "Defect_Rate_Rise",
    "Return_Rate_Spike",
    "Review_Velocity_Spike",
    "Rating_Manipulation",
    "Price_Anomaly",
    "Order_Volume_Shock",
    "Multi_Metric_Deterioration",
)

# Metrics that a day may lack.
OPTIONAL = ("avg_rating", "avg_price")

METHODS = ("ZScore", "IQR", "CUSUM", "IsolationForest")
ENSEMBLE = "Ensemble"

SEVERITY_BANDS = ((6.0, "Critical"), (4.0, "High"), (2.5, "Medium"))
SEVERITIES = ("Low", "Medium", "High", "Critical")
SEVERITY_PENALTY = {"Low": 1, "Medium": 2, "High": 4, "Critical": 8}
SEVERITY_POINTS = {"Low": 25, "Medium": 50, "High": 75, "Critical": 100}
SLA_HOURS = {"Critical": 24, "High": 72, "Medium": 120, "Low": 240}

HEALTH_TIER_BANDS = ((80.0, "Healthy"), (60.0, "Watch"), (40.0, "At_Risk"))
HEALTH_TIERS = ("Healthy", "Watch", "At_Risk", "Critical")
HEALTH_WEIGHTS = {
    "defect": 0.30,
    "late_shipment": 0.20,
    "return": 0.15,
    "cancellation": 0.10,
    "review": 0.15,
    "anomaly_penalty": 0.10,
}
DEFAULT_RATING = 4.3
PRIORITY_WEIGHTS = {"severity": 0.35, "financial": 0.25, "customer_impact": 0.20, "confidence": 0.20}

TICKET_STATUSES = ("New", "Investigating", "Action_Required", "Resolved", "False_Positive", "Escalated")
CLOSED_STATUSES = ("Resolved", "False_Positive", "Escalated")
SETTLED_STATUSES = ("Resolved", "False_Positive")

Z_THRESHOLD = 3.0
BASELINE_ROWS = 28
MIN_BASELINE = 10
MIN_PEERS = 5
IQR_MULTIPLIER = 2.0
IQR_EXCLUDED = ("order_volume",)
IQR_SCORE_CAP = 50.0
CUSUM_SLACK = 0.5
CUSUM_ALARM = 8.0
CUSUM_MIN_OBS = 15
CUSUM_REARM_DAYS = 3
MIN_VOTES = 2
MULTI_TYPE_COUNT = 3
PERSISTENCE_DAYS = 3
LOOKBACK_DAYS = 30
# Columns of a flag, in order.
FLAG_COLUMNS = (
    "seller_id",
    "flag_date",
    "anomaly_type",
    "affected_metric",
    "baseline_value",
    "observed_value",
    "deviation_abs",
    "deviation_pct",
    "method",
    "anomaly_score",
    "severity",
    "reason_code",
    "explanation",
)
# ----------------------------------------------------------------------------

METRIC_NAMES = tuple(m.name for m in METRICS)
COHORT_KEYS = ("tenure_cohort", "primary_category", "seller_segment")


def metric_attribute(ordinal: Column, values) -> Column:
    """Look up a per-metric attribute by its ordinal (folded to one literal array)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), ordinal + 1)


def band(score: Column, bands, floor: str) -> Column:
    """Label of the first band whose inclusive lower bound the score reaches."""
    label = F.lit(floor)
    for bound, name in reversed(bands):
        label = F.when(score >= bound, name).otherwise(label)
    return label


def severity(score: Column) -> Column:
    return band(score, SEVERITY_BANDS, "Low")


def health_tier(score: Column) -> Column:
    return band(score, HEALTH_TIER_BANDS, "Critical")


def coded(column: Column, mapping: dict) -> Column:
    """Replace an enum label by its number; unknown labels give null."""
    result = F.lit(None)
    for label, value in mapping.items():
        result = F.when(column == label, F.lit(value)).otherwise(result)
    return result


def ordinal_of(column: Column, labels) -> Column:
    """Position of a label in a fixed order, for sorting."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), column).cast("int")


def is_unresolved(status: Column) -> Column:
    """Still on the queue: anything but Resolved and False_Positive."""
    return ~status.isin(*SETTLED_STATUSES)


def is_open(status: Column) -> Column:
    """Not closed at all: Escalated counts as closed here."""
    return ~status.isin(*CLOSED_STATUSES)
