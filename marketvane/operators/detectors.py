"""Z-score, interquartile and cumulative-sum detectors on the shared profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import above, at_least, half_up, relative_pct
from ..functions.scale import salted_join
from ..registry import (
    COHORT_KEYS,
    CUSUM_ALARM,
    CUSUM_REARM_DAYS,
    IQR_EXCLUDED,
    IQR_MULTIPLIER,
    IQR_SCORE_CAP,
    METRICS,
    Z_THRESHOLD,
    metric_attribute,
    severity,
)
from .baselines import cohort_zscore, metric_name, own_peers, self_zscore, unit_of


def _ordinals(metrics, *directions) -> list[int]:
    return [i for i, m in enumerate(metrics) if m.direction in directions]


def _may(metrics, direction: str) -> Column:
    """Whether a change in this direction is bad for the row's metric."""
    return F.col("metric").isin(_ordinals(metrics, direction, "both"))


def _is_z_candidate(metrics, threshold) -> Column:
    """Far from the seller's own baseline, the bad way; the peer test follows."""
    change = F.col("units") - F.col("roll_mean")
    far = at_least(F.abs(self_zscore()), threshold)
    return far & ((_may(metrics, "up") & (change > 0)) | (_may(metrics, "down") & (change < 0)))


def _fences(multiplier):
    q1, q3 = F.col("q1"), F.col("q3")
    spread = q3 - q1
    return q1 - multiplier * spread, q3 + multiplier * spread, spread


def _is_iqr_outlier(metrics, multiplier) -> Column:
    lower, upper, spread = _fences(multiplier)
    outside = (_may(metrics, "up") & (F.col("units") > upper)) | (_may(metrics, "down") & (F.col("units") < lower))
    excluded = [i for i, m in enumerate(metrics) if m.name in IQR_EXCLUDED]
    return (spread > 0) & outside & ~F.col("metric").isin(excluded)


def candidates(
    profile: DataFrame,
    metrics=METRICS,
    z_threshold: float = Z_THRESHOLD,
    iqr_multiplier: float = IQR_MULTIPLIER,
    alarm: float = CUSUM_ALARM,
) -> DataFrame:
    """The readings at least one detector may flag: a few percent of the profile, found in one pass.

    A drift alarm counts on the first day of a run only: no alarm on the three days before. The profile must have been
    made for the same alarm.
    """
    alarmed = F.coalesce(above(F.col("cusum"), alarm), F.lit(False))
    waited = F.coalesce(F.datediff("metric_date", "last_alarm") > CUSUM_REARM_DAYS, F.lit(True))
    marked = profile.withColumns(
        {
            "z_candidate": F.coalesce(_is_z_candidate(metrics, z_threshold), F.lit(False)),
            "iqr_outlier": F.coalesce(_is_iqr_outlier(metrics, iqr_multiplier), F.lit(False)),
            "cusum_alarm": alarmed & waited,
        }
    )
    return marked.where("z_candidate OR iqr_outlier OR cusum_alarm").drop("last_alarm")


def _flags(
    frame: DataFrame,
    metrics,
    method: str,
    baseline: Column,
    deviation: Column,
    score: Column,
    reason_suffix: str,
    explanation: Column,
) -> DataFrame:
    """The common flag layout. `baseline` and `deviation` are in units; the metric ordinal is kept."""
    unit = unit_of(metrics)
    value = frame.withColumns({"_base": baseline / unit, "_dev": deviation / unit, "_score": score})
    return value.select(
        "seller_id",
        F.col("metric_date").alias("flag_date"),
        metric_attribute(F.col("metric"), [m.anomaly_type for m in metrics]).alias("anomaly_type"),
        metric_name(metrics).alias("affected_metric"),
        F.col("_base").alias("baseline_value"),
        (F.col("units") / unit).alias("observed_value"),
        F.col("_dev").alias("deviation_abs"),
        relative_pct(F.col("_dev"), F.col("_base")).alias("deviation_pct"),
        F.lit(method).alias("method"),
        F.col("_score").alias("anomaly_score"),
        severity(F.col("_score")).alias("severity"),
        F.concat(metric_name(metrics), F.lit(reason_suffix)).alias("reason_code"),
        explanation.alias("explanation"),
        F.col("metric"),
    )


def _number(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", half_up(x, digits))


def zscore_flags(
    found: DataFrame, stats: DataFrame, sellers: DataFrame | None = None, metrics=METRICS, threshold: float = Z_THRESHOLD
) -> DataFrame:
    """Readings at least `threshold` deviations from both the seller's own and the peers' mean.

    Only the readings already far from the seller's own baseline meet the peer statistics, spread by seller, because
    a bad day of a large cohort has many of them. The statistics stay one row a cohort and day: the join copies them, and
    a copy a metric would be broadcast by way of the driver at ten times the size. `sellers` is needed only if `found`
    lacks the cohort keys.
    """
    unit = unit_of(metrics)
    far = found.where("z_candidate")
    if sellers is not None:
        far = far.join(sellers.select("seller_id", *COHORT_KEYS), "seller_id")
    both = (
        salted_join(far, stats, [*COHORT_KEYS, "metric_date"], ["seller_id"])
        .withColumns(own_peers(metrics))
        .withColumns({"self_z": self_zscore(), "peer_z": cohort_zscore()})
        .where(at_least(F.abs(F.col("peer_z")), threshold))
    )
    self_z, peer_z = F.col("self_z"), F.col("peer_z")
    return _flags(
        both,
        metrics,
        "ZScore",
        F.col("roll_mean"),
        F.col("units") - F.col("roll_mean"),
        half_up((F.abs(self_z) + F.abs(peer_z)) / 2, 4),
        "_self_and_cohort_zscore",
        F.concat(
            metric_name(metrics),
            F.lit(" read "),
            _number(F.col("units") / unit, 4),
            F.lit("; the seller's last 28 readings average "),
            _number(F.col("roll_mean") / unit, 4),
            F.lit(" ("),
            _number(self_z, 2),
            F.lit(" deviations away), its peers of the day "),
            _number(F.col("peer_mean") / unit, 4),
            F.lit(" ("),
            _number(peer_z, 2),
            F.lit(")."),
        ),
    )


def iqr_flags(found: DataFrame, metrics=METRICS, multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """Readings outside the trailing interquartile fence, scored by their distance from it."""
    lower, upper, spread = _fences(multiplier)
    unit = unit_of(metrics)
    u = F.col("units")
    distance = F.when(u > upper, u - upper).otherwise(lower - u)
    return _flags(
        found.where("iqr_outlier"),
        metrics,
        "IQR",
        (F.col("q1") + F.col("q3")) / 2,
        distance,
        half_up(F.least(F.try_divide(distance, spread), F.lit(IQR_SCORE_CAP)), 4),
        "_iqr_outlier",
        F.concat(
            metric_name(metrics),
            F.lit(" read "),
            _number(u / unit, 4),
            F.lit(", beyond the range "),
            _number(lower / unit, 4),
            F.lit(" to "),
            _number(upper / unit, 4),
            F.lit(" that the quartiles of the last 28 readings allow."),
        ),
    )


def cusum_flags(found: DataFrame, metrics=METRICS, alarm: float = CUSUM_ALARM) -> DataFrame:
    """First day of every run of drift alarms."""
    unit = unit_of(metrics)
    level = F.col("cusum") * F.col("anchor_std") / unit
    return _flags(
        found.where("cusum_alarm"),
        metrics,
        "CUSUM",
        F.col("anchor_mean"),
        F.col("units") - F.col("anchor_mean"),
        half_up(F.col("cusum"), 4),
        "_cusum_drift",
        F.concat(
            metric_name(metrics),
            F.lit(" keeps moving away from its early mean of "),
            _number(F.col("anchor_mean") / unit, 4),
            F.lit(": the summed drift is "),
            _number(level, 2),
            F.lit(", the limit "),
            _number(F.col("anchor_std") * alarm / unit, 2),
            F.lit("."),
        ),
    )
