"""Baselines and the three single-metric detectors against plain loops."""

import math
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketvane.operators import baselines, detectors
from marketvane.registry import METRICS
from tests.helpers import day, rows, sellers_frame, spine_frame

VOLUME = tuple(m for m in METRICS if m.name == "order_volume")
DEFECT = tuple(m for m in METRICS if m.name == "defect_rate")


def noisy(seed, n=80, jump=None):
    rng = random.Random(seed)
    values = [rng.randint(3, 9) for _ in range(n)]
    for i in range(n):
        if jump and i >= jump:
            values[i] += (i - jump) // 2
    return values


def found(spark, values, metrics=VOLUME):
    return detectors.candidates(baselines.detector_profile(spine_frame(spark, values, metrics[0].name), metrics), metrics)


def test_rolling_baseline_equals_pandas(spark):
    values = {1: noisy(1), 2: [100 * v for v in noisy(2)]}
    got = rows(baselines.rolling_baseline(spine_frame(spark, values), VOLUME), "seller_id", "metric_date")
    for seller, series in values.items():
        s = pd.Series(series, dtype=float).shift(1).rolling(28, min_periods=1)
        mine = [r for r in got if r["seller_id"] == seller]
        for i, r in enumerate(mine):
            n = min(i, 28)
            assert r["rolling_n_28d"] == n
            if n:
                assert r["rolling_mean_28d"] == pytest.approx(s.mean()[i])
            if n > 1:
                assert r["rolling_std_28d"] == pytest.approx(s.std()[i])
            assert (r["self_zscore"] is None) == (n < 10)


def test_constant_history_has_no_score(spark):
    got = rows(baselines.rolling_baseline(spine_frame(spark, {1: [5] * 30 + [50]}), VOLUME), "metric_date")
    assert got[-1]["rolling_std_28d"] == 0 and got[-1]["self_zscore"] is None


def test_missing_readings_are_not_observations(spark):
    series = [4.0 if i % 2 else None for i in range(40)]
    price = tuple(m for m in METRICS if m.name == "avg_price")
    got = rows(baselines.rolling_baseline(spine_frame(spark, {1: series}, "avg_price"), price), "metric_date")
    assert len(got) == 20 and [r["rolling_n_28d"] for r in got] == list(range(20))


@pytest.mark.parametrize("peers,scored", [(4, False), (5, True)])
def test_peer_score_needs_five_peers(spark, peers, scored):
    spine = spine_frame(spark, {i: [i] for i in range(1, peers + 1)})
    got = rows(baselines.cohort_baseline(baselines.with_cohort(spine, sellers_frame(spark, range(1, peers + 1))), VOLUME), "seller_id")
    values = list(range(1, peers + 1))
    for r in got:
        assert r["cohort_n"] == peers and r["cohort_mean"] == statistics.mean(values)
        want = (r["observed_value"] - statistics.mean(values)) / statistics.stdev(values)
        assert r["cohort_zscore"] == (pytest.approx(want) if scored else None)


def cusum_loop(values, direction):
    """The recurrence, day by day: alarm days kept under the re-arm rule."""
    n = len(values)
    if n < 15:
        return []
    anchor = values[: min(28, max(n // 3, 5))]
    mean, std = statistics.mean(anchor), statistics.pstdev(anchor)
    if std == 0:
        return []
    up = down = 0.0
    kept, last = [], None
    for i in range(1, n):
        up = max(0.0, up + values[i] - mean - 0.5 * std)
        down = max(0.0, down - (values[i] - mean) - 0.5 * std)
        c = up if direction == "up" else max(up, down)
        if c > 8 * std:
            if last is None or i - last > 3:
                kept.append((i, round(c / std, 4)))
            last = i
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_cusum_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    values = {s: [max(0, round(rng.gauss(20, 4) + (0.4 * i if s % 2 else -0.1 * i))) for i in range(rng.randint(12, 120))] for s in range(1, 7)}
    got = rows(detectors.cusum_flags(found(spark, values)), "seller_id", "flag_date")
    want = [(s, day(i), x) for s, series in values.items() for i, x in cusum_loop(series, "both")]
    assert [(r["seller_id"], r["flag_date"], r["anomaly_score"]) for r in got] == want


def test_cusum_needs_fifteen_readings(spark):
    base = [1, 2, 1, 2, 1] + [60] * 20
    assert rows(detectors.cusum_flags(found(spark, {1: base[:14]}))) == []
    assert len(rows(detectors.cusum_flags(found(spark, {1: base[:15]})))) == 1


def test_slow_drift_is_found_by_cusum_only(spark):
    series = [10 + (i % 3) + 0.05 * max(0, i - 28) for i in range(120)]
    spine = spine_frame(spark, {i: (series if i == 1 else [10 + ((j + i) % 3) for j in range(120)]) for i in range(1, 8)}, "review_velocity")
    metrics = tuple(m for m in METRICS if m.name == "review_velocity")
    marked = detectors.candidates(baselines.detector_profile(spine, metrics), metrics)
    sellers = sellers_frame(spark, range(1, 8))
    z = detectors.zscore_flags(marked, baselines.cohort_stats(baselines.with_cohort(spine, sellers), metrics), sellers, metrics)
    assert {r["seller_id"] for r in rows(detectors.cusum_flags(marked, metrics))} == {1}
    assert rows(z) == []


def test_iqr_equals_pandas_per_seller(spark):
    """Windows stay inside a seller: the second seller's first rows see none of the first's values."""
    rng = random.Random(5)
    values = {s: [round(rng.choice([0, 0.01, 0.02, 0.03, 0.04, 0.5]) * s, 4) for _ in range(70)] for s in (1, 2, 7)}
    got = {(r["seller_id"], r["flag_date"]): r for r in rows(detectors.iqr_flags(found(spark, values, DEFECT), DEFECT))}
    want = {}
    for s, series in values.items():
        v = pd.Series(series)
        w = v.shift(1).rolling(28, min_periods=10)
        q1, q3 = w.quantile(0.25), w.quantile(0.75)
        top = q3 + 2 * (q3 - q1)
        for i in range(len(v)):
            if q3[i] - q1[i] > 1e-12 and v[i] - top[i] > 1e-12:
                want[(s, day(i))] = min((v[i] - top[i]) / (q3[i] - q1[i]), 50)
    assert set(got) == set(want) and want
    for k, r in got.items():
        assert r["anomaly_score"] == pytest.approx(want[k], abs=1e-4)


def test_iqr_leaves_out_order_volume(spark):
    assert rows(detectors.iqr_flags(found(spark, {1: noisy(3) + [500]}), VOLUME)) == []


def test_zscore_needs_both_baselines(spark):
    """A jump of one seller is flagged; the same jump of all its peers is not."""
    calm = {s: noisy(s, 40) for s in range(1, 21)}
    one = {s: v + [60 if s == 1 else 6] for s, v in calm.items()}
    everyone = {s: v + [60] for s, v in calm.items()}
    sellers = sellers_frame(spark, range(1, 21))
    for values, want in ((one, {1}), (everyone, set())):
        spine = spine_frame(spark, values)
        marked = detectors.candidates(baselines.detector_profile(spine, VOLUME), VOLUME)
        got = rows(detectors.zscore_flags(marked, baselines.cohort_stats(baselines.with_cohort(spine, sellers), VOLUME), sellers, VOLUME))
        assert {r["seller_id"] for r in got if r["flag_date"] == day(40)} == want


def test_zscore_copies_no_statistics_a_metric(spark):
    """The join copies the statistics to spread hot keys; laid out a metric they would be ten times that on the driver."""
    marked = found(spark, {1: noisy(1, 40) + [60]})
    marked = spark.createDataFrame(marked.collect(), marked.schema)
    members = baselines.with_cohort(spine_frame(spark, {1: noisy(1, 40) + [60]}), sellers_frame(spark, [1]))
    flags = detectors.zscore_flags(marked, baselines.cohort_stats(members), sellers_frame(spark, [1]))
    assert flags._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1


def test_direction_up_ignores_a_drop(spark):
    rates = {1: [0.5 + 0.01 * (i % 5) for i in range(40)] + [0.0]}
    marked = rows(found(spark, rates, DEFECT).where(F.col("metric_date") == F.lit(day(40))))
    assert not any(r["z_candidate"] or r["iqr_outlier"] for r in marked)


def test_sellers_and_partitions_do_not_matter(spark):
    alone = rows(detectors.cusum_flags(found(spark, {1: noisy(1, 90, 40)})), "flag_date")
    both = rows(detectors.cusum_flags(found(spark, {1: noisy(1, 90, 40), 2: [1000] * 50 + [1] * 40})).where("seller_id = 1"), "flag_date")
    assert alone == both and alone
    spine = spine_frame(spark, {1: noisy(1, 90, 40)}).orderBy(F.rand(1)).repartition(5)
    again = detectors.candidates(baselines.detector_profile(spine, VOLUME), VOLUME)
    assert rows(detectors.cusum_flags(again), "flag_date") == alone
    assert math.isfinite(alone[0]["anomaly_score"])
