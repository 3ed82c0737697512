"""The detector profile: trailing statistics from running sums, and windows that carry no arrays."""

import datetime as dt
from statistics import fmean, stdev

import pytest
from pyspark.sql import functions as F

from marketvane.operators.baselines import detector_profile
from marketvane.registry import METRICS

START = dt.date(2020, 1, 1)
RATES = [m.name for m in METRICS if m.decimals == 4]


def spine(spark, days, value):
    """Two sellers, whose rates read value(seller, day) in units of four decimals."""
    rows = [(s, START + dt.timedelta(d), value(s, d)) for s in (1, 2) for d in range(days)]
    frame = spark.createDataFrame(rows, "seller_id bigint, metric_date date, v bigint")
    read = {m.name: (F.col("v").cast("double") / 10**m.decimals).cast("decimal(24,4)") for m in METRICS}
    return frame.select("seller_id", "metric_date", *[c.alias(n) for n, c in read.items()])


def value(seller, day):
    """Small readings around one of ten billion units: its square is far beyond what a double holds exactly."""
    return 10**10 + 1 if day == 20 else seller + day * 7 % 11


def test_small_deviations_after_a_huge_reading(spark):
    found = detector_profile(spine(spark, 70, value)).where(F.col("metric") == [m.name for m in METRICS].index("refund_rate"))
    rows = {(r.seller_id, (r.metric_date - START).days): r for r in found.collect()}
    assert len(rows) == 140
    for (seller, day), r in rows.items():
        past = [value(seller, d) for d in range(max(0, day - 28), day)]
        assert r.roll_n == len(past)
        if not past:
            assert r.roll_mean is None and r.roll_std is None
        if past and 20 not in range(max(0, day - 28), day):
            assert r.roll_mean == pytest.approx(fmean(past), rel=1e-12)
            assert r.roll_std is None if len(past) < 2 else r.roll_std == pytest.approx(stdev(past), rel=1e-9)


def test_the_last_readings_pass_one_window_only(spark):
    plan = detector_profile(spine(spark, 3, value))._jdf.queryExecution().optimizedPlan().toString()
    branches = [b for b in plan.split("Generate inline") if "Window [" in b]
    assert len(branches) == 2
    for branch in branches:
        windows = [line for line in branch.splitlines() if "Window [" in line]
        assert "collect_list" in windows[0]
        assert not any("collect_list" in w for w in windows[1:])
