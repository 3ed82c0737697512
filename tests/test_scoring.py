"""Normalizers, health score, priority, tickets and service levels."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketvane.operators.scoring import (
    bad_is_high,
    bad_is_low,
    ceilings,
    exposed_cases,
    health_scores,
    priority_scores,
    with_penalty,
)
from marketvane.operators.tickets import apply_updates, build_tickets, mark_breaches, sla_summary
from marketvane.schemas import UPDATE_SCHEMA
from tests.helpers import day, flags_frame, rows, spine_frame


def normalized(spark, values):
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    with_limits = frame.withColumn("_c", ceilings(frame, ("v",)).scalar())
    return [r["s"] for r in rows(with_limits.select("i", bad_is_high(F.col("v"), F.col("_c.v")).alias("s")), "i")]


def test_zero_is_healthy(spark):
    assert normalized(spark, [0, 0.01, 0.02, 0.05, 0.10])[0] == 100


def test_maximum_replaces_a_zero_percentile(spark):
    assert normalized(spark, [0] * 20 + [1.0])[-1] <= 5


def test_scores_stay_in_bounds(spark):
    assert all(0 <= s <= 100 for s in normalized(spark, [0, 0.5, 1, 5, -1]))


def test_all_zero_is_all_healthy(spark):
    assert normalized(spark, [0, 0, 0]) == [100, 100, 100]


def test_ceiling_is_the_interpolated_percentile(spark):
    values = [i / 7 for i in range(41)]
    top = pd.Series(values).quantile(0.95)
    assert normalized(spark, values) == pytest.approx([100 * (1 - min(v, top) / top) for v in values])


def test_ratings(spark):
    frame = spark.createDataFrame([(5.0,), (3.0,), (1.0,), (0.0,)], "v double")
    assert [r["s"] for r in frame.select(bad_is_low(F.col("v")).alias("s")).collect()] == [100, 50, 0, 0]


def ensemble(spark, entries):
    """Ensemble flags from (seller, day, severity score)."""
    flags = flags_frame(spark, [(s, n, "Defect_Rate_Rise", "Ensemble", x) for s, n, x in entries])
    return flags.withColumn("reason_code", F.lit("agreement_of_IQR_ZScore")).withColumn(
        "flag_id", F.col("seller_id") * 100 + F.datediff("flag_date", F.lit(day(0)))
    )


def test_penalty_sums_the_last_thirty_days(spark):
    spine = spine_frame(spark, {1: [1] * 50, 2: [1] * 50})
    got = rows(with_penalty(spine, ensemble(spark, [(1, 5, 9), (1, 5, 4.5), (1, 10, 1)])), "seller_id", "metric_date")
    mine = [r["penalty"] for r in got if r["seller_id"] == 1]
    assert mine == [0] * 5 + [12] * 5 + [13] * 25 + [1] * 5 + [0] * 10
    assert all(r["penalty"] == 0 for r in got if r["seller_id"] == 2) and len(got) == 100


def test_health_of_clean_and_bad_days(spark):
    spine = spine_frame(spark, {1: ["0"] * 19 + ["1"]}, "defect_rate")
    got = rows(health_scores(with_penalty(spine, ensemble(spark, [(1, 0, 3)]).where("false"))), "score_date")
    rating = 0.15 * (100 * 3.3 / 4 + 100) / 2
    assert got[0]["health_score"] == round(85 + rating, 2) and got[0]["health_tier"] == "Healthy"
    assert got[-1]["health_score"] == round(55 + rating, 2) and got[-1]["defect_component"] == 0
    assert all(0 <= r["health_score"] <= 100 for r in got)


def test_priority_ranks_and_weights(spark):
    spine = spine_frame(spark, {1: [1] * 40, 2: [3] * 40, 3: [3] * 40})
    flags = ensemble(spark, [(1, 39, 9), (2, 39, 4.5), (3, 20, 1), (3, 39, 2.6)])
    got = {r["flag_id"]: r for r in rows(priority_scores(exposed_cases(spine, flags)))}
    assert [got[k]["orders_30d"] for k in (139, 239, 320, 339)] == [30, 90, 63, 90]
    assert [got[k]["customer_impact_component"] for k in (139, 320, 239, 339)] == [25.0, 50.0, 87.5, 87.5]
    assert {r["financial_component"] for r in got.values()} == {62.5}
    assert got[139]["confidence_component"] == 50.0 and got[139]["sla_hours"] == 24
    assert got[139]["priority_score"] == 65.63  # 35 + 15.625 + 5 + 10, halves away from zero


def priority_frame(spark, entries):
    data = [(i, s, day(n), sev, float(p), h) for i, s, n, sev, p, h in entries]
    return spark.createDataFrame(data, "flag_id long, seller_id long, flag_date date, severity string, priority_score double, sla_hours int")


def test_one_ticket_per_seller_and_day(spark):
    got = rows(
        build_tickets(
            priority_frame(
                spark,
                [(1, 1, 0, "High", 50, 72), (2, 1, 0, "Critical", 70, 24), (3, 1, 0, "High", 70, 72), (4, 1, 0, "Low", 99, 240), (5, 1, 1, "High", 10, 72)],
            )
        ),
        "case_id",
    )
    assert [(r["case_id"], r["primary_flag_id"], r["related_flag_ids"], r["severity"]) for r in got] == [
        (1, 2, [3, 1], "Critical"),
        (2, 5, [], "High"),
    ]
    assert got[0]["sla_deadline"] - datetime.combine(got[0]["detected_date"], datetime.min.time()) == timedelta(hours=24)
    assert all(r["status"] == "New" and not r["is_sla_breached"] and r["assigned_investigator"] is None for r in got)


def test_updates_take_the_latest_and_set_the_resolution_time(spark):
    tickets = build_tickets(priority_frame(spark, [(i, i, 0, "High", 50, 72) for i in range(1, 5)]))
    at = lambda h: datetime(2026, 1, 1) + timedelta(hours=h)
    updates = spark.createDataFrame(
        [
            (1, "Investigating", None, "looking", None, "A", at(1)),
            (1, "Resolved", "Logistics", None, "done", "B", at(80)),
            (2, "Resolved", "Pricing", None, "done", None, at(5)),
            (2, "Investigating", None, "again", None, None, at(6)),
            (3, "Escalated", None, None, None, None, at(2)),
        ],
        UPDATE_SCHEMA,
    )
    got = {r["case_id"]: r for r in rows(apply_updates(tickets, updates))}
    assert (got[1]["status"], got[1]["root_cause_category"], got[1]["resolved_at"], got[1]["assigned_investigator"]) == ("Resolved", "Logistics", at(80), "B")
    assert (got[2]["status"], got[2]["notes"], got[2]["resolved_at"]) == ("Investigating", "again", None)
    assert got[3]["resolved_at"] == at(2) and got[4]["status"] == "New" and got[4]["updated_at"] == at(0)
    assert len(got) == 4


def test_breach_rules(spark):
    def ticket(case, status, resolved, breached=False):
        return (case, status, datetime(2026, 1, 10), resolved, breached)

    data = [
        ticket(1, "New", None),
        ticket(2, "Resolved", datetime(2026, 1, 11)),
        ticket(3, "Resolved", datetime(2026, 1, 9)),
        ticket(4, "Escalated", datetime(2026, 1, 9)),
        ticket(5, "Resolved", datetime(2026, 1, 9), True),
        ticket(6, "Resolved", None),
    ]
    frame = spark.createDataFrame(data, "case_id long, status string, sla_deadline timestamp_ntz, resolved_at timestamp_ntz, is_sla_breached boolean")
    late = F.lit(datetime(2026, 1, 20)).cast("timestamp_ntz")
    early = F.lit(datetime(2026, 1, 5)).cast("timestamp_ntz")
    assert [r["is_sla_breached"] for r in rows(mark_breaches(frame, late), "case_id")] == [True, True, False, True, True, False]
    assert [r["is_sla_breached"] for r in rows(mark_breaches(frame, early), "case_id")] == [False, True, False, False, True, False]
    assert rows(sla_summary(mark_breaches(frame, late)))[0] == {"status": "Resolved", "n_tickets": 4, "n_breached": 2, "pct_breached": 50.0}
