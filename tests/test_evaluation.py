"""Evaluation and impact against plain loops."""

import random

import pytest

from marketvane.operators.evaluation import evaluate_methods, precision_by_severity, recall_by_type, seller_confusion
from marketvane.operators.impact import business_impact
from marketvane.registry import ANOMALY_TYPES, MULTI_METRIC
from tests.helpers import DAY0, day, episodes_frame, flags_frame, rows, spine_frame

METHODS = ("ZScore", "IQR", "Ensemble")


def matches(a, b):
    return a == b or MULTI_METRIC in (a, b)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(11)
    episodes = []
    for i in range(1, 41):
        start = rng.randint(0, 50)
        episodes.append((i, rng.randint(1, 12), rng.choice(ANOMALY_TYPES), start, start + rng.randint(0, 15)))
    episodes += [(100 + i, 3, "Defect_Rate_Rise", 10, 20) for i in range(30)]
    flags = {(rng.randint(1, 20), rng.randint(0, 60), rng.choice(ANOMALY_TYPES), rng.choice(METHODS[:2])) for _ in range(600)}
    return episodes, sorted(flags)


def test_methods_equal_the_loops(spark, labelled):
    episodes, flags = labelled
    got = {r["method"]: r for r in rows(evaluate_methods(flags_frame(spark, flags), episodes_frame(spark, episodes), METHODS))}
    for method in METHODS:
        mine = [f for f in flags if f[3] == method]
        delays, hits = [], 0
        for _, seller, kind, a, b in episodes:
            days = [f[1] for f in mine if f[0] == seller and a <= f[1] <= b and matches(f[2], kind)]
            hits += bool(days)
            delays += [min(days) - a] if days else []
        true = sum(any(s == f[0] and a <= f[1] <= b and matches(f[2], k) for _, s, k, a, b in episodes) for f in mine)
        r = got[method]
        precision = true / len(mine) if mine else 0
        assert r["n_flags"] == len(mine) and r["n_ground_truth_episodes"] == len(episodes)
        assert r["recall"] == pytest.approx(hits / len(episodes), abs=1e-4) and r["precision"] == pytest.approx(precision, abs=1e-4)
        assert r["false_positive_rate"] == pytest.approx(1 - precision if mine else 0, abs=1e-4)
        if delays:
            assert r["mean_detection_delay_days"] == pytest.approx(sum(delays) / len(delays), abs=0.01)
        else:
            assert r["mean_detection_delay_days"] is None


def test_recall_by_type_lists_every_method(spark, labelled):
    episodes, flags = labelled
    got = rows(recall_by_type(flags_frame(spark, flags), episodes_frame(spark, episodes), METHODS))
    kinds = {e[2] for e in episodes}
    assert {(r["method"], r["anomaly_type"]) for r in got} == {(m, k) for m in METHODS for k in kinds}
    assert all(r["recall"] == 0 for r in got if r["method"] == "Ensemble")
    assert sum(r["n_episodes"] for r in got) == len(METHODS) * len(episodes)


def test_confusion_equals_the_sets(spark, labelled):
    episodes, flags = labelled
    got = {r["method"]: r for r in rows(seller_confusion(flags_frame(spark, flags), episodes_frame(spark, episodes), METHODS))}
    truth, everyone = {e[1] for e in episodes}, {f[0] for f in flags} | {e[1] for e in episodes}
    for method in METHODS:
        flagged = {f[0] for f in flags if f[3] == method}
        want = (len(flagged & truth), len(flagged - truth), len(truth - flagged), len(everyone - flagged - truth))
        r = got[method]
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == want


def test_all_severities_are_listed(spark):
    flags = flags_frame(spark, [(1, 5, "Price_Anomaly", "Ensemble", 9), (1, 6, "Defect_Rate_Rise", "Ensemble", 9)])
    got = rows(precision_by_severity(flags, episodes_frame(spark, [(1, 1, "Price_Anomaly", 5, 9)])))
    assert [(r["severity"], r["n_flags"], r["precision"]) for r in got] == [
        ("Low", 0, 0.0),
        ("Medium", 0, 0.0),
        ("High", 0, 0.0),
        ("Critical", 2, 0.5),
    ]


def test_a_match_needs_the_type_and_the_window(spark):
    flags = flags_frame(spark, [(1, 4, "Price_Anomaly", "IQR"), (1, 10, "Price_Anomaly", "IQR"), (1, 6, "Rating_Manipulation", "IQR"), (2, 6, "Price_Anomaly", "IQR")])
    got = rows(evaluate_methods(flags, episodes_frame(spark, [(1, 1, "Price_Anomaly", 5, 9)]), ("IQR",)))[0]
    assert (got["recall"], got["precision"], got["f1"]) == (0, 0, 0)


def test_impact_equals_the_pairs(spark):
    rng = random.Random(7)
    kinds = ("Defect_Rate_Rise", "Price_Anomaly")
    episodes = [(i, rng.randint(1, 5), rng.choice(kinds), s := rng.randint(0, 40), s + 9) for i in range(40)]
    episodes += [(100 + i, 2, kinds[0], 12, 20) for i in range(20)]
    cases = [(c, rng.randint(1, 6), rng.randint(0, 55), rng.choice(kinds), rng.choice(["Resolved", "Escalated", "New"])) for c in range(1, 120)]
    volumes = {s: [rng.randint(0, 20) for _ in range(30)] for s in range(1, 6)}
    spine = spine_frame(spark, volumes)
    tickets = spark.createDataFrame(
        [(c, s, c, day(n), status) for c, s, n, _, status in cases],
        "case_id long, seller_id long, primary_flag_id long, detected_date date, status string",
    )
    flags = spark.createDataFrame([(c, k) for c, _, _, k, _ in cases], "flag_id long, anomaly_type string")
    got = rows(business_impact(tickets, flags, spine, episodes_frame(spark, episodes)))[0]
    closed = [c for c in cases if c[4] != "New"]
    pairs = [(c, e) for c in closed for e in episodes if e[1] == c[1] and e[2] == c[3] and e[3] <= c[2]]
    saved = [max(0, 10 - (c[2] - e[3])) for c, e in pairs]
    mean = {s: sum(v) / len(v) for s, v in volumes.items()}
    orders = sum(int(d * mean.get(c[1], 0) + 0.5) for d, (c, e) in zip(saved, pairs))
    assert got["n_cases"] == len(pairs) and got["n_all_resolved_tickets"] == len(closed)
    assert got["mean_days_saved"] == pytest.approx(sum(saved) / len(pairs), abs=0.051)
    assert got["total_orders_protected"] == orders and got["total_defect_cost_avoided_usd"] == 8 * orders
    assert got["investigation_hours_saved"] == 3 * len(pairs) and got["investigation_cost_saved_usd"] == 135 * len(pairs)
    assert DAY0 == day(0)
