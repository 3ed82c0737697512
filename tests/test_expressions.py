"""Bands, rounding, quartiles, ranks, ids and salted joins."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketvane.functions.numeric import half_up, quartile
from marketvane.functions.scale import dense_ids, quantiles, rank_table, salted_join, with_rank
from marketvane.registry import HEALTH_WEIGHTS, PRIORITY_WEIGHTS, health_tier, is_open, is_unresolved, severity
from tests.helpers import day, rows


@pytest.mark.parametrize("weights", [HEALTH_WEIGHTS, PRIORITY_WEIGHTS])
def test_weights_sum_to_one(weights):
    assert sum(weights.values()) == pytest.approx(1)


def _labels(spark, function, values):
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    return [r["x"] for r in rows(frame.select("i", function(F.col("v")).alias("x")), "i")]


def test_severity_bounds_are_inclusive(spark):
    got = _labels(spark, severity, [0.5, 2.4999, 2.5, 3.999, 4.0, 5.999, 6.0, 10.0])
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High", "Critical", "Critical"]


def test_health_tier_bounds(spark):
    got = _labels(spark, health_tier, [100, 80, 79.9, 60, 40, 39.99, 0])
    assert got == ["Healthy", "Healthy", "Watch", "Watch", "At_Risk", "Critical", "Critical"]


def test_half_up_ignores_binary_noise(spark):
    got = _labels(spark, lambda c: half_up(c, 2), [2.675, 1.005, 16668.274999999998, -0.125, 0.1 + 0.2])
    assert got == [2.68, 1.01, 16668.28, -0.13, 0.3]


def test_two_meanings_of_open(spark):
    frame = spark.createDataFrame([("New",), ("Escalated",), ("Resolved",), ("False_Positive",)], "s string")
    got = {r["s"]: (r["o"], r["u"]) for r in rows(frame.select("s", is_open(F.col("s")).alias("o"), is_unresolved(F.col("s")).alias("u")))}
    assert got == {
        "New": (True, True),
        "Escalated": (False, True),
        "Resolved": (False, False),
        "False_Positive": (False, False),
    }


def test_quartiles_equal_linear_interpolation(spark):
    rng = random.Random(3)
    samples = [sorted(float(rng.randint(0, 50)) for _ in range(n)) for n in range(1, 29)]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, a array<double>")
    got = rows(frame.select("i", quartile(F.col("a"), 1).alias("q1"), quartile(F.col("a"), 3).alias("q3")), "i")
    for r, s in zip(got, samples):
        assert (r["q1"], r["q3"]) == (np.quantile(s, 0.25), np.quantile(s, 0.75))


@pytest.mark.parametrize("values", [[10, 50, 5, 100, 25], [1, 2, 2, 5], [0.0] * 40 + [3.5, -2.0, 1e9, 0.01, -2.0]])
def test_percent_rank_shares_ties(spark, values):
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double")
    got = rows(with_rank(frame, rank_table(frame, "v"), "v", "pct", ["i"]), "i")
    want = pd.Series(values, dtype=float).rank(pct=True) * 100
    assert [r["pct"] for r in got] == pytest.approx(list(want))


def test_dense_ids_follow_the_order_and_partitioning_does_not_matter(spark):
    rng = random.Random(1)
    data = [(day(rng.randint(0, 5)), rng.randint(0, 2000), i) for i in range(500)]
    frame = spark.createDataFrame(data, "d date, s long, k long")
    order = (F.col("d"), F.pmod("s", F.lit(256)))
    a = rows(dense_ids(frame.repartition(7), "id", *order, ["s", "k"]), "id")
    b = rows(dense_ids(frame.coalesce(1), "id", *order, ["s", "k"]), "id")
    assert a == b
    assert [r["id"] for r in a] == list(range(1, 501))
    keys = [(r["d"], r["s"] % 256, r["s"], r["k"]) for r in a]
    assert keys == sorted(keys)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_join_with_a_hot_key(spark, how):
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = salted_join(left, right, ["k"], ["id"], how).select("id", "k", "v")
    want = left.join(right, "k", how).select("id", "k", "v")
    assert rows(got, "id") == rows(want, "id")


def test_quantiles_equal_the_builtin_percentile(spark):
    dice = random.Random(11)
    data = [
        (
            0.0 if dice.random() < 0.4 else round(dice.random(), 4),
            dice.choice([None, -3.5, -0.25, 0.0, 7.0, 1e6]),
            None,
            dice.choice([1.0, 2.0]) if n == 5 else 1.0,
        )
        for n in range(997)
    ]
    frame = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(5)
    for share in (0.0, 0.5, 0.95, 1.0):
        got = quantiles(frame, ("a", "b", "c", "d"), share).first()
        want = frame.agg(*[F.percentile(x, F.lit(share)).alias(x) for x in "abcd"], *[F.max(x).alias(f"{x}_top") for x in "abcd"]).first()
        assert {x: tuple(got[x]) for x in "abcd"} == {x: (want[x], want[f"{x}_top"]) for x in "abcd"}


def test_quantiles_of_nothing_and_of_one_row(spark):
    empty = spark.createDataFrame([], "a double")
    assert tuple(quantiles(empty, ("a",), 0.95).first()["a"]) == (None, None)
    one = spark.createDataFrame([(2.5,)], "a double")
    assert tuple(quantiles(one, ("a",), 0.95).first()["a"]) == (2.5, 2.5)
