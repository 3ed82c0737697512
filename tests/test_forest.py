"""The isolation forest: planted outliers, flagged share, repeatability, and scores against plain walks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketvane.operators import forest
from tests.helpers import day, rows


@pytest.fixture(scope="module")
def readings(spark):
    rng = np.random.default_rng(0)
    data = []
    for seller in range(1, 13):
        cohort = "A|Micro" if seller <= 8 else "B|Power"
        for n in range(100):
            point = rng.normal(10 if cohort[0] == "A" else 1000, 1, len(forest.FEATURES))
            if n == 50 and seller in (3, 11):
                point = point * 3
            data.append((seller, day(n), cohort, *map(float, point)))
    data += [(99, day(n), "tiny|Micro", *([1.0] * len(forest.FEATURES))) for n in range(50)]
    columns = "seller_id long, metric_date date, cohort string, " + ", ".join(f"{c} double" for c in forest.FEATURES)
    return spark.createDataFrame(data, columns).repartition(5).cache()


@pytest.fixture(scope="module")
def model(readings):
    return forest.fit(readings).cache()


@pytest.fixture(scope="module")
def scored(readings, model):
    return forest.score(readings, model).cache()


def test_planted_outliers_rank_on_top_of_their_cohort(scored):
    for cohort, seller in (("A|Micro", 3), ("B|Power", 11)):
        best = scored.where(F.col("cohort") == cohort).orderBy(F.desc("raw_score")).first()
        assert (best["seller_id"], best["metric_date"]) == (seller, day(50))


def test_small_cohorts_have_no_forest(scored):
    assert {r["cohort"] for r in scored.select("cohort").distinct().collect()} == {"A|Micro", "B|Power"}
    assert scored.count() == 1200


def test_flags(readings, scored):
    flags = rows(forest.forest_flags(readings, scored))
    assert 0.02 * 1200 <= len(flags) <= 0.032 * 1200
    assert max(f["anomaly_score"] for f in flags) == pytest.approx(10, abs=1e-3) and min(f["anomaly_score"] for f in flags) == 0
    assert {f["anomaly_type"] for f in flags} == {"Multi_Metric_Deterioration"}
    planted = [f for f in flags if f["seller_id"] == 3 and f["flag_date"] == day(50)][0]
    mine = readings.where("seller_id = 3").toPandas().sort_values("metric_date")
    z = ((mine[list(forest.FEATURES)] - mine[list(forest.FEATURES)].median()) / mine[list(forest.FEATURES)].std()).abs().iloc[50]
    assert planted["affected_metric"] == z.idxmax() and f"(z={z.max():.2f})" in planted["explanation"]


def test_partitioning_and_chunks_do_not_change_scores(readings, scored):
    moved = readings.orderBy(F.rand(3)).repartition(2)
    again = forest.score(moved, forest.fit(moved), chunk_rows=70)
    assert rows(again, "seller_id", "metric_date") == rows(scored, "seller_id", "metric_date")


def test_model_has_one_row_a_tree(model):
    got = rows(model.select("cohort", "tree", F.size("feature").alias("f"), F.size("threshold").alias("t"), F.size("path").alias("p")))
    assert {(r["cohort"], r["tree"]) for r in got} == {(c, t) for c in ("A|Micro", "B|Power") for t in range(forest.N_TREES)}
    assert {(r["f"], r["t"], r["p"]) for r in got} == {(255, 255, 511)}


def test_samples_are_bounded_and_without_repeats(readings):
    drawn = forest.samples(readings, forest.cohort_sizes(readings), 42).groupBy("cohort", "tree").agg(
        F.count("*").alias("n"), F.count_distinct("seller_id", "metric_date").alias("d"), F.max("draw").alias("most")
    )
    got = rows(drawn)
    assert len(got) == 2 * forest.N_TREES
    assert all(r["n"] == r["d"] and 256 <= r["n"] <= 500 and r["most"] < forest.DRAWS for r in got)


def test_every_row_is_drawn_by_some_tree_and_trees_differ(readings):
    sample = forest.samples(readings, forest.cohort_sizes(readings), 42)
    assert sample.where("cohort = 'A|Micro'").select("seller_id", "metric_date").distinct().count() == 800
    sets = sample.where("cohort = 'A|Micro' AND tree < 2").groupBy("tree").agg(F.collect_set(F.struct("seller_id", "metric_date")).alias("s")).collect()
    assert set(sets[0]["s"]) != set(sets[1]["s"])


def test_scores_equal_a_walk_through_the_nodes():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(60, 3))
    trees = [forest.grow_tree(points[rng.permutation(60)[:30]], f"test|{i}") for i in range(forest.N_TREES)]
    got = forest.path_score(points, *(np.stack(x) for x in zip(*trees)), 30)
    for point, score in zip(points, got):
        lengths = []
        for feature, threshold, path in trees:
            at = 0
            while at < len(feature) and np.isfinite(threshold[at]):
                at = 2 * at + (2 if point[feature[at]] > threshold[at] else 1)
            lengths.append(path[at] * forest.PATH_UNIT)
        assert score == pytest.approx(2 ** (-np.mean(lengths) / float(forest.average_path(30))), abs=1e-6)


def test_tree_keeps_its_rows_and_its_bounds():
    rng = np.random.default_rng(2)
    points = np.round(rng.normal(size=(256, 4)), 1)
    feature, threshold, path = forest.grow_tree(points, "x")
    at = np.zeros(256, dtype=int)
    depth = np.zeros(256, dtype=int)
    for _ in range(forest.MAX_DEPTH):
        split = np.isfinite(threshold[at])
        depth += split
        at = 2 * at + 1 + (points[np.arange(256), feature[at]] > threshold[at])
    for leaf in np.unique(at):
        inside = at == leaf
        want = depth[inside][0] + float(forest.average_path(inside.sum()))
        assert path[leaf] * forest.PATH_UNIT == pytest.approx(want, abs=1e-6)


def test_rows_alike_make_one_leaf():
    feature, threshold, path = forest.grow_tree(np.ones((40, 2)), "x")
    assert np.isinf(threshold).all() and path[0] == path[2**forest.MAX_DEPTH - 1] == round(float(forest.average_path(40)) * 1e6)


def test_cut_is_the_lower_order_statistic(spark):
    data = [(1, day(n), "c", round(0.001 * (n % 50), 6)) for n in range(1000)]
    scored = spark.createDataFrame(data, "seller_id long, metric_date date, cohort string, raw_score double")
    values = sorted(d[3] for d in data)
    for share in (0.03, 0.1, 0.5):
        got = forest.score_cuts(scored, share).first()["cut"]
        assert got == values[int((len(values) - 1) * (1 - share) + 1e-9)]
        assert sum(v > got for v in values) == sum(v > np.quantile(values, 1 - share) + 1e-12 for v in values)


def test_no_large_cohort_gives_no_scores(readings):
    few = readings.where("seller_id = 99")
    assert forest.score(few, forest.fit(few)).count() == 0


def test_average_path():
    assert forest.average_path(1) == 0 and forest.average_path(2) == 1
    assert float(forest.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_draws_equal_a_plain_loop_and_are_compiled(readings):
    found = forest.samples(readings, forest.cohort_sizes(readings), 42)
    assert "lambdafunction" not in found._jdf.queryExecution().optimizedPlan().toString()
    sizes = {"A|Micro": 800, "B|Power": 400}
    trees = [forest.digits(f"42|{t}") for t in range(forest.N_TREES)]
    want = set()
    for r in readings.where("seller_id IN (1, 9)").select("cohort", "seller_id", "metric_date").collect():
        first, second, _ = forest.digits(f"{r['seller_id']}|{r['metric_date']}")
        most = min(forest.DRAWS, int(forest.SAMPLE_SIZE * forest.OVERDRAW) * forest.DRAWS // sizes[r["cohort"]])
        for t, (a, b, c) in enumerate(trees):
            draw = (first * a + second * b + c % forest.DRAWS) % forest.DRAWS
            if draw < most:
                want.add((r["seller_id"], r["metric_date"], t, draw))
    got = found.where("seller_id IN (1, 9)").select("seller_id", "metric_date", "tree", "draw").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
