"""Isolation forest per cohort: distributed sampling, tree building and scoring.

Published algorithm (Liu, Ting, Zhou 2008), with every draw taken from MD5 digests, so that any engine can grow the
same trees. Trees are grown from hash-chosen subsamples of at most 256 rows, one task group per (cohort, tree), so no
group grows with the data. The model is a table with one row a tree, packed as arrays. Rows meet it by cohort in chunks
of a bounded size, a copy of the cohort's trees with each chunk; nothing of it passes the driver.
"""

from __future__ import annotations

import sys
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, snap
from ..functions.scale import salted_join
from ..registry import MULTI_METRIC, severity

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Features in tie-break order, and the forest's parameters.
FEATURES = (
    "order_volume",
    "gmv",
    "defect_rate",
    "late_shipment_rate",
    "cancellation_rate",
    "return_rate",
    "refund_rate",
    "avg_rating",
    "review_velocity",
    "negative_review_rate",
    "price_volatility",
    "order_growth_rate_dod",
)
COHORT = ("tenure_cohort", "seller_segment")
N_TREES = 200
SAMPLE_SIZE = 256
MAX_DEPTH = 8
CONTAMINATION = 0.03
MIN_GROUP_ROWS = 200

# Rows scored by one task against a copy of their cohort's trees (under 1 MB).
CHUNK_ROWS = 20_000
# Share over the needed sample drawn before the exact cut (six deviations above it).
OVERDRAW = 1.5
# Draws are numbers below this prime.
DRAWS = 2**31 - 1
# Path lengths are held in whole units of this, so their sums don't depend on an order.
PATH_UNIT = 1e-6

TREE_SCHEMA = "cohort string, tree int, feature array<int>, threshold array<double>, path array<bigint>"


def features(members: DataFrame) -> DataFrame:
    """(seller_id, metric_date, cohort, features); a missing reading counts as 0."""
    cohort = F.concat_ws("|", *COHORT)
    return members.select(
        "seller_id",
        "metric_date",
        cohort.alias("cohort"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES],
    )


def average_path(n):
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype="float64")
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def digits(text: str) -> tuple[int, int, int]:
    """Three numbers of 28, 28 and 52 bits from the text's MD5."""
    digest = md5(text.encode()).hexdigest()
    return int(digest[:7], 16), int(digest[7:14], 16), int(digest[14:27], 16)


def draw_of(first: Column, second: Column, tree: Column | dict[str, Column]) -> Column:
    """A row's draw for a tree, from two numbers of the row and the tree's own (a linear hash modulo a prime)."""
    return (first * tree["a"] + second * tree["b"] + tree["c"]) % F.lit(DRAWS)


def tree_numbers(seed: int) -> Column:
    """The numbers by which each tree hashes rows, as one constant array."""
    rows = []
    for t in range(N_TREES):
        a, b, c = digits(f"{seed}|{t}")
        rows.append(F.struct(F.lit(t).alias("t"), *[F.lit(v).cast("bigint").alias(k) for k, v in (("a", a), ("b", b), ("c", c % DRAWS))]))
    return F.array(*rows)


def cohort_sizes(rows: DataFrame) -> DataFrame:
    """(cohort, n) of the cohorts that are large enough for a forest."""
    return rows.groupBy("cohort").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_GROUP_ROWS)


def samples(rows: DataFrame, sizes: DataFrame, seed: int) -> DataFrame:
    """Rows that a tree wants, with their draw: the SAMPLE_SIZE smallest draws of a (cohort, tree) are its sample.

    Every row of a cohort may be drawn, whatever the cohort's size. A row finds by its own hash the trees that want
    it, none for nearly all rows of a large cohort, and only the drawn rows are shuffled. Trees are laid out and left
    out again inside one compiled loop, where a filter over an array would be interpreted.
    """
    digest = F.md5(F.concat_ws("|", "seller_id", "metric_date"))
    first, second = (F.conv(F.substring("_md5", at, 7), 16, 10).cast("bigint") for at in (1, 8))
    most = F.least(F.lit(DRAWS), F.floor(F.lit(int(SAMPLE_SIZE * OVERDRAW) * DRAWS) / F.col("n"))).cast("bigint")
    keyed = salted_join(rows, sizes, ["cohort"], ["seller_id", "metric_date"]).withColumn("_md5", digest)
    keyed = keyed.withColumns({"_first": first, "_second": second, "_most": most})
    drawn = keyed.select("cohort", "seller_id", "metric_date", *FEATURES, "_first", "_second", "_most", F.inline(tree_numbers(seed)).alias("tree", "a", "b", "c"))
    draw = draw_of(F.col("_first"), F.col("_second"), {x: F.col(x) for x in "abc"})
    return drawn.withColumn("draw", draw).where(F.col("draw") < F.col("_most")).select("cohort", "seller_id", "metric_date", *FEATURES, "tree", "draw")


def grow_tree(points: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(split feature, threshold, path) by position in a complete tree; the children of p are 2p+1 and 2p+2.

    `name` is what the digests that draw feature and threshold of a node are made of. Below a leaf, and in a node
    without rows, the threshold is infinite: rows keep going left, and the leaf's path is repeated there, so all rows
    take the same number of steps.
    """
    inner = 2**MAX_DEPTH - 1
    feature = np.zeros(inner, dtype="int64")
    threshold = np.full(inner, np.inf)
    path = np.zeros(2 * inner + 1, dtype="int64")
    pending = [(0, points, 0)]
    while pending:
        at, rows, depth = pending.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        varied = np.flatnonzero(high > low)
        if depth >= MAX_DEPTH or len(varied) == 0:
            length = int(np.floor((depth + float(average_path(len(rows)))) / PATH_UNIT + 0.5))
            path[at] = length
            while at < inner:
                at = 2 * at + 1
                path[at] = length
            continue
        pick, _, fraction = digits(f"{name}|{at}")
        feature[at] = varied[pick % len(varied)]
        threshold[at] = low[feature[at]] + fraction / 2.0**52 * (high[feature[at]] - low[feature[at]])
        left = rows[:, feature[at]] <= threshold[at]
        pending.append((2 * at + 1, rows[left], depth + 1))
        pending.append((2 * at + 2, rows[~left], depth + 1))
    return feature, threshold, path


def fit(rows: DataFrame, seed: int = 42) -> DataFrame:
    """The model: one row a tree, for all large enough cohorts."""

    def build(key, group):
        cohort, tree = key
        sample = group.sort_values(["draw", "seller_id", "metric_date"]).head(SAMPLE_SIZE)
        packed = grow_tree(sample[list(FEATURES)].to_numpy("float64"), f"{seed}|{cohort}|{int(tree)}")
        return pd.DataFrame([(cohort, tree, *packed)], columns=["cohort", "tree", "feature", "threshold", "path"])

    return samples(rows, cohort_sizes(rows), seed).groupBy("cohort", "tree").applyInPandas(build, TREE_SCHEMA)


def path_score(points: np.ndarray, feature: np.ndarray, threshold: np.ndarray, path: np.ndarray, n: int) -> np.ndarray:
    """Anomaly score 2^(-mean path / average path of the sample size), in 0..1, to six decimals."""
    flat = np.ascontiguousarray(points).ravel()
    base = np.arange(len(points)) * points.shape[1]
    total = np.zeros(len(points), dtype="int64")
    for f, t, lengths in zip(feature, threshold, path):
        at = np.zeros(len(points), dtype="int64")
        for _ in range(MAX_DEPTH):
            right = flat.take(base + f.take(at)) > t.take(at)
            at = 2 * at + 1 + right
        total += lengths.take(at)
    mean = total / (len(feature) / PATH_UNIT)
    return np.floor(2.0 ** (-mean / float(average_path(min(n, SAMPLE_SIZE)))) * 1e6 + 0.5) / 1e6


def _stacked(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """A list column with lists of one length as a matrix."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def score(rows: DataFrame, model: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(seller_id, metric_date, cohort, raw_score to six decimals) of all rows of cohorts in the model.

    A cohort's rows are dealt by hash into chunks of about `chunk_rows`, however many it has, and each chunk meets a
    copy of its cohort's trees. Scoring is bound by computing, 1,600 steps a row.
    """
    sizes = cohort_sizes(rows).withColumn("chunks", F.ceil(F.col("n") / chunk_rows).cast("int"))

    def walked(points: pa.Table, trees: pa.Table) -> pa.Table:
        if not trees.num_rows or not points.num_rows:
            return points.select(["seller_id", "metric_date", "cohort"]).slice(0, 0).append_column("raw_score", pa.array([], pa.float64()))
        packed = [_stacked(trees.column(c), trees.num_rows) for c in ("feature", "threshold", "path")]
        values = np.stack([points.column(c).to_numpy() for c in FEATURES], axis=1)
        raw = path_score(values, *packed, points.column("n")[0].as_py())
        return points.select(["seller_id", "metric_date", "cohort"]).append_column("raw_score", pa.array(raw))

    dealt = salted_join(rows, sizes, ["cohort"], ["seller_id", "metric_date"])
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("seller_id", "metric_date"), F.col("chunks")).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    trees = model.join(sizes.select("cohort", "chunks"), "cohort").withColumn("chunk", copies).drop("chunks")
    schema = "seller_id bigint, metric_date date, cohort string, raw_score double"
    return dealt.drop("chunks").groupBy("cohort", "chunk").cogroup(trees.groupBy("cohort", "chunk")).applyInArrow(walked, schema)


def score_cuts(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Per cohort, the score above which a row is an outlier: its lower order statistic at 1 - contamination.

    Between two scores that occur, an interpolated quantile would part the rows alike. Scores have six decimals, so
    the running counts of a cohort go over at most a million values.
    """
    counted = scored.groupBy("cohort", "raw_score").agg(F.count("*").alias("n"))
    ordered = Window.partitionBy("cohort").orderBy("raw_score")
    upto = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    everyone = F.sum("n").over(Window.partitionBy("cohort"))
    share = F.lit(round((1 - contamination) * 1_000_000))
    place = F.floor((F.col("everyone") - 1) * share / F.lit(1_000_000))  # from 0
    ranked = counted.select("cohort", "raw_score", upto.alias("upto"), everyone.alias("everyone"))
    return ranked.where(F.col("upto") > place).groupBy("cohort").agg(F.min("raw_score").alias("cut"))


def top_features(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """Flagged rows with the feature farthest from the seller's own median, in the seller's deviations.

    Medians are taken over the history of flagged sellers only; a seller has one row per day.
    """
    history = rows.join(flagged.select("seller_id").distinct(), "seller_id", "left_semi")
    stats = history.groupBy("seller_id").agg(
        *[F.median(c).alias(f"_m_{c}") for c in FEATURES], *[F.stddev_samp(c).alias(f"_s_{c}") for c in FEATURES]
    )
    entries = []
    for i, c in enumerate(FEATURES):
        spread = F.col(f"_s_{c}")
        z = F.when(spread > 0, snap(F.abs(F.col(c) - F.col(f"_m_{c}")) / spread))
        entries.append(F.struct(F.coalesce(z, F.lit(0.0)).alias("z"), F.lit(-i).alias("o"), F.lit(c).alias("name")))
    readings = rows.drop("cohort").join(flagged, ["seller_id", "metric_date"])
    return readings.join(stats, "seller_id").select(*flagged.columns, F.array_max(F.array(*entries)).alias("top"))


def forest_flags(rows: DataFrame, scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Outlying seller-days as multi-metric flags, scored 0-10 over all flagged rows."""
    cuts = score_cuts(scored, contamination)
    flagged = salted_join(scored, cuts, ["cohort"], ["seller_id", "metric_date"])
    flagged = flagged.where(F.col("raw_score") > F.col("cut")).drop("cut")
    span = flagged.agg(F.struct(F.min("raw_score").alias("low"), F.max("raw_score").alias("high"))).scalar()
    described = top_features(rows, flagged).withColumn("_span", span)
    low, high = F.col("_span.low"), F.col("_span.high")
    out = described.withColumn(
        "anomaly_score", half_up((F.col("raw_score") - low) / (high - low + 1e-9) * 10, 4)
    )
    none = F.lit(None).cast("double")
    return out.select(
        "seller_id",
        F.col("metric_date").alias("flag_date"),
        F.lit(MULTI_METRIC).alias("anomaly_type"),
        F.col("top.name").alias("affected_metric"),
        none.alias("baseline_value"),
        none.alias("observed_value"),
        none.alias("deviation_abs"),
        none.alias("deviation_pct"),
        F.lit("IsolationForest").alias("method"),
        "anomaly_score",
        severity(F.col("anomaly_score")).alias("severity"),
        F.lit("isolation_forest_multivariate_outlier").alias("reason_code"),
        F.format_string(
            "The day's readings stand apart from the cohort (isolation %.2f of 10); "
            "%s is farthest from the seller's median (z=%.2f).",
            half_up(F.col("anomaly_score"), 2),
            F.col("top.name"),
            half_up(F.col("top.z"), 2),
        ).alias("explanation"),
    )
