"""Facts stored in buckets of the line key, and key checks counted from one grouping."""

import random

from pyspark.sql import functions as F

from marketvane.operators import quality, spine
from marketvane.workspace import Workspace
from tests.helpers import day, rows

LINE = "order_line_id"


def stored(spark, tmp_path, data):
    """Lines (key, seller, day, returned) with a struct as their key, stored in buckets."""
    frame = spark.createDataFrame(data, "a long, b int, seller_id long, n int, is_returned boolean")
    lines = frame.select(
        F.struct("a", "b").alias(LINE),
        "seller_id",
        F.date_add(F.lit(day(0)), "n").alias("order_date"),
        "is_returned",
        (F.col("b") == 1).alias("is_defect_related"),
        F.lit(2).cast("decimal(12,2)").alias("refund_amount"),
    )
    table = Workspace(spark, str(tmp_path / "run")).bucketed("lines", lambda: lines, LINE)
    return table, table.where("is_returned")


def drawn(n=400):
    """Lines of which some keys repeat, one of them in a third of the rows."""
    dice = random.Random(7)
    keys = [(0, 0) if dice.random() < 0.33 else (dice.randrange(150), dice.randrange(3)) for _ in range(n)]
    return [(a, b, dice.randrange(5), dice.randrange(9), dice.random() < 0.3) for a, b in keys]


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_line_joins_and_line_checks_need_no_exchange(spark, tmp_path):
    lines, returned = stored(spark, tmp_path, drawn())
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = executed(spine.returns_by_order_day(lines, returned, bucketed=True))
        copies = executed(quality._copies((lines, LINE), (returned, LINE)))
        apart = executed(spine.returns_by_order_day(lines, returned))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "SortMergeJoin" in joined or "ShuffledHashJoin" in joined
    assert "Exchange" not in joined and "Exchange" not in copies
    assert apart.count("Exchange") >= 2


def test_bucketed_returns_equal_a_plain_loop(spark, tmp_path):
    data = drawn()
    lines, returned = stored(spark, tmp_path, data)
    per_line = {}
    for a, b, _, _, back in data:
        if back:
            per_line[a, b] = per_line.get((a, b), 0) + 1
    want = sorted((s, day(n), per_line[a, b], per_line[a, b] * (b == 1), 2 * per_line[a, b]) for a, b, s, n, _ in data if (a, b) in per_line)
    for way in (True, False):
        found = spine.returns_by_order_day(lines, returned, bucketed=way).collect()
        assert sorted((r[0], r[1], r[2], r[3], int(r[4])) for r in found) == want


def test_a_second_workspace_on_the_same_folder_makes_its_own_table(spark, tmp_path):
    first, _ = stored(spark, tmp_path, drawn(40))
    second, _ = stored(spark, tmp_path, drawn(60))
    assert (first.count(), second.count()) == (40, 60)


def test_an_empty_table_can_be_bucketed(spark, tmp_path):
    lines, returned = stored(spark, tmp_path, [])
    assert spine.returns_by_order_day(lines, returned, bucketed=True).count() == 0
    assert quality._copies((lines, LINE), (returned, LINE)).count() == 0


def test_stacked_counts_equal_plain_loops(spark):
    dice = random.Random(3)
    tables = [[dice.choice([None, 1, 1, 1, *range(2, 2 + width)]) for _ in range(200)] for width in (20, 30, 40)]
    frames = [(spark.createDataFrame([(k,) for k in t], f"k{i} long"), f"k{i}") for i, t in enumerate(tables)]
    copies = quality._copies(*frames)
    want = {k: tuple(t.count(k) for t in tables) for t in tables for k in t}
    assert {r["key"]: (r["n0"], r["n1"], r["n2"]) for r in rows(copies)} == want
    rules = {"twice": quality._repeated("n0"), "lost": quality._lost("n1", "n0"), "lost_2": quality._lost("n2", "n1")}
    got = {r["check"]: r["violations"] for r in rows(quality._counted(copies, rules))}
    first, second, third = tables
    assert got == {
        "twice": sum(first.count(k) > 1 for k in set(first)),
        "lost": sum(k is None or k not in first for k in second),
        "lost_2": sum(k is None or k not in second for k in third),
    }


def test_checks_of_empty_tables_count_nothing(spark):
    empty = spark.createDataFrame([], "k long")
    rules = {"twice": quality._repeated("n0"), "lost": quality._lost("n1", "n0")}
    got = rows(quality._counted(quality._copies((empty, "k"), (empty, "k")), rules))
    assert {r["check"]: r["violations"] for r in got} == {"twice": 0, "lost": 0}
