"""Versioned tables: replaced whole or by month, never seen half."""

import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from marketvane.sources.tables import RELEASE, Table
from marketvane.workspace import Workspace
from tests.helpers import rows


def readings(spark, factor=1, months=range(1, 7), days=(1, 15, 28)):
    data = [(s, date(2020, m, d), factor * (100 * m + d)) for m in months for d in days for s in (1, 2)]
    return spark.createDataFrame(data, "seller_id long, day date, value long")


def files_of(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_replace_and_read(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "day")
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    frame = readings(spark)
    table.replace(frame, sort_by="day")
    assert table.read().schema == frame.schema
    assert rows(table.read(), "day", "seller_id") == rows(frame, "day", "seller_id")
    table.replace(readings(spark, 2, (2, 3)))
    assert rows(table.read(), "day", "seller_id") == rows(readings(spark, 2, (2, 3)), "day", "seller_id")


def test_one_month_again_rewrites_only_it(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "day")
    table.replace(readings(spark))
    before = files_of(tmp_path / "t" / "data")
    table.replace(readings(spark, 7), months=["2020-03"])
    after = files_of(tmp_path / "t" / "data")
    assert before.items() <= after.items()  # no file is touched
    assert {p.split("part_month=")[1][:7] for p in after.keys() - before.keys()} == {"2020-03"}
    got = {(r["day"].month): r["value"] // (100 * r["day"].month + r["day"].day) for r in table.read().collect()}
    assert got == {1: 1, 2: 1, 3: 7, 4: 1, 5: 1, 6: 1} and table.read().count() == 36
    table.replace(readings(spark).where("day < '2020-06-01'"), months=["2020-06"])
    assert table.read().agg(F.max("day")).first()[0] == date(2020, 5, 28)


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    for name, dated in (("a", "day"), ("b", None)):
        table = Table(spark, str(tmp_path / name), dated)
        table.replace(readings(spark))
        before = rows(table.read(), "day", "seller_id")
        bad = readings(spark, 3).repartition(6).withColumn("value", F.expr("if(value > 1500, raise_error('lost'), value)"))
        with pytest.raises(Exception, match="lost"):
            table.replace(bad)
        assert rows(table.read(), "day", "seller_id") == before
        # files of a lost run that were moved into place, but never committed
        readings(spark, 9).withColumns({"part_month": F.date_format("day", "yyyy-MM"), "part_version": F.lit("lost")}).write.mode(
            "append"
        ).partitionBy(*(["part_month"] if dated else []), "part_version").parquet(str(tmp_path / name / "data"))
        assert rows(table.read(), "day", "seller_id") == before
        table.vacuum()
        assert not [p for p in files_of(tmp_path / name) if "lost" in p]
        assert rows(table.read(), "day", "seller_id") == before


def test_a_reader_goes_on_while_the_table_is_replaced_by_what_is_made_of_it(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "day")
    table.replace(readings(spark))
    reader, fixed = table.read(), table.snapshot()
    with pytest.raises(ValueError):
        fixed.replace(reader)
    table.replace(table.read().withColumn("value", F.col("value") + 1))
    assert fixed.read().agg(F.sum("value")).first() == reader.agg(F.sum("value")).first()
    assert reader.agg(F.sum("value")).first()[0] + 36 == table.read().agg(F.sum("value")).first()[0]


def plan_of(frame):
    return frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_days_are_read_from_their_months(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "day")
    table.replace(readings(spark))
    recent = table.last_days(30)
    assert {r["day"] for r in recent.collect()} == {date(2020, 6, d) for d in (1, 15, 28)}
    plan = plan_of(recent)
    assert "PartitionFilters: [isnotnull(part_month" in plan and "part_month#" in plan
    assert {r["day"] for r in table.on(F.lit("2020-02-15").cast("date")).collect()} == {date(2020, 2, 15)}
    # a file of an earlier month that can't be read is not opened
    for p in (tmp_path / "t" / "data" / "part_month=2020-01").rglob("*.parquet"):
        p.write_bytes(b"no parquet")
    assert table.last_days(30).count() == 6 and table.on(table.last_day()).count() == 2


def test_undated_rows_and_empty_tables(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "day")
    empty = readings(spark).limit(0)
    table.replace(empty)
    assert table.read().count() == 0 and table.read().schema == empty.schema
    table.replace(readings(spark).unionByName(spark.createDataFrame([(9, None, 1)], empty.schema)))
    assert table.read().count() == 37 and table.read().where("day IS NULL").count() == 1
    assert table.last_days(0).count() == 2
    with pytest.raises(ValueError):
        Table(spark, str(tmp_path / "t")).replace(empty)
    with pytest.raises(ValueError):
        Table(spark, str(tmp_path / "u")).replace(empty, months=["2020-01"])


def test_old_versions_go(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "day")
    for k in range(1, 5):
        table.replace(readings(spark, k, (1, 2)))
    many = len(files_of(tmp_path / "t"))
    table.vacuum(keep=1)
    assert len(files_of(tmp_path / "t")) * 4 == many and len(table.commits()) == 1
    assert rows(table.read(), "day", "seller_id") == rows(readings(spark, 4, (1, 2)), "day", "seller_id")
    table.replace(readings(spark, 5, (1,)))
    assert table.current()["number"] == 5


def shuffled(spark):
    """The shuffle blocks on disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(i).name() for i in range(blocks.size())]
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("kind", ["table", "dated", "bucketed"])
def test_what_a_stored_table_shuffled_goes_with_the_write(spark, tmp_path, kind):
    space = Workspace(spark, str(tmp_path))
    key = {"table": [], "dated": ["day"], "bucketed": ["seller_id"]}[kind]
    before, setting = shuffled(spark), spark.conf.get(RELEASE)
    stored = getattr(space, kind)("kept", lambda: readings(spark).groupBy("seller_id", "day").agg(F.sum("value").alias("value")), *key)
    until = time.time() + 10
    while shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled(spark) - before and spark.conf.get(RELEASE) == setting
    assert (stored.read() if kind == "dated" else stored).count() == 36
