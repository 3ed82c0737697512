"""What a run is told: its moment, its methods, its input."""

import pytest
from pyspark.sql import functions as F

from marketvane.__main__ import main
from marketvane.operators.quality import DataQualityError
from marketvane.plans.catalog import warehouse
from marketvane.plans.pipeline import DATED, Warehouse, run
from marketvane.sources.tables import Table
from marketvane.workspace import Workspace

FOLDER = "/root/testdata/sf0.001"


def fresh(spark, tmp_path, name, **more):
    return Warehouse(warehouse(spark, FOLDER).star, Workspace(spark, str(tmp_path / name)), **more)


def test_an_order_of_the_future_stops_the_run_before_the_spine(spark, tmp_path):
    star = warehouse(spark, FOLDER).star
    orders = star["fact_orders"]
    planted = orders.limit(1).withColumn("order_date", F.lit("2999-01-01").cast("date")).select(*orders.columns)
    late = Warehouse({**star, "fact_orders": orders.unionByName(planted)}, Workspace(spark, str(tmp_path / "late")), ("IQR",))
    with pytest.raises(DataQualityError, match="future_dated_orders"):
        run(late)
    assert not (tmp_path / "late").exists()


def test_the_registered_load_moment_lies_inside_the_data(spark):
    w = warehouse(spark, FOLDER)
    found = {r["check"]: r["violations"] for r in w.dq_report().collect()}
    assert 0 < found["future_dated_orders"] < w.star["fact_orders"].count()


def test_warehouses_may_share_a_workspace(spark, tmp_path):
    star, shared = warehouse(spark, FOLDER).star, Workspace(spark, str(tmp_path / "shared"))
    for k, methods in enumerate((("ZScore", "IQR"), ("IQR", "CUSUM"))):
        own = fresh(spark, tmp_path, f"own{k}", methods=methods).flags.drop("created_at")
        got = Warehouse(star, shared, methods).flags.drop("created_at")
        assert got.exceptAll(own).count() == own.exceptAll(got).count() == 0
        assert {r[0] for r in got.select("method").distinct().collect()} >= set(methods[1:])
    moments = [F.lit(t).cast("timestamp_ntz") for t in ("2020-10-01 00:00:00", "2021-06-01 00:00:00")]
    stored = {Warehouse(star, shared, ("IQR", "CUSUM"), judged_at=m).tickets.inputFiles()[0].rsplit("/", 1)[0] for m in moments}
    assert len(stored) == 2  # the moment tickets are judged at has a table of its own


def test_the_command_writes_every_table_and_takes_updates(spark, tmp_path):
    for name, frame in warehouse(spark, FOLDER).star.items():
        frame.write.parquet(str(tmp_path / "in" / name))
    moment = F.lit("2021-06-01 00:00:00").cast("timestamp_ntz")
    schema = "case_id long, status string, root_cause string, notes string, resolution string, assigned_investigator string"
    done = spark.createDataFrame([(1, "Resolved", "Pricing", None, "done", "A")], schema).withColumn("updated_at", moment)
    done.write.parquet(str(tmp_path / "updates"))
    (tmp_path / "out").mkdir()
    old = spark.createDataFrame([("total_orders", -1), ("kept", 7)], "metric_name string, metric_value long")
    Table(spark, str(tmp_path / "out" / "dataset_summary")).replace(old.withColumn("computed_at", moment))
    call = [str(tmp_path / "in"), str(tmp_path / "out"), "--format", "parquet", "--methods", "IQR", "CUSUM", "--as-of", "2021-06-01 00:00:00"]
    call += ["--updates", str(tmp_path / "updates"), "--skip-quality-gate"]
    main([*call, "--extract", str(tmp_path / "extract"), "--csv", str(tmp_path / "csv")])

    def table(name):
        return Table(spark, str(tmp_path / "out" / name), DATED.get(name)).read()

    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert written >= {"dq_report", "sla_summary", "recall_by_type", "precision_by_severity", "seller_confusion", "business_impact"}
    cases = table("investigation_tickets")
    assert cases.where("case_id = 1").select("status", "resolution").collect() == [("Resolved", "done")]
    assert cases.where("status = 'New' AND NOT is_sla_breached").count() == 0  # judged long after every deadline
    counts = {r[0]: r[1] for r in table("dataset_summary").collect()}
    assert counts["kept"] == 7 and counts["total_orders"] > 0 and len(counts) == 8
    assert (tmp_path / "extract" / "seller_metric_cohort_baseline").exists()
    health = spark.read.option("header", True).csv(str(tmp_path / "csv" / "seller_health_score"))
    assert health.count() == table("seller_health_score").count() and set(health.columns) == set(table("seller_health_score").columns)

    # the same run for one month rewrites that month alone
    def files(name):
        return {str(p) for p in (tmp_path / "out" / name / "data").rglob("*.parquet")}

    before = {name: files(name) for name in DATED}
    rows = {name: table(name).count() for name in DATED}
    main([*call, "--months", "2020-08"])
    for name in DATED:
        assert {p.split("part_month=")[1][:7] for p in files(name) ^ before[name]} == {"2020-08"}
        assert table(name).count() == rows[name]


def test_the_key_report_leaves_no_shuffle_to_its_reader(spark):
    """Each table's checks are stored one after another; in one plan the shuffles of all would be on disk together."""
    plan = warehouse(spark, FOLDER).key_report()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan parquet" in plan
