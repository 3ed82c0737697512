"""Every registered query against its SQL restatement, on the plain and on skewed tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from marketvane.operators.quality import DataQualityError
from marketvane.plans.catalog import QUERIES, warehouse
from marketvane.operators.summary import upsert_summary
from marketvane.plans.pipeline import COPIED, Warehouse, export, run
from marketvane.sources.tables import Table
from marketvane.plans.reports import QUEUE_SORTS, filtered_queue, seller_360
from marketvane.workspace import Workspace
from tests.parity import TABLES, connect, differences, type_differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are absent")
#: The SQL of the training-data queries is compared in tests/llm.
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


def check(spark, db, folder, name):
    frame = QUERIES[name](spark, folder)
    want = db.sql(ORACLES[name])
    assert type_differences(frame.schema, zip(want.columns, want.types)) == ""
    assert differences(frame.toPandas(), want.df()) == ""


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    check(spark, connect(FOLDER), FOLDER, name)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of all lines on one seller and one order, a third of the events on one user, and two
    thirds of the sellers in one cohort."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    changes = {
        "lineitem": "* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey, "
        "CASE WHEN l_partkey % 3 = 0 AND l_linenumber > 2 THEN 11 ELSE l_orderkey END AS l_orderkey)",
        "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id)",
        "supplier": "* REPLACE (CASE WHEN s_suppkey % 4 <> 1 THEN s_suppkey * 2 ELSE s_suppkey END AS s_suppkey, "
        "CASE WHEN s_suppkey % 3 > 0 THEN 9000.0 ELSE s_acctbal END AS s_acctbal, CAST(0 AS INTEGER) AS s_nationkey)",
    }
    for t in TABLES:
        duckdb.sql(f"COPY (SELECT {changes.get(t, '*')} FROM '/root/testdata/sf0.01/{t}.parquet') TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "dq_report",
        "daily_metrics",
        "cohort_baseline",
        "zscore_flags",
        "cusum_flags",
        "anomaly_flags",
        "health_score",
        "priority_score",
        "sla_breaches",
        "eval_methods",
        "business_impact",
        "activity_flags",
        "iforest_flags",
        "forest_anomaly_flags",
    ],
)
def test_skewed_tables_give_the_same_results(spark, skewed, name):
    check(spark, connect(skewed), skewed, name)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_invariants_of_the_result_tables(spark):
    w = warehouse(spark, "/root/testdata/sf0.01")
    flags, tickets = w.flags, w.tickets
    assert tickets.count() > 0
    assert flags.where("method = 'Ensemble' AND size(split(reason_code, '_')) < 4").count() == 0
    assert tickets.join(flags, tickets["primary_flag_id"] == flags["flag_id"], "left_anti").count() == 0
    assert tickets.where("severity NOT IN ('High', 'Critical')").count() == 0
    assert w.health.where("health_score NOT BETWEEN 0 AND 100").count() == 0
    assert tickets.where("sla_deadline <= CAST(detected_date AS TIMESTAMP_NTZ)").count() == 0


def test_queue_filters_and_seller_page(spark):
    w = warehouse(spark, "/root/testdata/sf0.01")
    for sort in QUEUE_SORTS:
        values = [r[sort] for r in filtered_queue(w, [], [], sort).collect()]
        assert values == sorted(values, reverse=True) and len(values) == w.tickets.count()
    with pytest.raises(ValueError):
        filtered_queue(w, sort_by="1; DROP TABLE x")
    page = seller_360(w, 20)
    assert page["health"].count() == w.health.where("seller_id = 20").count()
    assert page["profile"].count() == page["cases"].count() == 1


def test_run_stops_at_the_gate_and_returns_all_tables(spark, tmp_path):
    w = warehouse(spark, FOLDER)
    with pytest.raises(DataQualityError, match="order_date_before_seller_signup"):
        run(w)
    orders = w.star["fact_orders"].dropDuplicates(["order_line_id"])
    shipments = w.star["fact_shipments"].dropDuplicates(["order_line_id"])
    clean = {
        **w.star,
        "dim_seller": w.star["dim_seller"].selectExpr("* EXCEPT (signup_date)", "DATE'2019-01-01' AS signup_date"),
        "fact_orders": orders,
        "fact_shipments": shipments,
        "fact_returns": w.star["fact_returns"].dropDuplicates(["order_line_id"]).join(shipments, "order_line_id", "left_semi"),
    }
    checked = Warehouse(clean, Workspace(spark, str(tmp_path / "run")), ("ZScore", "IQR", "CUSUM"))
    found = run(checked)
    assert found["fact_seller_daily_metrics"].count() > 0 and found["fact_anomaly_flags"].count() > 0
    export(checked, str(tmp_path / "copy"))
    assert set(os.listdir(tmp_path / "copy")) == {*COPIED, "seller_metric_cohort_baseline"}
    last = checked.spine.agg({"metric_date": "max"}).first()[0]
    trimmed = Table(spark, str(tmp_path / "copy" / "seller_metric_cohort_baseline"), "metric_date").read()
    assert (last - trimmed.agg({"metric_date": "min"}).first()[0]).days == 60
    assert sorted(os.listdir(tmp_path / "run"))


@pytest.mark.parametrize("name", ["trimmed_extract", "q4_vs_peers", "r_peer_heatmap", "r_risky"])
def test_windowed_queries_list_the_months_they_need(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in plan.split("FileScan")[1:] if "metric_date" in s.split("]")[0] or "score_date" in s.split("]")[0]]
    assert any("PartitionFilters: [" in s and "part_month" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_stored_tables_are_written_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(5)

    space = Workspace(spark, str(tmp_path))
    assert space.table("t", build).count() == space.table("t", build).count() == 5
    assert len(built) == 1


def test_summary_counts_are_upserted(spark):
    schema = "metric_name string, metric_value long"
    old = spark.createDataFrame([("total_orders", 1), ("other", 5)], schema)
    new = spark.createDataFrame([("total_orders", 9), ("total_returns", 2)], schema)
    got = {r["metric_name"]: r["metric_value"] for r in upsert_summary(old, new).collect()}
    assert got == {"total_orders": 9, "total_returns": 2, "other": 5}
