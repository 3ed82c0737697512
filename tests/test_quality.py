"""Every check on one violating row, a clean set, the gate and the declared domains."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketvane.operators.quality import DataQualityError, domain_checks, gate, key_checks, raw_checks, report, spine_check
from tests.helpers import day, rows, sellers_frame, spine_frame


def as_of():
    return F.lit(datetime(2026, 3, 1)).cast("timestamp_ntz")


def star(spark, orders, shipments, returns, reviews):
    return {
        "fact_orders": spark.createDataFrame(
            [(l, s, day(d), Decimal(g)) for l, s, d, g in orders], "order_line_id long, seller_id long, order_date date, gmv decimal(12,2)"
        ),
        "fact_shipments": spark.createDataFrame(
            [(l, day(a), day(b)) for l, a, b in shipments], "order_line_id long, actual_ship_date date, actual_delivery_date date"
        ),
        "fact_returns": spark.createDataFrame([(l, Decimal(a)) for l, a in returns], "order_line_id long, refund_amount decimal(12,2)"),
        "fact_reviews": spark.createDataFrame([(r,) for r in reviews], "rating short"),
        "dim_seller": sellers_frame(spark, [1], signup=day(0)),
    }


def test_clean_tables_pass_and_the_gate_opens(spark):
    clean = report(raw_checks(star(spark, [(1, 1, 0, "5"), (2, 1, 1, "5")], [(1, 1, 2), (2, 2, 2)], [(1, "5")], [1, 5]), as_of()))
    assert {r["status"] for r in rows(clean)} == {"PASS"} and clean.count() == 12
    gate(clean)


def test_each_check_counts_its_violations(spark):
    orders = [(1, 1, 0, "5"), (1, 1, 0, "5"), (2, 9, 0, "-1"), (3, None, 0, "5"), (4, 1, -1, "5"), (5, 1, 100, "5")]
    bad = report(raw_checks(star(spark, orders, [(1, 5, 2), (77, 1, 1)], [(1, "-5"), (88, "5"), (2, "1")], [0, 6, 3]), as_of()))
    got = {r["check"]: r["violations"] for r in rows(bad)}
    assert got == {
        "duplicate_orders": 1,
        "orphan_order_seller_fk": 2,
        "orphan_shipment_order_fk": 1,
        "orphan_return_order_fk": 1,
        "negative_gmv": 1,
        "negative_refund_amount": 1,
        "invalid_rating": 2,
        "delivery_before_ship": 1,
        "order_date_before_seller_signup": 1,
        "future_dated_orders": 1,
        "null_seller_id_orders": 1,
        "return_without_delivered_shipment": 2,
    }
    with pytest.raises(DataQualityError, match="negative_gmv: 1"):
        gate(bad)


def test_spine_bounds(spark):
    frame = spine_frame(spark, {1: ["0", "1", "1.5", "-0.1"]}, "return_rate")
    assert rows(spine_check(frame))[0]["violations"] == 2


def test_declared_domains(spark):
    sellers = spark.createDataFrame(
        [(1, "New", "Micro", "LLC", "Self-Ship"), (1, "Old", "Mid", None, "Pigeon")],
        "seller_id long, tenure_cohort string, seller_segment string, business_type string, fulfillment_type string",
    )
    got = {r["check"]: r["violations"] for r in rows(domain_checks({"dim_seller": sellers}))}
    assert got == {
        "dim_seller.tenure_cohort:enum": 1,
        "dim_seller.seller_segment:enum": 0,
        "dim_seller.business_type:enum": 0,
        "dim_seller.fulfillment_type:enum": 1,
        "dim_seller:unique": 1,
    }


def test_keys_references_and_required_columns(spark):
    """One planted violation of each kind; a ticket without its flag is one; null refers to nothing."""
    flags = spark.createDataFrame([(1, 5, 0.5), (2, 5, None), (2, 6, None)], "flag_id long, seller_id long, baseline_value double")
    tickets = spark.createDataFrame(
        [(1, 5, 1, None), (2, None, 9, None), (3, 7, 9, "x"), (4, 5, None, "x")],
        "case_id long, seller_id long, primary_flag_id long, notes string",
    )
    sellers = sellers_frame(spark, [5, 6]).select("seller_id")
    tables = {"dim_seller": sellers, "fact_anomaly_flags": flags, "investigation_tickets": tickets}
    assert {r["check"]: r["violations"] for r in rows(key_checks(tables))} == {
        "dim_seller:required": 0,
        "dim_seller:key": 0,
        "fact_anomaly_flags:required": 0,
        "fact_anomaly_flags:key": 1,
        "fact_anomaly_flags.seller_id:reference": 0,
        "investigation_tickets:required": 1,
        "investigation_tickets:key": 0,
        "investigation_tickets.seller_id:reference": 1,
        "investigation_tickets.primary_flag_id:reference": 2,
    }
    empty = {name: frame.limit(0) for name, frame in tables.items()}
    assert {r["status"] for r in rows(key_checks(empty))} == {"PASS"}
