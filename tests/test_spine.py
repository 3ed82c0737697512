"""Daily metrics, calendar and input files."""

from datetime import date
from decimal import Decimal

import pandas as pd
import pytest

from marketvane.operators.calendar import calendar
from marketvane.operators.spine import active_days, daily_metrics
from marketvane.schemas import STAR_SCHEMAS
from marketvane.sources.star import read_csv_star, read_parquet_star, write_csv, write_parts
from tests.helpers import day, rows


def tables(spark, orders=(), shipments=(), returns=(), reviews=(), sellers=((1, day(0)),)):
    """Orders (line, seller, day, gmv, cancelled), shipments (line, seller, day, late), returns (line, amount,
    defect), reviews (seller, day, rating), sellers (id, signup)."""
    return (
        spark.createDataFrame(
            [(l, s, day(d), Decimal(g), Decimal(g), c) for l, s, d, g, c in orders],
            "order_line_id long, seller_id long, order_date date, gmv decimal(12,2), unit_price decimal(10,2), is_cancelled boolean",
        ),
        spark.createDataFrame(
            [(l, s, day(d), late) for l, s, d, late in shipments],
            "order_line_id long, seller_id long, promised_ship_date date, is_late boolean",
        ),
        spark.createDataFrame(
            [(l, Decimal(a), x) for l, a, x in returns],
            "order_line_id long, refund_amount decimal(12,2), is_defect_related boolean",
        ),
        spark.createDataFrame([(s, day(d), r) for s, d, r in reviews], "seller_id long, review_date date, rating short"),
        spark.createDataFrame(list(sellers), "seller_id long, signup_date date"),
    )


def test_days_from_signup_to_last_order_with_empty_days(spark):
    spine = rows(
        daily_metrics(
            *tables(
                spark,
                orders=[(1, 1, 0, "10", False), (2, 1, 4, "30", False)],
                sellers=[(1, day(-9)), (2, day(2)), (3, day(9))],
            )
        ),
        "seller_id",
        "metric_date",
    )
    assert [(r["seller_id"], r["metric_date"]) for r in spine] == [(1, day(n)) for n in range(5)] + [(2, day(n)) for n in (2, 3, 4)]
    empty = spine[1]
    assert empty["order_volume"] == 0 and empty["defect_rate"] == 0 and empty["gmv"] == 0
    assert empty["avg_rating"] is None and empty["avg_price"] is None


def test_rates_and_rounding(spark):
    got = rows(
        daily_metrics(
            *tables(
                spark,
                orders=[(1, 1, 0, "10.00", True), (2, 1, 0, "20.00", False), (3, 1, 0, "30.01", False)],
                shipments=[(2, 1, 0, True), (3, 1, 0, False), (3, 1, 5, True)],
                returns=[(2, "20.00", True), (3, "10.00", False)],
                reviews=[(1, 0, 2), (1, 0, 5), (1, 0, 5)],
            )
        )
    )
    assert len(got) == 1
    r = got[0]
    assert r["cancellation_rate"] == Decimal("0.3333") and r["return_rate"] == Decimal("0.6667")
    assert r["defect_rate"] == Decimal("0.3333") and r["late_shipment_rate"] == Decimal("0.5000")
    assert r["refund_rate"] == Decimal("0.4999") and r["gmv"] == Decimal("60.01")
    assert r["avg_rating"] == Decimal("4.000") and r["negative_review_rate"] == Decimal("0.3333")
    assert r["avg_order_value"] == Decimal("20.00") and r["review_velocity"] == Decimal("3.000")


def test_a_return_counts_on_the_day_of_its_order(spark):
    got = rows(
        daily_metrics(*tables(spark, orders=[(1, 1, 0, "10", False), (2, 1, 20, "10", False)], returns=[(1, "10", True)])),
        "metric_date",
    )
    assert [float(r["return_rate"]) for r in got if r["return_rate"]] == [1.0]
    assert got[0]["return_rate"] == 1 and got[-1]["return_rate"] == 0


def test_growth_is_null_after_an_empty_day(spark):
    orders = [(1, 1, 0, "1", False), (2, 1, 1, "1", False), (3, 1, 1, "1", False), (4, 1, 3, "1", False)]
    got = [r["order_growth_rate_dod"] for r in rows(daily_metrics(*tables(spark, orders=orders)), "metric_date")]
    assert got == [None, Decimal("1.0000"), Decimal("-1.0000"), None]


def test_copies_of_a_returned_line_do_not_multiply_pairs(spark):
    """Three copies of an order line and two of its return: as many as the join has, six."""
    got = rows(daily_metrics(*tables(spark, orders=[(7, 1, 0, "10", False)] * 3, returns=[(7, "10", True)] * 2)))[0]
    assert got["return_rate"] == Decimal("2.0000") and got["order_volume"] == 3


def test_calendar_equals_pandas(spark):
    bounds = spark.createDataFrame([(date(2024, 2, 20), date(2025, 1, 5))], "first_date date, last_date date")
    got = calendar(bounds, extra_days=60).toPandas().sort_values("date_key").reset_index(drop=True)
    d = pd.date_range("2023-12-22", "2025-01-05")
    assert list(got["date_key"]) == list(d.date)
    assert list(got["day_of_week"]) == list(d.dayofweek) and list(got["day_name"]) == list(d.day_name())
    assert list(got["week_of_year"]) == list(d.isocalendar().week) and list(got["month_name"]) == list(d.month_name())
    assert list(got["is_weekend"]) == list(d.dayofweek >= 5)
    holidays = {"01-01", "07-04", "11-28", "12-25", "12-31"}
    assert list(got["is_holiday"]) == [x in holidays for x in d.strftime("%m-%d")]
    assert list(got["fiscal_period"]) == [f"FY{x.year}-Q{x.quarter}" for x in d]


def test_csv_star_reads_declared_types_and_empty_fields(spark, tmp_path):
    head = "customer_id,signup_date,region,customer_segment\n"
    (tmp_path / "dim_customer.csv").write_text(head + "1,2025-03-04,,VIP\n2,,North,\n")
    star = read_csv_star(spark, str(tmp_path), ("dim_customer",))
    assert rows(star["dim_customer"], "customer_id") == [
        {"customer_id": 1, "signup_date": date(2025, 3, 4), "region": None, "customer_segment": "VIP"},
        {"customer_id": 2, "signup_date": None, "region": "North", "customer_segment": None},
    ]
    (tmp_path / "dim_date.csv").write_text("date_key\nnot a date\n")
    with pytest.raises(Exception):
        read_csv_star(spark, str(tmp_path), ("dim_date",))["dim_date"].collect()


def test_tables_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(1, day(0), None, "VIP"), (2, day(40), "N", None)], STAR_SCHEMAS["dim_customer"])
    write_csv(frame, f"{tmp_path}/dim_customer.csv")
    assert rows(read_csv_star(spark, str(tmp_path), ("dim_customer",))["dim_customer"], "customer_id") == rows(frame, "customer_id")
    write_parts(frame, f"{tmp_path}/dim_customer", ("customer_segment",))
    back = read_parquet_star(spark, str(tmp_path), ("dim_customer",))["dim_customer"].select(*frame.columns)
    assert rows(back, "customer_id") == rows(frame, "customer_id")


def test_days_are_laid_out_by_several_tasks(spark):
    """The sellers come in one file, hence in one task, however many they are."""
    orders = tables(spark, orders=[(1, 1, 0, "10", False), (2, 1, 4, "30", False)])[0]
    sellers = tables(spark, sellers=[(i, day(0)) for i in range(1, 41)])[4].coalesce(1)
    days = active_days(sellers, orders)
    assert sellers.rdd.getNumPartitions() == 1
    assert days.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert active_days(sellers, orders, sellers_a_task=2).rdd.getNumPartitions() == 20
    found = sorted((r["seller_id"], r["metric_date"]) for r in days.collect())
    assert found == [(i, day(n)) for i in range(1, 41) for n in range(5)]
