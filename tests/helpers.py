"""Small frames for the tests."""

from datetime import date, timedelta

from marketvane.registry import METRICS, severity
from marketvane.schemas import FLAG_SCHEMA, SPINE_TYPES

DAY0 = date(2026, 1, 1)


def day(n):
    return DAY0 + timedelta(days=n)


def rows(frame, *order):
    """Collected rows as dicts, in the given order."""
    return [r.asDict() for r in (frame.orderBy(*order) if order else frame).collect()]


def spine_frame(spark, values, metric="order_volume"):
    """A spine from {seller: [value per day]}; other metrics are 0 and rating and price are null."""
    data = []
    for seller, series in values.items():
        for n, value in enumerate(series):
            row = {c: 0 for c in SPINE_TYPES}
            row.update(seller_id=seller, metric_date=day(n).isoformat(), avg_rating=None, avg_price=None)
            row["order_growth_rate_dod"] = None
            row[metric] = value
            data.append({k: None if v is None else str(v) for k, v in row.items()})
    text = ", ".join(f"{c} string" for c in SPINE_TYPES)
    return spark.createDataFrame(data, text).selectExpr(*[f"cast({c} as {t}) as {c}" for c, t in SPINE_TYPES.items()])


def sellers_frame(spark, ids, cohort=("New", "Category_0", "Micro"), signup=None):
    data = [(i, f"Seller {i}", signup or DAY0, *cohort) for i in ids]
    return spark.createDataFrame(
        data,
        "seller_id long, seller_name string, signup_date date, tenure_cohort string, primary_category string, seller_segment string",
    )


def flags_frame(spark, entries):
    """Flags from (seller, day, type, method[, score[, metric]])."""
    metric_of = {m.anomaly_type: m.name for m in reversed(METRICS)}
    data = []
    for seller, n, kind, method, *rest in entries:
        score = float(rest[0]) if rest else 3.0
        metric = rest[1] if len(rest) > 1 else metric_of[kind]
        data.append((seller, day(n), kind, metric, 0.01, 0.05, 0.04, 400.0, method, score, "", "test", "test flag"))
    frame = spark.createDataFrame(data, FLAG_SCHEMA)
    return frame.withColumn("severity", severity(frame["anomaly_score"]))


def episodes_frame(spark, entries):
    """Episodes from (id, seller, type, first day, last day)."""
    data = [(i, s, t, day(a), day(b), None) for i, s, t, a, b in entries]
    return spark.createDataFrame(
        data,
        "ground_truth_id long, seller_id long, anomaly_type string, start_date date, end_date date, injected_magnitude decimal(10,4)",
    )
