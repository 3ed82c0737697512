"""Investigation tickets: building, status updates and service-level tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..functions.scale import dense_ids, id_range
from ..registry import CLOSED_STATUSES, is_open

TICKET_SEVERITIES = ("High", "Critical")


def build_tickets(priority: DataFrame) -> DataFrame:
    """One new, numbered ticket per (seller, day) with a High or Critical flag."""
    return number_tickets(bundle_cases(priority))


def number_tickets(bundled: DataFrame) -> DataFrame:
    """Tickets with a case_id in day order. `bundled` is read several times: pass a stored frame."""
    return dense_ids(bundled, "case_id", F.col("detected_date"), id_range("seller_id"), ["seller_id"])


def bundle_cases(priority: DataFrame) -> DataFrame:
    """New tickets without a number.

    The flag of highest priority leads; the others are attached. A seller-day has at most one flag
    per type, so the collected group is small.
    """
    entry = F.struct(
        (-F.col("priority_score")).alias("o"), "flag_id", "severity", "priority_score", "sla_hours"
    )
    bundled = (
        priority.where(F.col("severity").isin(*TICKET_SEVERITIES))
        .groupBy("seller_id", F.col("flag_date").alias("detected_date"))
        .agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    )
    lead = F.element_at("_e", 1)
    none = F.lit(None).cast("string")
    moment = F.lit(None).cast("timestamp_ntz")
    return bundled.select(
        "seller_id",
        lead["flag_id"].alias("primary_flag_id"),
        F.transform(F.slice("_e", 2, F.size("_e")), lambda e: e["flag_id"]).alias("related_flag_ids"),
        lead["severity"].alias("severity"),
        lead["priority_score"].alias("priority_score"),
        "detected_date",
        lead["sla_hours"].alias("sla_hours"),
    ).withColumns(
        {
            "sla_deadline": after_hours(F.col("detected_date"), F.col("sla_hours")),
            "status": F.lit("New"),
            "assigned_investigator": none,
            "root_cause_category": none,
            "notes": none,
            "resolution": none,
            "resolved_at": moment,
            "is_sla_breached": F.lit(False),
            "created_at": F.col("detected_date").cast("timestamp_ntz"),
            "updated_at": F.col("detected_date").cast("timestamp_ntz"),
        }
    )


def after_hours(day: Column, hours: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hours)


def apply_updates(tickets: DataFrame, updates: DataFrame) -> DataFrame:
    """Tickets after the latest update of each case.

    An update replaces status, root cause, notes and resolution; a closing status sets the
    resolution time and any other clears it. Cases without an update stay as they are.
    """
    latest = updates.groupBy("case_id").agg(
        F.max_by(
            F.struct("status", "root_cause", "notes", "resolution", "assigned_investigator", "updated_at"),
            F.struct("updated_at", "status"),
        ).alias("u")
    )
    u, changed = F.col("u"), F.col("u").isNotNull()

    def new(value: Column, name: str) -> Column:
        return F.when(changed, value).otherwise(F.col(name)).alias(name)

    replaced = {
        "status": u["status"],
        "assigned_investigator": F.coalesce(u["assigned_investigator"], F.col("assigned_investigator")),
        "root_cause_category": u["root_cause"],
        "notes": u["notes"],
        "resolution": u["resolution"],
        "resolved_at": F.when(u["status"].isin(*CLOSED_STATUSES), u["updated_at"]),
        "updated_at": u["updated_at"],
    }
    return tickets.join(latest, "case_id", "left").select(
        *[new(replaced[c], c) if c in replaced else F.col(c) for c in tickets.columns]
    )


def mark_breaches(tickets: DataFrame, as_of: Column) -> DataFrame:
    """Mark tickets past their deadline: open or escalated by `as_of`, or closed too late.

    A breach once marked stays.
    """
    status, deadline, resolved = F.col("status"), F.col("sla_deadline"), F.col("resolved_at")
    late = (is_open(status) | (status == "Escalated")) & (deadline < as_of)
    closed_late = status.isin(*CLOSED_STATUSES) & (resolved > deadline)
    return tickets.withColumn(
        "is_sla_breached", F.col("is_sla_breached") | F.coalesce(late | closed_late, F.lit(False))
    )


def sla_summary(tickets: DataFrame) -> DataFrame:
    """Tickets, breaches and breach percentage by status."""
    return (
        tickets.groupBy("status")
        .agg(F.count("*").alias("n_tickets"), F.count_if("is_sla_breached").alias("n_breached"))
        .withColumn("pct_breached", percent(F.col("n_breached"), F.col("n_tickets")))
        .orderBy(F.desc("n_tickets"), "status")
    )
