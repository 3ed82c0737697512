"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Month-day of the fixed-date holidays.
HOLIDAYS = ("01-01", "07-04", "11-28", "12-25", "12-31")


def calendar(bounds: DataFrame, extra_days: int = 0) -> DataFrame:
    """One row per day from `first_date - extra_days` to `last_date`.

    `bounds` is a one-row frame (first_date, last_date). Monday is day 0, weeks are ISO weeks.
    """
    day = F.col("date_key")
    dow = F.weekday(day)
    quarter = F.quarter(day)
    return bounds.select(
        F.explode(F.sequence(F.date_sub("first_date", extra_days), F.col("last_date"))).alias("date_key")
    ).select(
        day,
        dow.cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.month(day).cast("smallint").alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        quarter.cast("smallint").alias("quarter"),
        F.year(day).cast("smallint").alias("year"),
        (dow >= 5).alias("is_weekend"),
        F.date_format(day, "MM-dd").isin(*HOLIDAYS).alias("is_holiday"),
        F.format_string("FY%d-Q%d", F.year(day), quarter).alias("fiscal_period"),
    )
