"""Joins, ranks and ids that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: list[str], how: str = "inner", salts: int = 16
) -> DataFrame:
    """Equi-join of a large frame with a smaller one that has one row per key.

    Rows of a hot key on the left are spread over `salts` tasks by a hash of `spread_by`; the right
    side is repeated once per salt. The result is the plain join.
    """
    slot = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        left.withColumn("_salt", slot)
        .join(right.withColumn("_salt", copies), on=[*on, "_salt"], how=how)
        .drop("_salt")
    )


def dense_ids(df: DataFrame, name: str, major: Column, minor: Column, fine: list[str]) -> DataFrame:
    """Number the rows 1..n in the order of (major, minor, fine) without sorting them in one task.

    Rows are counted per (major, minor) group and numbered inside it. Only the totals per major
    value, such as a day, are summed up in one task. `fine` must make the order total.
    """
    grouped = df.select("*", major.alias("_a"), minor.alias("_b"))
    counts = grouped.groupBy("_a", "_b").agg(F.count("*").alias("_n"))
    before = (Window.unboundedPreceding, -1)
    earlier = F.sum("_n").over(Window.orderBy("_a").rowsBetween(*before))
    majors = counts.groupBy("_a").agg(F.sum("_n").alias("_n")).select("_a", F.coalesce(earlier, F.lit(0)).alias("_start"))
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_a").orderBy("_b").rowsBetween(*before)), F.lit(0))
    starts = counts.withColumn("_offset", inside).join(majors, "_a").select("_a", "_b", (F.col("_start") + F.col("_offset")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_a", "_b").orderBy(*fine))
    return (
        grouped.withColumn("_rn", place)
        .join(starts, ["_a", "_b"])
        .select((F.col("_start") + F.col("_rn")).alias(name), *df.columns)
    )


def id_range(key: str, size: int = 4096) -> Column:
    """The range an id lies in: groups of neighbouring ids, so numbering by (range, id) keeps their natural order."""
    return F.floor(F.col(key) / size)


def _magnitude_bucket(value: Column) -> Column:
    """A bucket that grows with the value: 64 per power of two, so a few thousand in all."""
    return (F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * 64)).cast("long")


def quantiles(df: DataFrame, columns: tuple[str, ...], share: float) -> DataFrame:
    """One row with a struct (at, top) for every column: its exact `share` quantile and its maximum, both as doubles.

    The quantile lies between two neighbouring values as `percentile` has it; nulls don't count, and a column without
    values has nulls. Values are counted first, so a hot value is one row; running counts are taken inside magnitude
    buckets and shifted by the counts of the lower buckets, so no task holds all values of a column.
    """
    cells = [F.struct(F.lit(i).alias("_c"), F.col(x).cast("double").alias("_v")) for i, x in enumerate(columns)]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where("_v IS NOT NULL")
        .groupBy("_c", "_v")
        .agg(F.count("*").alias("_n"))
        .withColumn("_b", _magnitude_bucket(F.col("_v")))
    )
    by_bucket = Window.partitionBy("_c").orderBy("_b")
    buckets = (
        counts.groupBy("_c", "_b")
        .agg(F.sum("_n").alias("_bn"))
        .select(
            "_c",
            "_b",
            F.coalesce(F.sum("_bn").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.sum("_bn").over(Window.partitionBy("_c")).alias("_total"),
        )
    )
    upto = Window.partitionBy("_c", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_before") + F.sum("_n").over(upto)
    place = (F.col("_total") - 1) * F.lit(share)
    placed = counts.join(buckets, ["_c", "_b"]).select("_c", "_v", (end - F.col("_n")).alias("_from"), end.alias("_end"), place.alias("_place"))

    def value_at(rank: Column, i: int) -> Column:
        holds = (F.col("_c") == i) & (F.col("_from") <= rank) & (rank < F.col("_end"))
        return F.max(F.when(holds, F.col("_v")))

    found = []
    for i in range(len(columns)):
        found.append(value_at(F.floor("_place"), i).alias(f"low{i}"))
        found.append(value_at(F.ceil("_place"), i).alias(f"high{i}"))
        found.append(F.max(F.when(F.col("_c") == i, F.col("_v"))).alias(f"top{i}"))
        found.append(F.max(F.when(F.col("_c") == i, F.col("_place"))).alias(f"place{i}"))
    row = placed.agg(*found)
    out = []
    for i, x in enumerate(columns):
        low, high, at = F.col(f"low{i}"), F.col(f"high{i}"), F.col(f"place{i}")
        between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        out.append(F.struct(F.when(low == high, low).otherwise(between).alias("at"), F.col(f"top{i}").alias("top")).alias(x))
    return row.select(*out)


def rank_table(df: DataFrame, value: str) -> DataFrame:
    """(value, percent rank 0-100) with ties sharing their average rank: 100 * average rank / n.

    Equal values are counted first, so a hot value is one row; running counts are taken inside
    magnitude buckets and shifted by the counts of the lower buckets.
    """
    counts = (
        df.groupBy(F.col(value).alias("_v"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_b", _magnitude_bucket(F.col("_v").cast("double")))
    )
    ordered = Window.orderBy("_b")
    lower = ordered.rowsBetween(Window.unboundedPreceding, -1)
    all_of_them = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    buckets = (
        counts.groupBy("_b")
        .agg(F.sum("_n").alias("_bn"))
        .select(
            "_b",
            F.coalesce(F.sum("_bn").over(lower), F.lit(0)).alias("_before"),
            F.sum("_bn").over(all_of_them).alias("_total"),
        )
    )
    upto = Window.partitionBy("_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    below = F.col("_before") + F.sum("_n").over(upto) - F.col("_n")
    return counts.join(buckets, "_b").select(
        F.col("_v").alias(value), ((below + (F.col("_n") + 1) / 2) / F.col("_total") * 100).alias("_rank")
    )


def with_rank(df: DataFrame, ranks: DataFrame, value: str, name: str, spread_by: list[str]) -> DataFrame:
    """Attach a rank table; rows of a hot value are spread over tasks."""
    return salted_join(df, ranks, [value], spread_by).withColumnRenamed("_rank", name)
