"""Reading and writing the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..schemas import STAR_SCHEMAS


def read_csv_star(spark: SparkSession, folder: str, tables=tuple(STAR_SCHEMAS)) -> dict[str, DataFrame]:
    """Header CSV files `<folder>/<table>.csv` under their declared schemas; empty fields are null.

    The header is checked against the declared column order, and a bad value stops the load.
    """
    options = {"header": True, "nullValue": "", "enforceSchema": False, "mode": "FAILFAST"}
    return {
        t: spark.read.schema(STAR_SCHEMAS[t]).options(**options).csv(f"{folder}/{t}.csv") for t in tables
    }


def read_parquet_star(spark: SparkSession, folder: str, tables=tuple(STAR_SCHEMAS)) -> dict[str, DataFrame]:
    """Parquet tables `<folder>/<table>`; only the columns a query uses are read."""
    return {t: spark.read.parquet(f"{folder}/{t}") for t in tables}


def write_csv(frame: DataFrame, path: str) -> None:
    """Header CSV, nulls as empty fields, the values of a list as one text with commas."""
    lists = {f.name: F.array_join(F.col(f"`{f.name}`").cast("array<string>"), ",") for f in frame.schema if isinstance(f.dataType, ArrayType)}
    frame.withColumns(lists).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def write_parts(frame: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Parquet parted by columns; adaptive execution splits large parts and puts small ones together by measured size."""
    frame.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
