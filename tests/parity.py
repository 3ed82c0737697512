"""Compare every registered query with its SQL restatement: `python tests/parity.py <folder> [names]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns by name; floats keep all digits."""

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, (pd.Timestamp,)):
            return str(v)
        if hasattr(v, "isoformat"):
            return str(pd.Timestamp(v))
        if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(float(v) + 0.0)
        return str(v)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False, name=None))


SPARK_TYPES = {
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def type_differences(schema, description) -> str:
    """Columns whose SQL type is not the Spark column's type."""
    spark = {f.name: f.dataType.simpleString() for f in schema.fields}
    sql = {name: str(kind) for name, kind, *_ in description}
    return ", ".join(
        f"{c}: {spark.get(c)} / {t}" for c, t in sql.items() if SPARK_TYPES.get(t) != spark.get(c)
    )


def differences(got: pd.DataFrame, want: pd.DataFrame, shown: int = 3) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"rows {len(a)} / {len(b)}; {len(only_a)} and {len(only_b)} unmatched\n  spark {only_a[:shown]}\n  sql   {only_b[:shown]}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "10g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:]
    db, failed = connect(folder), 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if (names and name not in names) or name not in oracles:
            continue
        t0 = time.time()
        frame = query(spark, folder)
        got = frame.toPandas()
        t1 = time.time()
        try:
            found = db.sql(oracles[name])
            problem = type_differences(frame.schema, zip(found.columns, found.types)) or differences(got, found.df())
        except duckdb.Error as e:
            problem = str(e)[:600]
        failed += bool(problem)
        print(f"{name:22s} {len(got):7d} rows  spark {t1 - t0:6.2f}s  sql {time.time() - t1:6.2f}s  {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
