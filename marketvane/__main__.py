"""Run the daily pipeline on a folder of star tables: `python -m marketvane INPUT OUTPUT`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.summary import upsert_summary
from .plans.pipeline import Warehouse, export, keep, run
from .registry import METHODS
from .schemas import UPDATE_SCHEMA
from .sources.star import read_csv_star, read_parquet_star, write_csv
from .sources.tables import Table
from .workspace import Workspace


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", help="folder with one table per name of the star schema")
    parser.add_argument("output", help="folder of the result tables, each replaced whole or by month (see sources/tables.py)")
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv")
    parser.add_argument("--methods", nargs="+", choices=METHODS, default=list(METHODS))
    parser.add_argument("--as-of", help="moment of the run, as 'YYYY-MM-DD hh:mm:ss'; now unless given")
    parser.add_argument("--updates", help="folder of status updates, in the input's format")
    parser.add_argument("--months", nargs="+", help="months of tables with a date to replace, as yyyy-mm; the others stay")
    parser.add_argument("--csv", help="folder the result tables are also written to as CSV")
    parser.add_argument("--extract", help="folder the trimmed extract is written to")
    parser.add_argument("--skip-quality-gate", action="store_true")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("marketvane").getOrCreate()
    read = read_csv_star if args.format == "csv" else read_parquet_star
    moment = F.lit(args.as_of) if args.as_of else F.current_timestamp()
    moment = moment.cast("timestamp_ntz")
    updates = None
    if args.updates:
        given = spark.read.schema(UPDATE_SCHEMA).options(header=True, nullValue="").format(args.format).load(args.updates)
        updates = lambda tickets: given
    warehouse = Warehouse(
        read(spark, args.input), Workspace(spark), tuple(args.methods), updates, as_of=moment, judged_at=moment
    )
    for name, frame in run(warehouse, not args.skip_quality_gate).items():
        if name == "dataset_summary" and (before := Table(spark, f"{args.output}/{name}")).exists():
            frame = upsert_summary(before.read(), frame)  # what it reads stays until the next clean-up
        table = keep(warehouse, args.output, name, frame, args.months)
        table.vacuum()
        if args.csv:
            write_csv(table.read(), f"{args.csv}/{name}")
    if args.extract:
        export(warehouse, args.extract)


if __name__ == "__main__":
    main()
