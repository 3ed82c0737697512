"""Result tables written once and read by every later stage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import Table, released_shuffles


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local master without it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="marketvane-")
    spark.sparkContext.setCheckpointDir(root)
    return root


class Workspace:
    """Named tables under one run folder.

    A table is written as Parquet the first time it is asked for and read back afterwards, so
    consumers get column pruning and row-group skipping, lineage is cut, and a lost executor costs
    only its running tasks. What was shuffled for a table goes when the table is written.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{checkpoint_root(spark)}/marketvane-{uuid.uuid4().hex}"
        self._tables: dict[str, DataFrame] = {}
        self._dated: dict[str, Table] = {}

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._tables:
            path = f"{self.root}/{name}"
            frame = build()
            with released_shuffles(self.spark):
                frame.write.mode("overwrite").parquet(path)
            self._tables[name] = self.spark.read.schema(frame.schema).parquet(path)
        return self._tables[name]

    def bucketed(self, name: str, build: Callable[[], DataFrame], key: str) -> DataFrame:
        """The stored table in buckets by the hash of `key`: groupings and joins by it need no exchange.

        As many buckets as the session shuffles to, or may make. Rows are dealt to files by measured size, so a large bucket is
        written by several tasks; a bucket is read by one, streaming.
        """
        if name not in self._tables:
            settings = ("spark.sql.shuffle.partitions", "spark.sql.sources.bucketing.maxBuckets")
            buckets = min(int(self.spark.conf.get(s)) for s in settings)
            table = f"{name}_{uuid.uuid4().hex}"
            dealt = build().hint("rebalance", key)
            with released_shuffles(self.spark):
                dealt.write.bucketBy(buckets, key).option("path", f"{self.root}/{table}").saveAsTable(table)
            self._tables[name] = self.spark.table(table)
        return self._tables[name]

    def dated(self, name: str, build: Callable[[], DataFrame], day: str) -> Table:
        """The stored table parted by the months of `day`, so a scan of some days lists only theirs."""
        if name not in self._dated:
            table = Table(self.spark, f"{self.root}/{name}", day)
            table.replace(build(), sort_by=day)
            self._dated[name] = table.snapshot()
        return self._dated[name]
