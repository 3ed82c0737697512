"""What the operators of this subpackage share: reading, the shared folder, Arrow mapping in small slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of text that one call of a mapped function sees at most (a single longer row goes alone).
SLICE_ROWS = 1000
SLICE_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def use_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the folder the session names; only a local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(folder)


def as_binary(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def byte_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each value; 0 for a null."""
    return pc.fill_null(pc.binary_length(as_binary(column)), 0).to_numpy(zero_copy_only=False)


def slices(batch: pa.RecordBatch, measured: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, few enough at a time that their `measured` column stays small."""
    start = size = 0
    for row, own in enumerate(byte_lengths(batch.column(measured)).tolist()):
        if row > start and (size + own > SLICE_BYTES or row - start >= SLICE_ROWS):
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += own
    if start < batch.num_rows:
        yield batch.slice(start)


def map_slices(
    frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, measured: str
) -> DataFrame:
    """`function` over slices of the rows, by Arrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, measured):
                yield function(part)

    return frame.mapInArrow(run, schema)


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """`frame` written as a table to the shared folder and read again: cuts its lineage."""
    spark = frame.sparkSession
    use_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def with_tag(docs: DataFrame) -> DataFrame:
    """Adds `tag`, which tells documents of one `id` apart by their `text`: 0 throughout where ids are unique."""
    again = docs.groupBy("id").count().where("count > 1").limit(1).count()
    return docs.withColumn("tag", F.xxhash64("text") if again else F.lit(0).cast("bigint"))
