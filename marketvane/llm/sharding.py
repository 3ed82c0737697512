"""Shards by extendible hashing.

A document's address is a hash of its id. The directory is indexed by leading address bits; a shard is a prefix,
and only a shard above the byte limit is split on its next bit, until every shard fits. The directory is found in
rounds of ROUND_BITS bits: one aggregate over the documents of the shards that are still too large gives the bytes
of all their prefixes of the round, and each document takes its shortest prefix that fits.

Rows of one id have one address and no bit parts them, so they share a shard; where all addresses of a shard that
is too large are equal after the id's bits are spent, its rows go on with the bits of their number among the equal
ones. A single document above the limit is a shard of its own.

`write_shards` writes the documents so that each shard is one file. The limit counts the bytes of texts, not those of
other columns or of the file.

Defined cases: a null or empty text has 0 bytes, a null id the address of the empty string; an empty table has no shard.
Repeated rows each count. Rows of one id and one size are alike to the numbering, so either may take either number.
Of a text only its length is read. Other columns are read by the writer alone, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LIMIT_BYTES = 1 << 20
#: Address bits: what 15 hex digits of md5 hold, and as many again for rows of one id.
ID_BITS = 60
ROUND_BITS = 8


def address(value: Column) -> Column:
    """60 bits of md5, as text of 0 and 1."""
    digits = F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, ID_BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), ID_BITS, "0")


def _round(open_: DataFrame, depth: int, bits: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Documents of open_ with the shard they fit in now, and those that need more bits."""
    cell = F.substring("bits", 1, depth + bits)
    cells = open_.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
    at = cells.select("cell", "bytes", "docs", F.explode(F.sequence(F.lit(depth), F.lit(depth + bits))).alias("depth"))
    at = at.withColumn("shard", F.expr("substring(cell, 1, depth)"))
    sums = at.groupBy("shard", "depth").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fits = at.select("cell", "shard", "depth").join(
        sums.where(F.col("shard_bytes") <= limit).unionByName(sums.where((F.col("shard_bytes") > limit) & (F.col("shard_docs") == 1))),
        ["shard", "depth"],
    )
    directory = fits.groupBy("cell").agg(F.min(F.struct(F.col("depth").cast("bigint").alias("depth"), "shard", "shard_bytes", "shard_docs")).alias("found"))
    judged = open_.withColumn("cell", cell).join(directory, "cell", "left")
    judged = stored(judged.drop("cell"), "shards")
    return (
        judged.where("found is not null").select("row", "id", "n_bytes", "bits", "found.*"),
        judged.where("found is null").drop("found"),
    )


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """One row a document: id, n_bytes, and its shard: the prefix, its depth, bytes and documents."""
    return _assigned(docs, F.lit(None).cast("bigint"), id_col, text_col, limit).drop("row")


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> str:
    """Writes the documents, with all columns, to `folder`: one Parquet file a shard, under `shard=s` and the shard's prefix.

    Returns the name of the folders' column: `shard`, with underscores where the documents have a column of that name.
    """
    name, taken = "shard", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given")
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("row"), given), "numbered")
    read = numbered.select("row", F.col(f"given.`{id_col}`").alias("id"), F.col(f"given.`{text_col}`").alias("text"))
    assigned = _assigned(read, F.col("row"), "id", "text", limit)
    # The letter keeps prefixes from being read back as numbers.
    laid = numbered.join(assigned.select("row", F.concat(F.lit("s"), "shard").alias("to")), "row").repartition("to")
    laid.select("given.*", F.col("to").alias(name)).write.partitionBy(name).parquet(folder)
    return name


def _assigned(docs: DataFrame, row: Column, id_col: str, text_col: str, limit: int) -> DataFrame:
    open_ = docs.select(
        row.alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"),
        address(F.col(id_col)).alias("bits"),
    )
    done, depth = None, 0
    while True:
        bits = min(ROUND_BITS, (ID_BITS if depth < ID_BITS else 2 * ID_BITS) - depth)
        found, open_ = _round(open_, depth, bits, limit)
        done = found if done is None else done.unionByName(found)
        depth += bits
        if depth >= 2 * ID_BITS or not open_.limit(1).count():
            break
        if depth == ID_BITS:  # rows of one address: number them, and go on with the bits of that number's hash
            number = F.row_number().over(Window.partitionBy("bits").orderBy("n_bytes"))
            open_ = stored(open_.withColumn("bits", F.concat("bits", address(number))), "shards")
    return done.select("row", F.col("id").alias(id_col), "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")
