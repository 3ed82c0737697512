"""From raw documents to token ids: quality rules, near duplicates, repeated passages, source mix, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketvane.llm import bpe, mixing, ngram_join, quality_rules, suffix_dedup
from marketvane.llm.common import documents, stored, with_tag
from marketvane.llm.queries import WORD_VOCABULARY, digests, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality_rules.passing(docs, "v1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies, the document with the least id. Rows equal in id and text are one
    document; a document without words is no copy of any other."""
    again = docs.groupBy("doc_id").count().where("count > 1").limit(1).count()
    # Where an id repeats, its texts tell documents apart; as before, a null id is no least one beside others.
    several = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("tag"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given")
    keyed = docs.select(whole, "text", (several if again else F.col("doc_id")).alias("document"))
    classes = ngram_join.near_duplicates(keyed, "document")
    stays = classes.where(F.col("document").eqNullSafe(F.col("class_id"))).select(F.col("document").alias("stays")).distinct()
    kept = keyed.join(stays, keyed["document"].eqNullSafe(stays["stays"]), "left_semi").select("given.*")
    return kept.dropDuplicates(["doc_id", "text"]) if again else kept


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that start earlier; a code point cut in two goes as a whole."""
    left = suffix_dedup.remove_repeats(docs, as_text=True)
    return with_text(left, docs, F.col("kept"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the text that the mix takes of them: some words once, some twice, some not at all."""
    named = [F.col(f"`{c}`") for c in docs.columns]
    keyed = with_tag(docs.select(F.col("doc_id").alias("id"), "text", "source", F.struct(*named).alias("given")))
    keyed = keyed.select(F.struct("id", "tag").alias("key"), "text", "source", "given")
    mixed = mixing.assemble(keyed, mixing.mix_sources(keyed, "key"), "key")
    return with_text(mixed.select("row.given", "mixed").withColumnRenamed("given", "row"), docs, F.col("mixed"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of what they decode to."""
    return digests(bpe.encode_decode(docs, vocabulary(WORD_VOCABULARY)))


def with_text(rows: DataFrame, docs: DataFrame, text: F.Column) -> DataFrame:
    """The columns of `docs` from `row`, with another text and its length."""
    own = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": text}
    return rows.select(*[own[c].alias(c) if c in own else F.col(f"row.`{c}`") for c in docs.columns])


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", mix),
    ("BPE", encode),
]

#: Suffix arrays, MinHash and BPE merges are beyond SQL; tests hold them against brute force, the
#: mix against its targets.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
