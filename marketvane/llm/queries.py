"""One registered query an operator, each over the whole `documents` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, decontamination, fill_in_middle, language_model, mixing, ngram_join, quality_rules, sharding, spelling, suffix_dedup,
    token_counts, toxicity, winnowing,
)
from .common import documents


#: Vocabulary files, read where they are installed.
WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and its number of links."""
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    taken = mixing.mix_sources(documents(spark, sf_dir)).taken()
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability, by word frequencies and by the n-gram trie."""
    return language_model.train_and_score(documents(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard."""
    return sharding.assign_shards(documents(spark, sf_dir))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document."""
    return winnowing.compare_with_next(documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings."""
    left = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda sum_, span: sum_ + span["end"] - span["at"])
    return left.select(
        "row.doc_id",
        (F.octet_length("kept") + removed).cast("bigint").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected severity."""
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def digests(coded: DataFrame) -> DataFrame:
    """The digest columns of encoded and decoded texts."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    return digests(bpe.encode_decode(documents(spark, sf_dir), vocabulary(WORD_VOCABULARY)))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with the verdicts of the base policy and of the current one."""
    lines = quality_rules.ledger(documents(spark, sf_dir))
    return lines.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"),
        quality_rules.passes("v1").alias("kept"),
        F.col("failed").alias("failed_rules"),
    )


def op9_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy rejects, alone and with others."""
    return quality_rules.ablation(quality_rules.ledger(documents(spark, sf_dir)), "v1")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens."""
    counts = token_counts.count_tokens(documents(spark, sf_dir), vocabulary(BYTE_VOCABULARY))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cuts and form, digests of its output and of the text rebuilt from that output."""
    return fill_in_middle.restore(fill_in_middle.transform(documents(spark, sf_dir)), texts=False)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside occurrences of benchmark windows, and the items they belong to."""
    postings = decontamination.index(documents(spark, sf_dir))
    found = decontamination.search(postings, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = decontamination.covered(F.col("spans"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op12_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items of which some window's words stand within REACH words of it."""
    postings = decontamination.index(documents(spark, sf_dir))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.search(postings, items, reach=decontamination.REACH)
    return found.select(F.col("id").alias("doc_id"), "n_words", F.array_join("items", ",").alias("near_items"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with its near words, form and root."""
    return spelling.variants(spelling.word_counts(documents(spark, sf_dir)))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mixing": op2_mixing,
    "op3_language_model": op3_language_model,
    "op4_sharding": op4_sharding,
    "op5_winnowing": op5_winnowing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op9_rule_ablation": op9_rule_ablation,
    "op10_token_counts": op10_token_counts,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_decontamination": op12_decontamination,
    "op12_proximity": op12_proximity,
    "op13_spelling": op13_spelling,
}

#: The ledger in SQL.
LEDGER_SQL = r"""
with texts as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), places as (
  select doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] as tri
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from texts where len(words) > 2)
), repeated as (
  select doc_id, count(distinct k) as n
  from (select doc_id, unnest([i, i + 1, i + 2]) as k
        from (select doc_id, i, count(*) over (partition by doc_id, tri) as c from places) where c > 1)
  group by doc_id
), lines as (
  select doc_id, count(*) as n, count(*) - count(distinct line) as dup
  from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), measured as (
  select t.doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    coalesce(l.n, 0) as n_lines, coalesce(l.dup, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
  from texts t left join repeated r on t.doc_id = r.doc_id left join lines l on t.doc_id = l.doc_id
), ledger as (
  select *, (case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
    + (case when 10 * n_symbols > n_words then 4 else 0 end) + (case when 2 * n_dup_lines > n_lines then 8 else 0 end)
    + (case when word_chars < 2 * n_words then 16 else 0 end) + (case when word_chars > 25 * n_words then 32 else 0 end)
    as failed
  from measured
)
"""

ORACLES = {
    "op4_sharding": """
with docs as (
  select doc_id, cast(coalesce(strlen(text), 0) as bigint) as n_bytes,
    lpad(bin(cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15)) as ubigint)), 60, '0') as bits
  from documents
), sums as (
  select d as depth, substr(bits, 1, d) as shard, cast(sum(n_bytes) as bigint) as shard_bytes, count(*) as shard_docs
  from docs, (select unnest(range(0, 41)) as d) group by all
), fits as (
  select * from sums where shard_bytes <= 1048576 or shard_docs = 1
)
select doc_id, n_bytes, f.shard, cast(f.depth as bigint) as depth, f.shard_bytes, f.shard_docs
from docs join fits f on substr(bits, 1, f.depth) = f.shard
qualify row_number() over (partition by doc_id order by f.depth) = 1
""",
    "op9_quality_rules": LEDGER_SQL + """select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 as base_failed,
  failed = 0 as kept, cast(failed as bigint) as failed_rules
from ledger
""",
    "op9_rule_ablation": LEDGER_SQL + """
select rule, cast(sum(case when failed & mask <> 0 then 1 else 0 end) as bigint) as n_failed,
  cast(sum(case when failed = mask then 1 else 0 end) as bigint) as n_only,
  cast(sum(case when failed & ~mask = 0 then 1 else 0 end) as bigint) as n_kept_without
from ledger, (values ('few_words', 1), ('repeated_windows', 2), ('many_symbols', 4), ('repeated_lines', 8), ('short_words', 16),
  ('long_words', 32)) r(rule, mask)
group by rule
""",    "op11_fill_in_middle": r"""
with texts as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
    sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents
), drawn as (
  select *, len(units) as n, cast('0x' || substr(h, 1, 8) as bigint) % (len(units) + 1) as a,
    cast('0x' || substr(h, 9, 8) as bigint) % (len(units) + 1) as b, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from texts
), parts as (
  select *, array_to_string(units[1:least(a, b)], '') as prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') as middle,
    array_to_string(units[greatest(a, b) + 1:], '') as suffix,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from drawn
)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256
from parts
""",    "op12_decontamination": r"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item, least(len(w), 10) as l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as gram
  from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from items where len(w) > 0)
), places as (
  select r, i, l, array_to_string(w[i:i + l - 1], ' ') as gram
  from (select r, w, l, unnest(range(1, len(w) - l + 2)) as i from docs, (select distinct l from windows) where len(w) >= l)
), hits as (
  select r, i, p.l, item from places p join windows v on p.l = v.l and p.gram = v.gram
), words as (
  select r, count(distinct k) as n from (select r, unnest(range(i, i + l)) as k from (select distinct r, i, l from hits)) group by r
), found as (
  select r, count(*) as n, string_agg(item, ',' order by item) as joined from (select distinct r, item from hits) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(words.n, 0) as n_hit, coalesce(found.n, 0) as n_items,
  sha256(coalesce(joined, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from docs left join words using (r) left join found using (r)
""",
}
