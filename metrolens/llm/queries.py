"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.llm import (alignment, chunk_dedup, cws, fuzzy_lines, main_text, minmax, mixing, multi_index, one_bit, packing, records,
                           toxicity, url_reputation)
from metrolens.llm.common import table
from metrolens.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-records")
    records.write_records(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), end_id=2)
    return records.read_records(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op3_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op4_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op5_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL["op5_chunk_recipes"] = r"""
with d as (select doc_id, length(coalesce(text, '')) n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) s from documents)
select doc_id, first_value(doc_id) over (partition by s order by n desc, doc_id) keep_id,
       count(*) over (partition by s) group_size,
       doc_id = first_value(doc_id) over (partition by s order by n desc, doc_id) kept, s text_sha256
from d"""


@query
def op6_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "mix_start")


@query
def op7_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "context", "step_id")


@query
def op8_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_minmax_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedupe_lines(table(spark, sf_dir, "documents"))


@query
def op11_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op12_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


@query
def op13_one_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit.hard_negatives(table(spark, sf_dir, "embeddings"))


SQL["op13_one_bit_negatives"] = """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
                  [floor(256 * cast(x as double)) for x in embedding] v
           from embeddings
           where label is not null and len(embedding) > 0 and list_count(embedding) = len(embedding)
             and len([x for x in embedding if not isfinite(x)]) = 0),
s as (select a.vec_id a, b.vec_id b, a.l = b.l same, cast(list_dot_product(a.v, b.v) as bigint) n
      from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select a, b, n from s where same qualify row_number() over (partition by a order by n desc, b) <= 5)
select p.a anchor_id, p.b positive_id,
       cast(row_number() over (partition by p.a, p.b order by s.n desc, s.b) as int) "rank",
       s.b negative_id, p.n positive_score, s.n negative_score
from p join s on s.a = p.a and not s.same and 30 * p.n <= 100 * s.n and 100 * s.n <= 90 * p.n
qualify row_number() over (partition by p.a, p.b order by s.n desc, s.b) <= 10"""
