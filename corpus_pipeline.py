"""Corpus pipeline: toxicity filter, exact and near deduplication, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs; all but the last return the columns of ``documents``. ``run`` applies them to the table. Stages work
on all rows and whole texts of their predecessor. SQL can't express training, tokenising and packing, so ORACLE_SQL
is None; tests compare ``run`` with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metrolens.llm import chunk_dedup, minmax, mixing, packing, toxicity
from metrolens.llm.common import DOCUMENT_COLUMNS, table
from metrolens.llm.queries import vocabulary
from metrolens.session import scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENT_COLUMNS)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunk_dedup.drop_exact_duplicates(docs.select(*DOCUMENT_COLUMNS))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minmax.drop_near_duplicates(docs.select(*DOCUMENT_COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs.select(*DOCUMENT_COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=1)


STAGES = [("toxicity", without_toxic), ("exact_dedup", without_copies), ("near_dedup", without_near_copies),
          ("mixing", mixed), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
