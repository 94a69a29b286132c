"""Corpus pipeline: each stage reads what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import bpe, decontaminate, exact_dedup, jaccard_join, langid
from tidepool.llm.catalog import vocabulary
from tidepool.llm.scratch import shared_folder


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: a document stays if its words have a language (``und`` goes:
    null text, or text without a letter)."""
    found = langid.identify(docs.withColumnsRenamed({"lang_pred": "__lang_pred", "score": "__score"}), langid.train(docs))
    kept = found.where(found["lang_pred"] != langid.UND).drop("lang_pred", "score")
    return kept.withColumnsRenamed({"__lang_pred": "lang_pred", "__score": "score"}).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the smallest doc_id stays."""
    return jaccard_join.drop_near_copies(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents without any benchmark window stay."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: number of ids and digests of the ids and of their decoded text."""
    out = bpe.token_digests(docs.select("doc_id", "text"), bpe.load(vocabulary()))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", keep_known_language),
    ("exact_dedup", keep_distinct),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontaminate", keep_clean),
    ("bpe", encode),
]

#: Language ID has no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
