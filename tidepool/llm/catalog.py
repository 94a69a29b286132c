"""The registered queries of this package: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import importlib.util
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import bpe, centroids, chat_format, decontaminate, exact_dedup, fill_middle, html_text, jaccard_join, langid, oracle, pii, suffix_dedup, token_store, toxicity
from tidepool.llm.sampling import held_out
from tidepool.llm.scratch import shared_folder


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file: TIDEPOOL_TOKENIZERS, or the installed package of vocabularies."""
    folder = os.environ.get("TIDEPOOL_TOKENIZERS")
    return os.path.join(folder or os.path.dirname(importlib.util.find_spec("public_tokenizers").origin), name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs)).drop("text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.rate(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    out = html_text.extract(pages.select("page_id", "url", "html"), html_text.train(pages))
    return out.select("page_id", "url", "text", "n_chars")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.token_digests(docs, bpe.load(vocabulary())).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(_table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs)
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotate(_table(spark, sf_dir, "conversations"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, rate=100, spm=50)


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens/{uuid.uuid4().hex}"
    tokenizer = token_store.ByteBpe(vocabulary("byte_bpe_50k.json"))
    token_store.write(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer, end=2)
    return token_store.document_digests(spark, path)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed=2)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_html_text": op4_html_text,
    "op5_bpe": op5_bpe,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_langid": op8_langid,
    "op9_decontaminate": op9_decontaminate,
    "op10_chat_format": op10_chat_format,
    "op11_fill_middle": op11_fill_middle,
    "op12_token_store": op12_token_store,
    "op13_centroids": op13_centroids,
}

ORACLE = {
    "op3_exact_dedup": oracle.EXACT_DEDUP,
    "op9_decontaminate": oracle.DECONTAMINATE,
    "op10_chat_format": oracle.CHAT_FORMAT,
    "op11_fill_middle": oracle.FILL_MIDDLE,
    "op13_centroids": oracle.CENTROIDS,
}
