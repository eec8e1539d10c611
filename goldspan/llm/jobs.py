"""The queries of this subpackage over the provided tables, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.llm import bpe, chat, classlm, codes, neighbours, packing, passages, phrases, search, similarity, tokens, toxicity, vantage

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode_texts(texts, tokenizer_path(VOCABULARY), decoded="decoded"))


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(VOCABULARY), capacity=2048)


def op3_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similar_documents(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.sizes(_table(spark, sf_dir, "documents"), tokenizer_path(VOCABULARY), limit=1024)


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op6_remove_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digests(passages.remove_passages(_table(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.scores(_table(spark, sf_dir, "documents"))


def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.swapped_replies(_table(spark, sf_dir, "conversations"))


def op9_branched_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.branched_replies(_table(spark, sf_dir, "conversations"))


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_copies(_table(spark, sf_dir, "embeddings"), least=0.98).select(
        "vec_id", "n_links", "component_id", F.col("kept"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.codes(_table(spark, sf_dir, "embeddings"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_bpe_round_trip, op2_pack_documents, op3_similar_documents, op4_token_counts, op5_top_k, op6_remove_passages,
    op7_toxicity, op8_class_lm, op9_preference_pairs, op9_branched_pairs,
    op10_near_copies, op11_vector_codes, op12_nearest, op13_phrases)}

ORACLES: dict[str, str] = {
    "op3_similar_documents": similarity.SQL, "op5_top_k": search.SQL, "op6_remove_passages": passages.SQL,
    "op9_preference_pairs": chat.SQL, "op10_near_copies": neighbours.SQL,
    "op11_vector_codes": codes.SQL, "op13_phrases": phrases.SQL}
