"""The corpus pipeline: toxic documents go, one of each group of near copies stays, repeated passages go, the rest is
packed into training sequences. Each stage reads what the one before wrote."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.llm import packing, passages, similarity, toxicity
from goldspan.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.3
CAPACITY = 2048
BATCH = 8 << 20  # bytes of whole texts that go to a Python worker at a time


def _small_batches(spark: SparkSession) -> None:
    """The session's batches for Python hold BATCH bytes at most, or a single longer text: a batch is held by the
    executor and by the worker, several times over, while the executor's heap is in use. Smaller settings stay."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH:
        spark.conf.set(name, f"{BATCH}b")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learned from all labels, is below TOXIC. Rows are judged alone, so repeated
    rows, null and empty texts stay or go by their own score."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    return toxicity.score_texts(docs, model, score="_toxicity").where(F.col("_toxicity") < TOXIC).select(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by a Jaccard similarity of 0.75 of their five-word shingles, the one with the least id.
    Documents without words are no copies of each other; rows without id stay; of rows that share an id all stay or go."""
    _small_batches(spark)
    found = similarity.similar_documents(docs.select("doc_id", "text"))
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that also start in a document with a smaller id. Texts that
    lose no word stay as they are, null ones too; a document that loses all of its words stays with an empty text.
    ``n_chars`` is set anew where the text changed."""
    _small_batches(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    # a row's other columns travel as one, so rows that share an id are not mixed up
    return passages.rewrite(docs, others).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of CAPACITY tokens; a null text is empty."""
    _small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), capacity=CAPACITY)


STAGES = [("toxicity", drop_toxic), ("near copies", one_per_group), ("passages", cut_passages), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# A learned classifier decides in the first stage, which SQL cannot repeat.
ORACLE_SQL = None
