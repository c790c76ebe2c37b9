"""A corpus from raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, id_crc32
from tidemark.llm.decontaminate import leaks
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.packing import packed_documents
from tidemark.llm.quality import good_documents
from tidemark.llm.secrets import without_secrets

#: Tokenizer file and capacity of the sequences.
TOKENIZER, CAPACITY = "word_bpe_49k.json", 2048


def good_ones(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject; it learns from labels of two thirds of the ids.

    Null and empty texts are scored as empty ones; rows without an id, or that repeat one, are scored each for itself.
    An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return good_documents(docs, labels, id_crc32() % 3 == 1)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates: five words, 0.8.

    Of rows that repeat an id the smallest by their other columns, in order, stays; so a rerun keeps the same one.  Rows
    without an id are in no group and stay, and so do texts without words.  An empty table stays empty.
    """
    found = near_duplicates(docs, width=5, percent=80).where("kept and doc_id is not null")
    kept = docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    single = kept.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", "row.*")
    return single.select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows without an id cannot be named and stay.

    Of rows that repeat an id all go where one of them holds an item.  Null and empty texts hold nothing.
    """
    held = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti").select(*docs.columns)


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced, n_chars as it is then; null and empty texts stay as they are.

    Needs the columns of documents, n_chars among them.
    """
    clean = without_secrets(docs)
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences; a null or empty text is its end alone, each row a document of its own."""
    return packed_documents(docs, public_tokenizers.path(TOKENIZER), capacity=CAPACITY)


STAGES = [
    ("quality_classifier", good_ones),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", masked_secrets),
    ("packing", packed),
]

#: Trained scores, searches and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; every stage reads what the one before has written."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = space.store(docs, name)
    return docs
