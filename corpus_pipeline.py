"""A corpus from raw documents to packed sequences, in five stages.

Each stage reads what the one before wrote, works on all of it, and but for the last returns the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import decontaminate, langid, packing, quality, simhash
from tidelake.llm.base import crc_split, settle, ship
from tidelake.llm.queries import CAPACITY, encoder


def unnamed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with its columns numbered, so that none is replaced by one that a model adds; and what ``text`` is called."""
    numbered = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    return numbered, numbered.columns[docs.columns.index("text")]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; ``lang`` and all other columns stay as they are."""
    ship(spark)
    numbered, text = unnamed(docs)
    key, lang = (numbered.columns[docs.columns.index(c)] for c in ("doc_id", "lang"))
    return langid.identify(numbered, ~crc_split(F.col(key), 4, 2), key, text, lang).where("accepted").select(*numbered.columns).toDF(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that reach the top grade with a probability of 0.3 or more; grades are learned from ``labels``."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.where(~crc_split(F.col("doc_id"), 3, 1)))
    numbered, text = unnamed(docs)
    return quality.grade(numbered, model, text).where("accepted").select(*numbered.columns).toDF(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that of the smallest doc_id."""
    ship(spark)
    return simhash.keep_one(docs, words=3, bits=3).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages, or less than a twentieth of their words."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, items).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    ship(spark)
    packed = packing.pack_documents(docs.select("doc_id", "text"), encoder, "byte_bpe_50k", CAPACITY)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Models and fingerprints have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
