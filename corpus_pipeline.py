"""A corpus pipeline of five stages over ``documents``, each by one operator of ``llm``.

Every stage reads what the one before it kept.  All but the last return the columns of
the documents; the last returns one row per packed piece.  NULL texts fail the quality
rules, so later stages see none when run in order; each stage also takes them alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.config import scratch_dir
from tillwise.llm import best_fit, block_anchors, dart_minhash, disclosure, fertility


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    apart = _apart(docs)
    measured = fertility.measure(
        apart,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.path("piece_bpe_32k.model"),
        keep=tuple(apart.columns),
    )
    return _back(fertility.judged(measured).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    return _back(dart_minhash.one_of_each(_apart(docs)), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word runs that occur elsewhere; texts left empty go."""
    found = block_anchors.remove_repeats(_apart(docs))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    left = found.where(~changed | (F.col("kept_text") != "")).withColumn("text", text)
    return _recounted(_back(left, docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms generalised."""
    return _recounted(_back(disclosure.sanitised(_apart(docs)), docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places."""
    return best_fit.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


_READ = ("doc_id", "text", "lang")


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with other columns renamed by place, so that no name meets an operator's own."""
    return docs.toDF(*(c if c in _READ else f"__column_{i}" for i, c in enumerate(docs.columns)))


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``docs``, in their order and under their names."""
    return rows.select(*_apart(docs).columns).toDF(*docs.columns)


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("personal data", personal_data),
    ("best-fit packing", packing),
]

# tokenisers and weighted min-hashing have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
