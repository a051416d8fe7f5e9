"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir), works on all rows that the stage
before it kept, and returns a DataFrame with the columns of ``documents``, but for the last, which
returns the pieces of the packed sequences. ``run`` writes each stage's rows and reads them again, and
deletes the tables that no later stage reads.

In all stages null texts and texts without words stay what they are and are never anybody's copy (but a row whose
source the mix takes nothing of goes, whatever its text), null ids are ids and come first, ties go by the least id and then the text, repeated rows are rows of their own, an
empty table stays empty, and columns of any other name ride along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attesta.llm import lines, minhash, mixing, packing, toxicity
from attesta.llm.runtime import drop, drop_since, mark, written


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the labels of those that are there."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), max_rows=20_000)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus, with at most one word changed, are cut out."""
    return lines.without_repeats(docs, min_words=6)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, similarity 0.8."""
    return minhash.without_near_duplicates(docs, percent=80, words=5)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document may come up to three times."""
    return mixing.mixed(docs, weights=(1, 2, 3), max_repeat=3.0)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens."""
    return packing.pack(docs, size=2048)


STAGES = [
    ("toxicity", _toxicity),
    ("line_dedup", _lines),
    ("minhash_near_dedup", _near_duplicates),
    ("source_mixing", _mixing),
    ("packing", _packing),
]

#: SQL cannot express the classifier; tests/llm/test_llm_pipeline.py compares each stage, and the whole, with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        point, before = mark(), docs
        docs = written(stage(spark, docs, sf_dir))
        drop_since(point, docs)
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
