"""A training corpus from documents: toxic ones go, one of each group of near copies stays, repeated passages are cut,
benchmark leaks go, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again for the next one. All
but the last return the columns of documents. Empty tables, nulls and repeated rows: see the operators; a document
whose whole text repeats earlier ones stays with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmill.llm import decontaminate, ngram_join, packing, suffix_dedup, toxicity
from orgmill.llm.common import table
from orgmill.shared import scratch, shared_path, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word shingles of five words at a Jaccard similarity of 0.8 or more; op8's 4 and 0.85 bind that query only."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", packed_sequences),
]

#: No SQL expresses the classifier, the similarity classes or the packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is a table in the shared folder; what a stage stores on its way is deleted with its end."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        at = shared_path(spark, name)
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            written(out, at)
        docs = spark.read.schema(out.schema).parquet(at)
    return docs
