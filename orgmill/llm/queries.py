"""The operators over their whole tables, with production parameters: what __spark_entry__.py registers."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orgmill.llm import collocations, conversation_repair, decontaminate, exact_dedup, ngram_join, packing, pitman_yor, quality_rules, suffix_dedup, token_counts, token_files, toxicity, url_filter
from orgmill.llm.common import shared_path, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(*quality_rules.COLUMNS)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_item_windows", "reparameterised")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = shared_path(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), at, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_ids(spark, at, with_ids=False)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents")).drop("key")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_toxicity, op3_quality_rules, op4_decontaminate, op5_token_counts, op6_suffix_dedup, op7_packing, op8_ngram_join, op9_pitman_yor, op10_token_files, op11_exact_dedup, op12_conversation_repair, op13_collocations)}
ORACLES: dict[str, str] = {"op4_decontaminate": decontaminate.ORACLE, "op3_quality_rules": quality_rules.ORACLE, "op11_exact_dedup": exact_dedup.ORACLE, "op12_conversation_repair": conversation_repair.ORACLE, "op13_collocations": collocations.ORACLE}
