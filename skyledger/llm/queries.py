"""One query for each operator over its whole table, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import (
    bpe_automaton,
    conversation_repair,
    decontamination,
    kneser_ney,
    language_id,
    quality_ledger,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from skyledger.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op6_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_automaton.encode(read_table(spark, sf, "documents"), VOCABULARY, with_ids=False)


@query
def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf, "documents"), VOCABULARY)


@query
def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = quality_ledger.ledger(read_table(spark, sf, "documents"))
    return quality_ledger.verdicts(quality_ledger.judge(found))


ORACLE_SQL["op8_quality_rules"] = quality_ledger.ORACLE_SQL


@query
def quality_ablations(spark: SparkSession, sf: str) -> DataFrame:
    """What each rule removes under each policy, over the ledger of all documents."""
    return quality_ledger.ablations(quality_ledger.ledger(read_table(spark, sf, "documents")))


ORACLE_SQL["quality_ablations"] = quality_ledger.ABLATIONS_SQL


@query
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_held_out(
        read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@query
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.predict_held_out(read_table(spark, sf, "documents"))


@query
def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.decontaminate(
        read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return found.drop("text_key")


ORACLE_SQL["op2_decontamination"] = decontamination.ORACLE_SQL


@query
def op5_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    return kneser_ney.score_held_out(read_table(spark, sf, "documents"))


@query
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf, "pages"))


@query
def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.passages(read_table(spark, sf, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    damaged = conversation_repair.damage(read_table(spark, sf, "conversations"))
    return conversation_repair.reports(damaged)


@query
def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf, "documents"))


@query
def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.repeated_passages(read_table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE_SQL["op11_substring_dedup"] = substring_dedup.ORACLE_SQL
