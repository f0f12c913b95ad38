"""A training corpus from raw documents: five stages, each written before the next one reads it.

toxicity: documents predicted toxic go. simhash: of documents that share 0.8 of
their five-word shingles, in steps, one stays. passages: passages of 50 words or more stay at their earliest place only. benchmark:
documents that hold ten words in a row of a benchmark item go. tokens: token ids of what is left.

A stage is judged on its own input. Null and empty texts, repeated rows, empty tables and other
columns are treated as the operators' docstrings say; all stages but the last return the
columns of `docs`, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import bpe_automaton, decontamination, near_copies, suffix_dedup, toxicity
from skyledger.llm.common import bucket_of, materialize, read_table
from skyledger.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lexicon is learnt from labelled rows of `docs` outside the held-out fifth."""
    sample = toxicity.training_sample(
        docs, read_table(spark, sf_dir, "labels"), "toxic", bucket_of("doc_id", 5) != 0)
    return toxicity.drop_toxic(docs, toxicity.learn_lexicon(sample))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_repeats(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode(docs, VOCABULARY, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("passages", cut_repeated_passages),
    ("benchmark", drop_benchmark_leaks),
    ("tokens", encode_tokens),
]

# No SQL states a learnt lexicon, a SimHash or the merges of a vocabulary; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
