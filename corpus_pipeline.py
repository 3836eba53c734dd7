"""The training-data pipeline over ``documents``: five stages, each written and read again.

1. quality: the co-trained classifier; documents it rejects go;
2. exact dedup: of equal texts the smallest doc_id stays (digest index, anti-join);
3. near dedup: of documents linked at a Jaccard similarity of 0.8 over five-word shingles one
   stays;
4. decontamination: documents that carry a benchmark passage go;
5. tokens: byte-level BPE ids of what is left, and a round trip.

Stages 1 to 4 return the columns they were given; stage 5 returns one row per document:
doc_id, n_tokens, ids_sha256, decoded_sha256.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm import co_training, exact_dedup, jaccard_join, merge_replay, template_leaks
from rankloom.llm.common import read_table, stored

NEAR_WORDS, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return co_training.accepted(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs, NEAR_PERCENT, words=NEAR_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return template_leaks.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return merge_replay.token_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
    ("decontaminate", decontaminate), ("tokens", tokens)]

#: The trained first stage has no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
