"""Registry of this package's queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat_render, co_training, deobfuscate, exact_dedup, jaccard_join, language_id,
               merge_replay, phrase_streams, piece_agenda, suffix_dedup, template_leaks, term_trie, token_files)
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_orc(spark, sf_dir):
    return token_files.token_stream(_documents(spark, sf_dir))


@query
def op2_template_leaks(spark, sf_dir):
    return template_leaks.find_leaks(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removal_report(_documents(spark, sf_dir))


@query
def op4_merge_replay(spark, sf_dir):
    return merge_replay.token_digests(_documents(spark, sf_dir))


@query
def op5_co_training(spark, sf_dir):
    return co_training.quality(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query
def op6_chat_render(spark, sf_dir):
    extra = spark.createDataFrame([(-1, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))],
                                  "conv_id long, turn long, role string, text string")
    return chat_render.formatted_digests(
        read_table(spark, sf_dir, "conversations").select(*extra.columns).unionByName(extra))


@query
def op7_language_id(spark, sf_dir):
    return language_id.languages(_documents(spark, sf_dir))


@query
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup_report(_documents(spark, sf_dir))


@query
def op9_toxicity(spark, sf_dir):
    return deobfuscate.toxicity(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query
def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.link_components(_documents(spark, sf_dir))


@query
def op11_term_trie(spark, sf_dir):
    return term_trie.ranked(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op12_piece_agenda(spark, sf_dir):
    return piece_agenda.piece_digests(_documents(spark, sf_dir))


@query
def op13_phrase_streams(spark, sf_dir):
    return phrase_streams.collocations(_documents(spark, sf_dir))
