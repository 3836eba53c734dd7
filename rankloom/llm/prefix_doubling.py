"""Repeated byte strings by distributed prefix doubling, over every byte position.

Ranks are those of a suffix array cut at ``length`` bytes.  The first rank of a position is
the order of its 16 bytes.  From ranks at length h, Spark pairs each position with the rank h
further on (for the last length: so far on that the two strings overlap and end together),
sorts the distinct pairs, and numbers them: the ranks at the next length.

A rank that occurs in one document only is unique for our purpose.  It is dropped with its
positions, as no longer string that holds it can occur in a second document; so each offset
handles only what is still repeated, and the work ends when nothing is left or ``length`` is
reached.

Before positions are sorted, equal pairs are aggregated in every task, and only distinct pairs
are numbered, so a string that fills a third of the corpus is one row of the sort; handing the
ranks back to the positions is a join whose hot keys adaptive execution splits.

It shuffles many times the corpus (figures in the README), so ``suffix_dedup.removal_report``
takes it as ``find=prefix_doubling.repeated_spans`` and uses sparse fingerprints by itself.
Same spans either way.  Texts are bytes; null raw bytes count as empty, texts shorter than
``length`` have no span, an empty table gives an empty one; equal rows are documents of their
own, told apart by ``doc``, and columns other than ``doc`` and ``raw`` are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ids import numbered
from .common import discard, give_back, stored

FIRST = 16  # bytes that the first sort orders: two words of eight
PART = 1 << 18  # byte positions put out at once


def offsets(length: int) -> list[tuple[int, int]]:
    """(offset of the second rank, length reached) of each doubling after the first sort."""
    if length < FIRST:
        raise ValueError(f"length {length} is under the first {FIRST} bytes")
    steps, size = [], FIRST
    while size < length:
        further = min(size, length - size)
        steps.append((further, size + further))
        size += further
    return steps


def _first_pairs(texts: DataFrame, length: int) -> DataFrame:
    """(doc, at, a, b): every position whose 16 bytes lie in a text that has a whole string;
    (a, b) are the bytes as two numbers that sort as the bytes do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not value.is_valid:
                    continue
                raw = np.frombuffer(value.as_buffer(), np.uint8)
                if len(raw) < length:
                    continue
                for start in range(0, len(raw) - FIRST + 1, PART):
                    part = raw[start:start + PART + FIRST - 1]
                    words = np.lib.stride_tricks.sliding_window_view(part, 8).copy().view(">u8").ravel()
                    words = (words.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                    n = len(words) - 8
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, doc, np.int64)), pa.array(np.arange(start, start + n)),
                         pa.array(words[:n]), pa.array(words[8:])], names=["doc", "at", "a", "b"])
        give_back()
    return texts.select(F.col("doc").cast("long"), "raw").mapInArrow(run, "doc long, at long, a long, b long")


def _reranked(pairs: DataFrame) -> DataFrame:
    """(doc, at, rank, first): positions whose pair occurs in two documents, with the place of
    the pair among those pairs in sorted order and the smallest document that has it."""
    shared = (pairs.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
              .filter("first < last").select("a", "b", "first"))
    return pairs.join(numbered(shared, ["a", "b"], "rank"), ["a", "b"]).select("doc", "at", "rank", "first")


def ranked_positions(texts: DataFrame, length: int = 50) -> DataFrame:
    """(doc, at, rank, first) of the positions of ``texts`` (doc, raw) whose ``length`` bytes
    also start in another document: rank orders these strings, first is the smallest
    document that has the string."""
    pairs = stored(_first_pairs(texts, length), "pairs")
    ranks = stored(_reranked(pairs), "ranks")
    discard(pairs)
    for further, _ in offsets(length):
        second = ranks.select("doc", (F.col("at") - further).alias("at"), F.col("rank").alias("b"))
        pairs = stored(ranks.select("doc", "at", F.col("rank").alias("a")).join(second, ["doc", "at"]), "pairs")
        discard(ranks)
        ranks = stored(_reranked(pairs), "ranks")
        discard(pairs)
    return ranks


def repeated_spans(texts: DataFrame, length: int = 50) -> DataFrame:
    """(doc, at): per document the list of maximal (start, stop) runs of bytes covered by a
    string of ``length`` bytes that also starts in a smaller document."""
    ranks = ranked_positions(texts, length)
    starts = ranks.filter("first < doc").select("doc", "at")
    gap = F.col("at") - F.row_number().over(W.partitionBy("doc").orderBy("at"))
    runs = (starts.withColumn("run", gap).groupBy("doc", "run")
            .agg(F.min("at").alias("start"), (F.max("at") + length).alias("stop")))
    spans = stored(runs.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("at")), "spans")
    discard(ranks)
    return spans
