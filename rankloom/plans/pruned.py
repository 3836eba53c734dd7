"""Exact top-N by maximum inner product, with blocks that cannot matter left out.

Candidates are ranged by vector norm and cut into blocks, greatest norms first.  No score
can exceed |q| |c|, so a query whose n-th best score so far is above |q| times the greatest
norm of a block needs neither that block nor any later one.  Blocks are taken in rounds of
growing width (1, 1, 2, 4, ...): in each, every packed query block that still needs some is
one task, to which the rows of the candidate blocks that some of its queries need are sent.
They stream past the block, which scores them for those queries only and keeps one list per
query; the n best per query are then merged and give the next round's thresholds.  A round
sends a query once, and candidates that nobody needs are neither shuffled nor scored.

``exclude`` takes pairs that must not be listed (a user's training items): they reach the
task that scores them and are struck out there.

Worst case: candidates of equal norm (unit vectors), or queries whose n-th score is not
positive, need every block, and the whole grid is scored, as ``recommend.top_n`` does.  The
driver sees one number per candidate block.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import materialize
from .recommend import DEFAULT_BLOCK_ROWS, _Lists, rows_of_block

# The block scorer runs in Python workers that may not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: monotonically_increasing_id() holds the partition above this many bits.
PART_BITS = 33
#: Room for rounding in products and norms.
SLACK = 1e-9


@dataclass
class TopN:
    """``lists``: (q, rank, c, score); ``cells``: how many scores were computed for them."""

    lists: DataFrame
    cells: int
    rounds: int


def _normed(factors: DataFrame) -> DataFrame:
    """(id, features, norm); rows without a vector are left out, a norm that is not a number
    counts as infinite."""
    vector = F.col("features").cast("array<double>")
    return (factors.select(F.col("id").cast("long").alias("id"), vector.alias("features")).filter(F.col("features").isNotNull())
            .withColumn("norm", F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x * x)))
            .withColumn("norm", F.when(F.isnan("norm"), F.lit(float("inf"))).otherwise(F.col("norm"))))


def _query_blocks(factors: DataFrame, block_rows: int | None) -> DataFrame:
    """(q_block, q_ids, q_matrix, q_norms), materialised, blocks numbered from 0."""
    def pack(batches):
        part, count, held = TaskContext.get().partitionId(), 0, []

        def block(some):
            return pd.DataFrame({"key": [(part << 32) + count], "q_ids": [np.array([r[0] for r in some], np.int64).tobytes()],
                                 "q_matrix": [np.stack([np.asarray(r[1], np.float64) for r in some]).tobytes()],
                                 "q_norms": [np.array([r[2] for r in some], float).tobytes()]})
        for pdf in batches:
            held += list(zip(pdf["id"], pdf["features"], pdf["norm"]))
            most = block_rows or (rows_of_block(len(held[0][1])) if held else 1)
            while len(held) >= most:
                yield block(held[:most])
                held, count = held[most:], count + 1
        if held:
            yield block(held)

    rows = _normed(factors).repartition(factors.sparkSession.sparkContext.defaultParallelism)
    packed = materialize(rows.mapInPandas(pack, "key long, q_ids binary, q_matrix binary, q_norms binary"))
    # Only the keys, one per block, are numbered together.
    number = F.row_number().over(Window.orderBy("key")).cast("int") - 1
    return packed.join(packed.select("key").withColumn("q_block", number), "key").drop("key")


def _cand_blocks(factors: DataFrame, block_rows: int) -> tuple[DataFrame, np.ndarray]:
    """(c_block, c_id, c_vector, c_norm), materialised, blocks of ``block_rows`` in descending
    order of norm over all rows; and the greatest norm from each block on."""
    rows = _normed(factors)
    parts = max(1, -(-rows.count() // block_rows))
    rows = (rows.repartitionByRange(parts, F.col("norm").desc(), "id").sortWithinPartitions(F.col("norm").desc(), "id")
            .withColumn("at", F.monotonically_increasing_id()))
    # A range's rows are numbered from its start; its blocks ascend.
    place = F.col("at").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    rows = materialize(rows.withColumn("key", F.col("at") - place + F.floor(place / block_rows)).drop("at"))
    heads = rows.groupBy("key").agg(F.max("norm").alias("top")).orderBy("key").collect()
    tops = np.array([r["top"] for r in heads], float)
    numbers = rows.sparkSession.createDataFrame([(r["key"], k) for k, r in enumerate(heads)], "key long, c_block int")
    tops = np.maximum.accumulate(tops[::-1])[::-1] if len(tops) else tops
    return rows.join(F.broadcast(numbers), "key").select("c_block", F.col("id").alias("c_id"), F.col("features").alias("c_vector"),
                                                         F.col("norm").alias("c_norm")), tops


class _Struck:
    """Pairs that must not be listed; ``most``: at most so many per query id."""

    def __init__(self, q: np.ndarray, c: np.ndarray):
        self.q, q_at = np.unique(q, return_inverse=True)
        self.c, c_at = np.unique(c, return_inverse=True)
        self.pairs = np.unique(q_at * len(self.c) + c_at)
        self.most = int(np.bincount(self.pairs // len(self.c)).max())

    def has(self, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        i, j = np.searchsorted(self.q, q).clip(max=len(self.q) - 1), np.searchsorted(self.c, c).clip(max=len(self.c) - 1)
        pair = i * len(self.c) + j
        at = np.searchsorted(self.pairs, pair).clip(max=len(self.pairs) - 1)
        return (self.q[i] == q) & (self.c[j] == c) & (self.pairs[at] == pair)


#: What comes first in a task: the query block, then its struck pairs, then candidates.
BLOCK, PAIRS = -2, -1
SENT = """q_block int, c_block int, q_ids binary, q_matrix binary, q_norms binary, kth array<double>,
          q_id long, c_id long, c_vector array<double>, c_norm double"""


def _scorer(n: int):
    def score(batches):
        block, lists, norms, cells, pairs = None, None, None, 0, []

        def done():
            for r, _, cand, sc in lists.listed() if lists is not None else ():
                yield pd.DataFrame({"q_block": np.full(len(r), block, np.int32), "q_row": r.astype(np.int32), "q": lists.ids[r],
                                    "c": cand, "score": sc, "cells": np.zeros(len(r), np.int64)})
            if lists is not None:
                yield pd.DataFrame({"q_block": [np.int32(block)], "q_row": [np.int32(-1)], "q": [0], "c": [0],
                                    "score": [0.0], "cells": [cells]})

        for pdf in batches:
            kinds, owners = pdf["c_block"].to_numpy(), pdf["q_block"].to_numpy()
            cuts = np.flatnonzero(np.append(True, (kinds[1:] != kinds[:-1]) | (owners[1:] != owners[:-1])))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(pdf))):
                some = pdf.iloc[lo:hi]
                if kinds[lo] == BLOCK:
                    yield from done()
                    row = some.iloc[0]
                    ids, norms = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_norms"], float)
                    kth = None if row["kth"] is None else np.asarray(row["kth"], float)
                    lists = _Lists(ids, np.frombuffer(row["q_matrix"], np.float64).reshape(len(ids), -1), n, kth)
                    block, cells, pairs = owners[lo], 0, []
                elif kinds[lo] == PAIRS:
                    pairs.append(some[["q_id", "c_id"]].to_numpy(np.int64))
                else:
                    if pairs:
                        lists.struck, pairs = _Struck(*np.concatenate(pairs).T), []
                    top = some["c_norm"].max()
                    with np.errstate(invalid="ignore"):
                        need = np.flatnonzero(~(norms * top * (1 + SLACK) + SLACK < lists.kth))
                    if len(need):
                        cells += lists.take(some["c_id"].to_numpy(np.int64), np.stack(some["c_vector"].to_list()).astype(np.float64), need)
        yield from done()
    return score


def _sent(df: DataFrame, kind) -> DataFrame:
    """``df`` with all the columns of ``SENT``; ids 0 where it has none."""
    of = dict(f.strip().split(" ", 1) for f in SENT.split(","))
    kind = F.col("c_block") if kind is None else F.lit(kind)
    return df.select(*[kind.cast("int").alias(c) if c == "c_block" else F.col(c) if c in df.columns
                       else (F.lit(0) if t == "long" else F.lit(None)).cast(t).alias(c) for c, t in of.items()])


def _struck(exclude: DataFrame, queries: DataFrame, cands: DataFrame, q: str, c: str) -> DataFrame:
    """(q_block, c_block, q_id, c_id): the excluded pairs and the blocks that hold their ids."""
    def unpack(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                own = np.unique(np.frombuffer(row.q_ids, np.int64))
                yield pd.DataFrame({"q_id": own, "q_block": np.full(len(own), row.q_block, np.int32)})
    pairs = exclude.select(F.col(q).cast("long").alias("q_id"), F.col(c).cast("long").alias("c_id")).distinct()
    own = queries.select("q_ids", "q_block").mapInPandas(unpack, "q_id long, q_block int")
    return materialize(pairs.join(own, "q_id").join(cands.select("c_id", "c_block").distinct(), "c_id"))


def _best(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.isnan("score"), F.col("score").desc_nulls_last(), "c")
    return rows.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= n)


def pruned_top_n(query_factors: DataFrame, cand_factors: DataFrame, n: int = 10, q: str = "user", c: str = "product",
                 block_rows: int | None = None, cand_block_rows: int | None = None,
                 exclude: DataFrame | None = None) -> TopN:
    """The n best candidates of every query id, ties by lower id; the same rows as
    ``recommend.top_n``, without the pairs in ``exclude`` (columns ``q``, ``c``).

    A NaN score ranks after every number; a repeated candidate id is a candidate with each of
    its rows, a repeated query id gets one list of the best of all its rows.  Runs its rounds
    while it is called; the last merge is lazy."""
    left = _query_blocks(query_factors, block_rows)
    right, tops = _cand_blocks(cand_factors, cand_block_rows or block_rows or DEFAULT_BLOCK_ROWS)
    spark, n_blocks = query_factors.sparkSession, max(1, left.count())
    struck = _struck(exclude, left, right, q, c) if exclude is not None else None
    schema = "q_block int, q_row int, q long, c long, score double, cells long"
    state, thresholds, cells, rounds, lo = None, None, 0, 0, 0
    while lo < len(tops):
        hi = min(len(tops), max(1, 2 * lo))
        if thresholds is None:
            side = left.withColumn("kth", F.lit(None).cast("array<double>")).withColumn("reach", F.lit(len(tops)))
        else:
            side = left.join(thresholds, "q_block")
        side = side.filter(F.col("reach") > lo)
        # The blocks of this round that some query of a query block needs, as rows.
        need = side.select("q_block", F.explode(F.sequence(F.lit(lo), F.least(F.lit(hi), F.col("reach")) - 1)).alias("c_block"))
        sent = _sent(side, BLOCK).unionByName(_sent(right.join(need, "c_block"), None))
        if struck is not None:
            sent = sent.unionByName(_sent(struck.filter(F.col("c_block").between(lo, hi - 1)).join(side.select("q_block"), "q_block")
                                          .select("q_block", "q_id", "c_id").distinct(), PAIRS))
        # A query block is a partition; it is sorted before what is sent to it.
        sent = sent.repartitionById(n_blocks, F.col("q_block")).sortWithinPartitions("q_block", "c_block")
        found = materialize(sent.mapInPandas(_scorer(n), schema))
        cells += found.agg(F.coalesce(F.sum("cells"), F.lit(0))).first()[0]
        rounds += 1
        found = found.filter("q_row >= 0").drop("cells")
        state = found if state is None else state.unionByName(found)
        lo = hi
        if lo < len(tops):
            state = materialize(_best(state, ["q_block", "q_row"], n).drop("rank"))
            # Scores that are no numbers (null from pandas) set no threshold.
            number = F.when(~F.isnan("score"), F.col("score"))
            full = F.when(F.count(number) >= n, F.min(number)).otherwise(F.lit(float("-inf")))
            kth = state.groupBy("q_block", "q_row").agg(full.alias("kth"))
            # Rows of a query block without any score yet have no threshold either.
            rows = left.select("q_block", F.posexplode(F.sequence(F.lit(1), (F.length("q_ids") / 8).cast("int"))).alias("q_row", "one"))
            kth = rows.join(kth, ["q_block", "q_row"], "left").groupBy("q_block").agg(
                F.sort_array(F.collect_list(F.struct("q_row", F.coalesce("kth", F.lit(float("-inf"))).alias("kth")))).alias("rows"))
            thresholds = materialize(_with_reach(left, kth.select("q_block", F.col("rows.kth").alias("kth")), tops))
            if not thresholds.filter(F.col("reach") > lo).head(1):
                break
    if state is None:
        return TopN(spark.createDataFrame([], f"{q} int, rank int, {c} int, score double"), 0, 0)
    lists = _best(state, ["q"], n).select(F.col("q").cast("int").alias(q), "rank", F.col("c").cast("int").alias(c), "score")
    return TopN(lists, cells, rounds)


def _with_reach(left: DataFrame, thresholds: DataFrame, tops: np.ndarray) -> DataFrame:
    """(q_block, kth, reach): with the number of leading candidate blocks that any query of
    the block still needs."""
    def blocks(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                norms, kth = np.frombuffer(row.q_norms, float), np.array(row.kth, float)
                with np.errstate(invalid="ignore"):
                    open_ = [bool((~(norms * t * (1 + SLACK) + SLACK < kth)).any()) for t in tops]
                yield pd.DataFrame({"q_block": [row.q_block], "kth": [list(row.kth)],
                                    "reach": [int(np.flatnonzero(open_).max(initial=-1)) + 1]})
    return left.select("q_block", "q_norms").join(thresholds, "q_block").mapInPandas(blocks, "q_block int, kth array<double>, reach int")
