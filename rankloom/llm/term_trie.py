"""Ranked lexical search by branch and bound over FP-trees of documents.

For a block of items (the queries) every document keeps only the items' terms.  These
restricted vectors, their terms in order of document frequency, are laid out as a trie:
documents sorted by their vectors share paths, and a node is a range of them.  A node keeps
the highest tf of every term and the lowest length factor m below it.  As a term's part of a
score grows with tf and falls with m, these bound every score in the subtree.  Each item walks
the trie depth-first, best child first, leaves out subtrees whose bound is under its
``top``-th score so far, and scores the documents of the leaves it reaches.

Spark partitions the documents; a task builds one trie after another over bounded slices of
its rows and keeps the ``top`` of every item, which a window then merges.  Statistics of the
corpus come from stored vectors; only those of the items' terms reach the driver, a block of
items at a time.

A document's terms are the maximal runs of letters and digits of ASCII (A-Z lower-cased) and
of all signs beyond; a null or empty text has none and is never found.  Rows that repeat a
doc_id or a text are documents of their own; of equal scores the smaller doc_id is first, rows
without one last.  Items are told apart by their id (a null one included): rows that repeat an
id put their terms together; an item without terms finds nothing.  Other columns are never
read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ids import numbered
from .common import LOWER, byte_words, discard, give_back, map_batches, ragged, stored, text_rows

#: Items searched together.
BLOCK = 512
#: Cells (documents x terms) of one trie, documents of one at most, documents of a leaf.
CELLS, DOCUMENTS, LEAF = 8_000_000, 4_096, 32
SLICE = 4 << 20

_TERM = np.zeros(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _TERM[_first:_last + 1] = True

VECTORS = "doc_id long, n long, terms binary, tfs binary"


def item_terms(text: str | None) -> list[bytes]:
    """Distinct terms of one text, sorted."""
    words = byte_words(pa.array([text or ""], pa.large_string()), _TERM, LOWER)[0]
    return sorted(set(words.to_pylist()))


def vectors(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs) per row: the number of all its terms; the places in ``terms``
    of those it holds and how often, as little-endian 32-bit integers."""
    known = pa.array(terms, pa.large_binary())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, starts, rows, _ = byte_words(batch.column(1), _TERM, LOWER)
        n = np.diff(np.searchsorted(starts, rows))
        at = pc.index_in(words, value_set=known)
        held = np.asarray(at.is_valid())
        row = np.repeat(np.arange(len(n)), n)[held]
        cells, tfs = np.unique(row * len(terms) + np.asarray(at.drop_null()).astype(np.int64), return_counts=True)
        ends = (4 * np.searchsorted(cells, np.arange(len(n) + 1) * len(terms))).astype(np.int32)

        def lists(values):
            return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(values.astype("<i4"))])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int64)), lists(cells % max(len(terms), 1)), lists(tfs)],
                                          names=["doc_id", "n", "terms", "tfs"])
    return map_batches(text_rows(docs, id_col, text_col), run, VECTORS, SLICE)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all integers, number of them in each row) of a column of packed integers."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view("<i4") if data is not None else np.zeros(0, "<i4")
    return flat.astype(np.int64), np.diff(ends) // 4


def document_frequencies(rows: DataFrame, n_terms: int) -> np.ndarray:
    """How many rows of ``vectors`` hold each term."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        df = np.bincount(_flat(batch.column(0))[0], minlength=n_terms)
        at = np.flatnonzero(df)
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(df[at].astype(np.int64))], names=["term", "df"])
    out = np.zeros(n_terms, np.int64)
    for row in map_batches(rows.select("terms"), run, "term long, df long", 32 << 20).groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def part_scores(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores from weights (a column), tfs (terms x documents) and length factors: integers."""
    return (w[:, None] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[None, :]))).sum(axis=0)


class Trie:
    """The FP-tree of a slice of documents as ranges of their sorted vectors.

    ``flat`` holds the documents' terms, numbered by falling document frequency and ascending
    within a document, ``lens`` how many each has."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, flat: np.ndarray, tfs: np.ndarray, lens: np.ndarray, n_terms: int):
        starts = np.cumsum(lens) - lens
        packed = flat.astype(">u4").tobytes()
        order = np.array(sorted(range(len(lens)), key=lambda k: packed[4 * starts[k]:4 * (starts[k] + lens[k])]), np.int64)
        self.ids, self.m = ids[order], m[order]
        cells = ragged(starts[order], lens[order])
        self.lens = lens[order]
        self.starts = np.cumsum(self.lens) - self.lens
        self.flat = np.append(flat[cells], -1)
        self.tf = np.zeros((n_terms, len(order)), np.int32)
        self.tf[flat[cells], np.repeat(np.arange(len(order)), self.lens)] = tfs[cells]
        self._grow()
        leaves = np.flatnonzero(self.children[:, 0] < 0)
        starts = self.ranges[leaves, 0]
        by_place = np.argsort(starts)
        highest = np.maximum.reduceat(self.tf, starts[by_place], axis=1)
        lowest = np.minimum.reduceat(self.m, starts[by_place])
        self.max_tf = np.zeros((n_terms, len(self.ranges)), np.int32)
        self.min_m = np.zeros(len(self.ranges), np.int64)
        self.max_tf[:, leaves[by_place]], self.min_m[leaves[by_place]] = highest, lowest
        for node in range(len(self.ranges) - 1, -1, -1):  # children stand behind their parent
            a, b = self.children[node]
            if a >= 0:
                self.max_tf[:, node] = self.max_tf[:, a:b].max(axis=1)
                self.min_m[node] = self.min_m[a:b].min()

    def _shared(self, lo: int, hi: int, depth: int) -> int:
        """How many first terms the sorted documents lo .. hi - 1 share (``depth`` at least)."""
        n = int(min(self.lens[lo], self.lens[hi - 1]))
        a, b = self.starts[lo], self.starts[hi - 1]
        differ = np.flatnonzero(self.flat[a + depth:a + n] != self.flat[b + depth:b + n])
        return depth + int(differ[0]) if len(differ) else n

    def _grow(self) -> None:
        """Nodes as ranges, each with its range of child nodes (-1: a leaf).  Paths without a
        branch are one node; neighbouring small branches are one leaf."""
        ranges, children = [(0, len(self.ids))], [(-1, -1)]
        waiting = [(0, 0)]
        while waiting:
            node, depth = waiting.pop()
            lo, hi = ranges[node]
            if hi - lo <= LEAF:
                continue
            depth = self._shared(lo, hi, depth)
            ends = self.lens[lo:hi] <= depth
            term = np.where(ends, -1, self.flat[np.where(ends, 0, self.starts[lo:hi] + depth)])
            cuts = (np.flatnonzero(term[1:] != term[:-1]) + 1 + lo).tolist()
            if not cuts:
                continue  # equal vectors
            parts, start, at = [], lo, lo
            for cut in [*cuts, hi]:
                if cut - start > LEAF and at > start:
                    parts.append((start, at))
                    start = at
                at = cut
            parts.append((start, hi))
            children[node] = (len(ranges), len(ranges) + len(parts))
            waiting += [(len(ranges) + k, depth) for k in range(len(parts))]
            ranges += parts
            children += [(-1, -1)] * len(parts)
        self.ranges, self.children = np.array(ranges), np.array(children)


class Best:
    """The ``top`` highest scores of one item; equal scores by id, missing ids last."""

    def __init__(self, top: int):
        self.top, self.threshold = top, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.threshold
        if not good.any():
            return
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[:self.top]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.top:
            self.threshold = max(1, int(self.scores[-1]))


def search(trie: Trie, terms: np.ndarray, w: np.ndarray, best: Best) -> int:
    """Depth-first branch and bound for one item; returns how many documents were scored."""
    bound = part_scores(w, trie.max_tf[terms].astype(np.int64), trie.min_m)
    scored, stack = 0, [0]
    while stack:
        node = stack.pop()
        if bound[node] < best.threshold:
            continue
        a, b = trie.children[node]
        if a >= 0:
            stack += (a + np.argsort(bound[a:b], kind="stable")).tolist()  # the best one is popped first
            continue
        lo, hi = trie.ranges[node]
        scored += int(hi - lo)
        best.offer(part_scores(w, trie.tf[terms, lo:hi].astype(np.int64), trie.m[lo:hi]), trie.ids[lo:hi])
    return scored


#: Stands for a missing id: behind all others.
NO_ID = np.iinfo(np.int64).max


def _block(docs: DataFrame, items: list[tuple[int, list[bytes]]], top: int, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score): the ``top`` of every item of a block, from every task."""
    terms = sorted({t for _, own in items for t in own})
    rows = stored(vectors(docs, terms, id_col, text_col), "vectors")
    n_docs, total = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(rows, len(terms))
    place = np.empty(len(terms), np.int64)  # by falling document frequency
    place[np.argsort(-df, kind="stable")] = np.arange(len(terms))
    at = {t: k for k, t in enumerate(terms)}
    queries = []
    for item, own in items:
        here = [at[t] for t in own if df[at[t]] > 0]
        queries.append((item, place[here].astype(np.int64), np.array([weight(n_docs, int(df[k])) for k in here], np.int64)))
    size = max(LEAF, min(DOCUMENTS, CELLS // max(len(terms), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: Best(top) for item, _, _ in queries}

        def walk(part: pa.Table) -> None:
            part = part.combine_chunks()
            ids = part.column("doc_id").fill_null(NO_ID).to_numpy()
            m = 50 + (50 * part.column("n").to_numpy() * n_docs) // total
            flat, lens = _flat(_column(part, "terms"))
            tfs, _ = _flat(_column(part, "tfs"))
            flat = place[flat]
            order = np.lexsort((flat, np.repeat(np.arange(len(lens)), lens)))
            trie = Trie(ids, m, flat[order], tfs[order], lens, len(terms))
            for item, own, w in queries:
                if len(own):
                    search(trie, own, w, best[item])

        held, n = [], 0
        for batch in batches:
            batch = batch.filter(pc.greater(pc.binary_length(batch.column("terms")), 0))
            for start in range(0, batch.num_rows, size):
                piece = batch.slice(start, size)
                if n + piece.num_rows > size:
                    walk(pa.Table.from_batches(held))
                    held, n = [], 0
                held.append(piece)
                n += piece.num_rows
        if n:
            walk(pa.Table.from_batches(held))
        found = [(item, b) for item, b in best.items() if len(b.ids)]
        if found:
            ids = np.concatenate([b.ids for _, b in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([item for item, _ in found], [len(b.ids) for _, b in found]).astype(np.int64)),
                 pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([b.scores for _, b in found]))],
                names=["item", "doc_id", "score"])
        give_back()
    out = stored(rows.mapInArrow(run, "item long, doc_id long, score long"), "best", few=True)
    discard(rows)
    return out


def _column(part: pa.Table, name: str) -> pa.Array:
    column = part.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def ranked(docs: DataFrame, items: DataFrame, top: int = 50, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's ``top`` documents with a score above 0: item_id, rank (from 1), doc_id, score.

    The query set is taken ``block`` items at a time, each against all documents."""
    spark = docs.sparkSession
    rows = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    named = numbered(rows.select("item_id").distinct(), ["item_id"], "item")
    total = named.count()
    rows = rows.join(F.broadcast(named) if total <= 100_000 else named,
                     rows["item_id"].eqNullSafe(named["item_id"])).select("item", "text")
    parts = []
    for first in range(0, total, block):
        own: dict[int, set[bytes]] = {}
        for row in rows.filter(F.col("item").between(first, first + block - 1)).toLocalIterator():
            own.setdefault(row["item"], set()).update(item_terms(row["text"]))
        parts.append(_block(docs, [(k, sorted(t)) for k, t in sorted(own.items())], top, id_col, text_col))
    if not parts:
        empty = spark.createDataFrame([], "rank int, doc_id long, score long")
        return named.select("item_id").limit(0).crossJoin(empty)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return (found.join(F.broadcast(named) if total <= 100_000 else named, "item")
            .select("item_id", "rank", "doc_id", "score"))
