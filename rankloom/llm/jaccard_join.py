"""N-gram Jaccard join with rare-first prefix filtering.

A document's set is its distinct shingles of ``words`` words (four by default; ASCII lower case, words parted by
``[\\x20\\x09-\\x0D]``), as 64-bit names; fewer words are one shingle, none make an empty
set that links with nothing.  Two documents link when their Jaccard similarity is at least
``percent`` (85 by default, compared in integers).

1. One pass names the sets.  Documents with equal sets are one class, of which the smallest
   is the representative; only representatives go on.  The pass also counts the frequent
   shingles.
2. Shingles are ordered rarest first (uncounted ones before counted ones, then by name; any
   fixed order is right).  A representative of n shingles emits its first
   n - ceil(percent * n / 100) + 1; two sets that link share one of these.
3. Buckets of one shingle are never expanded into all their pairs.  First each member is
   paired with its bucket's smallest member and with its neighbour in size: at most two
   pairs per row.  Pairs that pass the length, positional and suffix filters are verified
   once, and the links found join documents into components.
4. Buckets that still hold several components are searched for pairs of different
   components that pass the filters: small ones by a join with themselves, others in blocks
   of ``BLOCK`` members, two blocks a task.  Only pairs that can still join two components
   are verified; links inside a component change nothing and are not looked for.

The suffix filter compares histograms of two sets over ``CELLS`` hash cells (large sets over
``FINE`` cells as well): the sum of the smaller counts bounds the intersection.  The prefix rows of
every shingle are counted, and a bucket of more than ``BLOCK`` rows is split into blocks from
the start, so no task holds a hot bucket, however rare its shingle seemed when sets were named.
Extra columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, give_back, map_batches, measured_joins, ragged, slices, stored, text_rows
from .graph import components

WORDS = 4
PERCENT = 85
CELLS = 256
#: Sets above FINE_FROM shingles are compared over FINE cells as well.
FINE, FINE_FROM = 1024, 512
BLOCK = 1024
#: Buckets of at most so many members are joined with themselves, larger ones searched in blocks.
SMALL = 32
LISTED = 16
#: Frequent shingles whose counts order the others: the most frequent of the corpus.
FREQUENT = 1 << 18
#: A slice of a task (SLICE bytes of text) reports a shingle from this many documents on.
REPORTED = 4
SLICE = 2 << 20
MAX_SHIPPED = 2_000_000  # ids broadcast at most (8 bytes each); beyond, a shuffle join


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _word_names(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit name of every word of all texts, number of words of each text)."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = words.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    names = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    at, owner = np.asarray(coded.indices), np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(words)))
    solid = np.array([w != b"" for w in distinct], bool)[at] if len(at) else np.zeros(0, bool)
    return names[at[solid]], np.bincount(owner[solid], minlength=len(texts))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(the sorted distinct shingle names of every text one after the other, set sizes)."""
    w, n = _word_names(texts)
    size = np.minimum(n, words)  # words of a text's shingles
    many = np.where(n > 0, n - size + 1, 0)  # shingles of a text, repeats included
    start = ragged(np.cumsum(n) - n, many)
    owner_size = np.repeat(size, many)
    h = owner_size.astype(np.uint64)
    for k in range(words):
        there = owner_size > k if k else slice(None)
        x = (h[there] ^ w[start[there] + k]) * _A
        h[there] = x ^ x >> np.uint64(32)
    h *= _B
    h = (h ^ h >> np.uint64(29)).view(np.int64)
    ends = np.cumsum(many)
    for a, b in zip((ends - many).tolist(), ends.tolist()):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    keep[(ends - many)[many > 0]] = True
    return h[keep], np.bincount(np.repeat(np.arange(len(n)), many)[keep], minlength=len(n))


def least_overlap(n_u, n_v, percent: int = PERCENT):
    """The smallest intersection with which sets of these sizes link."""
    return -(-percent * (n_u + n_v) // (100 + percent))


def prefix_length(n, percent: int = PERCENT):
    return n - (-(-percent * n // 100)) + 1


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """One pass: (id, n, digest, cells) of every document, and (token, seen) of frequent
    shingles with a null digest.  ``cells`` is the histogram of the suffix filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "digest", "cells"]
        for batch in slices(batches, SLICE):
            flat, n = shingle_sets(batch.column(1), words)
            ends = np.cumsum(n)
            digest = [xxhash.xxh3_128_digest(flat[a:b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
            cell = np.repeat(np.arange(len(n)), n) * CELLS + (flat & (CELLS - 1))
            cells = np.bincount(cell, minlength=len(n) * CELLS).astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * CELLS), pa.array(cells))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int64)),
                                              pa.array(digest, pa.binary()), cells], names=names)
            token, seen = np.unique(flat, return_counts=True)
            often = seen >= REPORTED
            token, seen = token[often], seen[often]
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(seen), pa.nulls(len(token), pa.binary()),
                                              pa.nulls(len(token), cells.type)], names=names)
        give_back()
    return stored(rows.mapInArrow(run, "id long, n long, digest binary, cells array<int>"), "sets")


def _only(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi- or anti-join on the one column of ``ids``, which are broadcast when their
    checked number is small."""
    small = ids.count() <= MAX_SHIPPED
    return rows.join(F.broadcast(ids) if small else ids, ids.columns[0], how)


def _prefixes(rows: DataFrame, token: np.ndarray, seen: np.ndarray, percent: int, words: int) -> DataFrame:
    """(token, id, n, pos): the rare-first prefix of every set."""
    may = np.zeros(1 << 22, bool)
    may[token & (len(may) - 1)] = True

    def counts(names: np.ndarray) -> np.ndarray:
        out = np.zeros(len(names), np.int64)
        at = np.flatnonzero(may[names & (len(may) - 1)])
        if len(at):
            k = np.minimum(np.searchsorted(token, names[at]), len(token) - 1)
            out[at] = np.where(token[k] == names[at], seen[k], 0)
        return out

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        flat, n = shingle_sets(batch.column(1), words)
        often, ends, take = counts(flat), np.cumsum(n), []
        for a, b, p in zip((ends - n).tolist(), ends.tolist(), prefix_length(n, percent).tolist()):
            if a < b:
                rare = np.flatnonzero(often[a:b] == 0)[:p]
                if len(rare) < p:  # sets are sorted by name, so a stable sort by count is the order
                    rare = np.argsort(often[a:b], kind="stable")[:p]
                take.append(rare + a)
        if not take:
            return None
        size = np.array([len(t) for t in take])
        at = np.concatenate(take)
        ids, n = (np.repeat(x[n > 0], size) for x in (batch.column(0).to_numpy(), n))
        pos = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        kinds = (np.int64, np.int64, np.int32, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip((flat[at], ids, n, pos), kinds)],
                                          names=["token", "id", "n", "pos"])
    return map_batches(rows, run, "token long, id long, n int, pos int", SLICE)


def _buckets(prefixes: DataFrame) -> DataFrame:
    """(token, parts, block, id, n, pos, size): the prefix rows (stored) of shingles that
    several sets list, in as many blocks as their counted rows ask for; a set is in one block
    of a bucket by its id, ``size`` counts a block's rows."""
    hot = stored(prefixes.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > BLOCK), "hot", few=True)
    rows = prefixes.join(F.broadcast(hot) if hot.count() <= MAX_SHIPPED else hot, "token", "left")
    parts = F.coalesce(F.floor(F.col("rows") / BLOCK) + 1, F.lit(1)).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    size = F.count(F.lit(1)).over(W.partitionBy("token", "block"))
    # A block with one member matters only where its shingle has more blocks.
    return (rows.select("token", "parts", "block", "id", "n", "pos").withColumn("size", size)
            .filter("size > 1 or parts > 1"))


def _set_rows(rows: DataFrame, words: int) -> DataFrame:
    """(id, n, fine, set) of some documents; ``fine`` is empty for small sets."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, n = shingle_sets(batch.column(1), words)
        ends = np.append(0, np.cumsum(n)).astype(np.int32)
        fine = [np.bincount(flat[a:b] & (FINE - 1), minlength=FINE).astype(np.int32) if b - a > FINE_FROM else []
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n.astype(np.int32)), pa.array(fine, pa.list_(pa.int32())),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "n", "fine", "set"])
    return map_batches(rows, run, "id long, n int, fine array<int>, set array<long>", SLICE)


def _may_link(n_u: Column, pos_u: Column, n_v: Column, pos_v: Column, percent: int) -> Column:
    """Length and positional filters of a shared prefix shingle."""
    least = F.ceil(percent * (n_u + n_v) / (100.0 + percent) - 1e-9)
    room = F.least(pos_u, pos_v) + 1 + F.least(n_u - pos_u, n_v - pos_v) - 1
    return (100 * F.least(n_u, n_v) >= percent * F.greatest(n_u, n_v)) & (room >= least)


def _verified(pairs: DataFrame, cells: DataFrame, rows: DataFrame, percent: int, words: int) -> DataFrame:
    """The (u, v) of ``pairs`` that link, stored: suffix filter first, then the sets of the
    documents that are left in some pair."""
    side = lambda df, s: df.select(*[F.col(c).alias({"id": s}.get(c, f"{c}_{s}")) for c in df.columns])
    # common / (n_u + n_v - common) >= percent / 100
    links = lambda common: (100 + percent) * common >= percent * (F.col("n_u") + F.col("n_v"))
    shared = lambda c: F.aggregate(F.zip_with(f"{c}_u", f"{c}_v", lambda a, b: F.least(a, b)), F.lit(0),
                                   lambda a, b: a + b)
    near = stored(pairs.join(side(cells, "u"), "u").join(side(cells, "v"), "v").filter(links(shared("cells")))
                  .select("u", "v"), "near", few=True)
    ids = near.select(F.col("u").alias("id")).union(near.select("v")).distinct()
    members = stored(_set_rows(_only(rows, ids, "left_semi"), words), "members")
    fine = members.select("id", "n", "fine")
    nearer = stored(near.join(side(fine, "u"), "u").join(side(fine, "v"), "v")
                    .filter((F.size("fine_u") == 0) | (F.size("fine_v") == 0) | links(shared("fine")))
                    .select("u", "v"), "nearer", few=True)
    sets = members.select("id", "n", "set")
    common = F.size(F.array_intersect("set_u", "set_v"))
    found = stored(nearer.join(side(sets, "u"), "u").join(side(sets, "v"), "v").filter(links(common)).select("u", "v"),
                   "links", few=True)
    discard(near, nearer, members)
    return found


def _star_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Per bucket block: every member with the smallest and with its neighbour in size; and
    the smallest of each block with that of the first."""
    by = W.partitionBy("token", "block").orderBy("n", "id")
    me = F.struct("id", "n", "pos")
    rows = (buckets.withColumn("near", F.lag(me).over(by))
            .withColumn("head", F.min(me).over(W.partitionBy("token", "block"))))
    ends = rows.select(F.explode(F.array_distinct(F.array("head", "near"))).alias("a"), me.alias("b"))
    heads = buckets.filter("parts > 1").groupBy("token", "block").agg(F.min(me).alias("b"))
    first = heads.groupBy("token").agg(F.min("b").alias("a"))
    across = heads.join(first, "token").select("a", "b")
    pairs = ends.union(across).filter(F.col("a").isNotNull() & (F.col("a.id") != F.col("b.id")))
    pairs = pairs.filter(_may_link(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), percent))
    return pairs.select(F.least("a.id", "b.id").alias("u"), F.greatest("a.id", "b.id").alias("v")).distinct()


def _block_pairs(buckets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in a bucket that pass the filters, found block against
    block inside the tasks.  ``buckets`` has the member's component as ``root``."""
    blocks = buckets.groupBy("token").agg(F.max("block").alias("last"))
    k = F.explode(F.sequence(F.lit(0), F.col("last")))
    rows = (buckets.join(blocks, "token").select("token", "block", "id", "n", "pos", "root", k.alias("k"))
            .select("token", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"),
                    "block", "id", "n", "pos", "root"))
    # Members that share many buckets meet in each; a pair is reported in the first bucket of
    # those that both list (the LISTED smallest shingles of a member's buckets), or in every
    # bucket if their lists have none in common.
    order = F.row_number().over(W.partitionBy("id").orderBy("token"))
    listed = (buckets.select("id", "token").distinct().withColumn("k", order).filter(F.col("k") <= LISTED)
              .groupBy("id").agg(F.sort_array(F.collect_list("token")).alias("listed")))
    rows = (rows.join(sizes.select("id", "cells"), "id").join(listed, "id")
            .repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
            .select("token", "i", "j", "block", "id", "n", "pos", "root", "cells", "listed"))

    def search(key, cols) -> pa.RecordBatch | None:
        block, ids, n, pos, root, cells, listed = cols
        listed = [frozenset(v) for v in listed]
        right = np.flatnonzero(block == key[2])
        out = []
        for a in np.flatnonzero(block == key[1]):
            # every pair once: inside one block the later rows, else the other block
            b = right[right > a] if key[1] == key[2] else right
            b = b[(root[b] != root[a]) & (100 * np.minimum(n[b], n[a]) >= percent * np.maximum(n[b], n[a]))]
            need = least_overlap(n[b], n[a], percent)
            room = np.minimum(pos[b], pos[a]) + np.minimum(n[b] - pos[b], n[a] - pos[a])
            b, need = b[room >= need], need[room >= need]
            b = b[np.minimum(cells[b], cells[a]).sum(1) >= need]
            shared = [listed[a] & listed[k] for k in b.tolist()]
            b = b[[not s or min(s) == key[0] for s in shared]] if len(b) else b
            out.append((np.minimum(ids[b], ids[a]), np.maximum(ids[b], ids[a])))
        if not out:
            return None
        u, v = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = np.column_stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(3)])
            cols = [np.asarray(batch.column(c)).astype(np.int64) for c in range(3, 8)]
            cells = np.asarray(batch.column(8).flatten()).reshape(-1, CELLS)
            listed = np.empty(batch.num_rows, object)
            listed[:] = batch.column(9).to_pylist()
            cuts = np.append(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(keys))
            start = 0
            for stop in cuts:
                if start == stop:
                    continue
                now = tuple(keys[start])
                if now != key and held:
                    out = search(key, [np.concatenate(c) for c in zip(*held)])
                    if out is not None and out.num_rows:
                        yield out
                    held = []
                key = now
                held.append([c[start:stop] for c in cols] + [cells[start:stop], listed[start:stop]])
                start = stop
        if held:
            out = search(key, [np.concatenate(c) for c in zip(*held)])
            if out is not None and out.num_rows:
                yield out
        give_back()

    return rows.mapInArrow(run, "u long, v long").distinct()


def _small_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """The same for buckets of at most ``SMALL`` members, as a join of a bucket with itself."""
    cols = ["token", "id", "n", "pos", "root"]
    a, b = (buckets.select("token", *[F.col(c).alias(f"{c}_{s}") for c in cols[1:]]) for s in "uv")
    return (a.join(b, (a["token"] == b["token"]) & (F.col("id_u") < F.col("id_v")) & (F.col("root_u") != F.col("root_v"))
                   & _may_link(F.col("n_u"), F.col("pos_u"), F.col("n_v"), F.col("pos_v"), percent))
            .select(F.col("id_u").alias("u"), F.col("id_v").alias("v")).distinct())


def _labelled(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Bucket rows with their component, of buckets that hold several components."""
    rows = (buckets.join(roots.withColumnRenamed("u", "id"), "id", "left")
            .withColumn("root", F.coalesce("root", "id")))
    rows = stored(rows, "labelled")
    mixed = rows.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    out = stored(rows.join(mixed.select("token"), "token"), "mixed")
    discard(rows)
    return out


def _reached(rows: DataFrame, percent: int, words: int) -> DataFrame:
    """(id, n_shingles, root) of every row of (id, text), stored: the smallest id that it reaches
    by links, null without any."""
    found = _sets(rows, words)
    named = found.filter(F.col("digest").isNotNull())
    classes = (named.filter("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")))
    copies = (named.filter("n > 0").join(classes.filter("size > 1"), "digest")
              .select("id", "rep").filter("id <> rep"))
    copies = stored(copies, "copies", few=True)
    often = (found.filter(F.col("digest").isNull()).groupBy(F.col("id").alias("token"))
             .agg(F.sum("n").alias("seen")).orderBy(F.col("seen").desc(), "token").limit(FREQUENT)
             .toArrow().sort_by("token").combine_chunks())
    token, seen = often["token"].to_numpy(), often["seen"].to_numpy()

    reps = _only(rows, copies.select("id"), "left_anti")
    prefixes = stored(_prefixes(reps, token, seen, percent, words), "prefixes")
    buckets = stored(_buckets(prefixes), "buckets")
    discard(prefixes)
    cells = named.select("id", F.col("n").cast("int").alias("n"), "cells")
    links = _verified(_star_pairs(buckets, percent), cells, rows, percent, words)
    mixed = _labelled(buckets, components(links))
    small = F.expr(f"parts = 1 and size <= {SMALL}")
    rest = _small_pairs(mixed.filter(small), percent).union(_block_pairs(mixed.filter(~small), cells, percent))
    roots = components(links.union(_verified(rest.distinct(), cells, rows, percent, words)))
    discard(buckets, mixed)

    reached = stored(named.join(copies, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
                     .join(roots.withColumnRenamed("u", "rep"), "rep", "left")
                     .select("id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("root")), "reached", few=True)
    discard(found, copies)
    return reached


def link_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest doc_id that its
    document reaches by links, itself included; null if it and they have none).

    Documents are told apart by doc_id; where ids repeat or are null, by id and text."""
    base = text_rows(docs, id_col, text_col)
    ids = base.select("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("k")).first()
    repeats = ids["n"] != ids["k"] or not base.groupBy("doc_id").count().filter("count > 1").isEmpty()
    key = F.xxhash64("doc_id", "text") if repeats else F.col("doc_id")
    rows = base.select(key.alias("id"), "text")
    if repeats:
        rows = rows.dropDuplicates(["id"])

    with measured_joins(docs.sparkSession):
        reached = _reached(rows, percent, words)
    if not repeats:
        return reached.select(F.col("id").alias("doc_id"), "n_shingles", F.col("root").alias("component_id"))
    own = base.select("doc_id", key.alias("id")).join(reached, "id")
    least = own.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return own.join(least, "root").select("doc_id", "n_shingles", "component_id")


def one_per_group(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                  words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` of which each group of linked documents keeps one: that with the
    smallest id.  Rows without an id stay; rows that repeat an id stay or go together."""
    linked = link_components(docs, percent, id_col, words=words)
    losers = linked.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return _only(docs, losers, "left_anti").select(*docs.columns)
