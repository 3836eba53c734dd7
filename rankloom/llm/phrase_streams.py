"""Phrase collocation mining from count streams in prefix and suffix order.

Words are counted per language; words below ``least`` occurrences can be in no candidate and
cut the texts.  Every other position of the corpus gives one window, itself and up to four
words after it, pre-counted per slice.  The windows are ranged and sorted by Spark in prefix
order, and one pass over that stream counts every phrase of two to five words: the windows of
a phrase stand together.  Phrases that may go on in the next range are summed afterwards.

The phrases with ``least`` occurrences are then kept as two sorted streams.  In suffix order
(words reversed) a phrase's right parts stand before it and its left extensions behind it; in
prefix order its left parts before it and its right extensions behind it.  One lockstep pass
over each stream takes the counts from there; nothing is looked up in a hash table.  A range
holds whole word pairs, so that all phrases that share two words meet in one task.

Of longer candidates only those one word longer need a look: each longer one that has all of a
phrase's occurrences contains such a one with the same count.

Texts are lower-cased in A-Z and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks
and tabs into words.  Null and empty texts have no words, a null language is ``und``; rows
that repeat an id or a text, or have no id, count like any others; other columns are never
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ids import numbered
from ..operators.joins import Dimension
from .common import LOWER, byte_words, discard, give_back, map_batches, slices, stored

LONGEST = 5
#: Words shipped to the tasks at most (about 40 bytes each); beyond, occurrences are shuffled.
MAX_SHIPPED = 2_000_000
#: Text handled together, windows or phrases in a chunk, phrases in a range.
SLICE, CHUNK, RANGE = 8 << 20, 1 << 18, 400_000
LOW = np.int64(0xFFFFFFFF)
KEYS, REVERSED = ["k1", "k2", "k3"], ["r1", "r2", "r3"]

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words of a string column as bytes, the piece of each; pieces of different texts
    have different numbers)."""
    words, starts, rows, b = byte_words(texts, _WORD, LOWER)
    cut = np.zeros(len(b) + 1, np.int64)
    cut[:-1] = _BREAK[b]
    np.add.at(cut, rows[:-1], 1)
    return words, np.cumsum(cut)[starts]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    coded = batch.column(0).dictionary_encode()
    codes = np.asarray(coded.indices)
    for k, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, batch.column(1).filter(pa.array(codes == k))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """(lang, word, f) of words with ``least`` occurrences, and one row a language with a null
    word and the number of all its words."""
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, words, counts = [], [], []
        for lang, column in _by_language(batch):
            coded = split_words(column)[0].dictionary_encode()
            n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary)).astype(np.int64)
            langs += [lang] * (len(n) + 1)
            words.append(pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.nulls(1, pa.binary())]).cast(pa.string()))
            counts.append(np.append(n, n.sum()))
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.concat_arrays(words), pa.array(np.concatenate(counts))],
            names=["lang", "word", "f"])
    return (map_batches(texts, count, "lang string, word string, f long", SLICE)
            .groupBy("lang", "word").agg(F.sum("f").alias("f"))
            .filter(F.col("word").isNull() | (F.col("f") >= least)))


def windows_of(ids: np.ndarray, follows: np.ndarray) -> pa.RecordBatch | None:
    """Counted windows of a run of word ids (from 1; 0: no candidate's word); ``follows`` says
    whether a word stands directly behind the one before it."""
    n = len(ids)
    broken = ~follows | (ids == 0) | (np.append(0, ids[:-1]) == 0)
    run = np.append(np.cumsum(broken), np.full(LONGEST, -1))
    padded = np.append(ids, np.zeros(LONGEST, np.int64))
    w = [padded[k:k + n] * (run[k:k + n] == run[:n]) for k in range(LONGEST)]
    at = np.flatnonzero((w[0] > 0) & (w[1] > 0))
    if not len(at):
        return None
    w = [x[at] for x in w]
    rows = pa.table({"k1": w[0] << 32 | w[1], "k2": w[2] << 32 | w[3], "k3": w[4]})
    rows = rows.group_by(KEYS, use_threads=False).aggregate([([], "count_all")])
    return rows.select([*KEYS, "count_all"]).rename_columns([*KEYS, "c"]).combine_chunks().to_batches()[0]


def windows(texts: DataFrame, vocabulary: DataFrame, max_shipped: int = MAX_SHIPPED) -> DataFrame:
    """(k1, k2, k3, c): up to five word ids in three longs, and how often a slice has them."""
    schema = "k1 long, k2 long, k3 long, c long"
    if vocabulary.count() > max_shipped:
        return _joined_windows(texts, vocabulary, schema)
    by_lang: dict[str, tuple[list, list]] = {}
    for row in vocabulary.select("lang", "word", "id").collect():
        words, ids = by_lang.setdefault(row["lang"], ([], []))
        words.append(row["word"].encode())
        ids.append(row["id"])
    shipped = texts.sparkSession.sparkContext.broadcast(
        {lang: (pa.array(words, pa.large_binary()), np.array([0, *ids], np.int64)) for lang, (words, ids) in by_lang.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            for lang, column in _by_language(batch):
                if lang in shipped.value:
                    words, ids = shipped.value[lang]
                    found, piece = split_words(column)
                    at = np.asarray(pc.index_in(found, value_set=words).fill_null(-1))
                    out = windows_of(ids[at + 1], np.append(False, piece[1:] == piece[:-1])) if len(at) else None
                    if out is not None:
                        yield out
        give_back()
    return texts.mapInArrow(run, schema)


def _joined_windows(texts: DataFrame, vocabulary: DataFrame, schema: str) -> DataFrame:
    """The same from a shuffle join of all occurrences with the vocabulary, sorted by place."""
    def occurrences(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs, places, pieces, found = [], [], [], []
        for k in range(batch.num_rows):
            words, piece = split_words(batch.column(2).slice(k, 1))
            docs.append(np.full(len(words), batch.column(0)[k].as_py()))
            places.append(np.arange(len(words)))
            pieces.append(piece)
            found.append(words)
        at = pa.array(np.concatenate(docs).astype(np.int64))
        row = np.repeat(np.arange(batch.num_rows), [len(d) for d in docs])
        return pa.RecordBatch.from_arrays(
            [at, pa.array(np.concatenate(places).astype(np.int64)), pa.array(np.concatenate(pieces).astype(np.int64)),
             batch.column(1).take(pa.array(row)).cast(pa.string()), pa.concat_arrays(found).cast(pa.binary()).cast(pa.string())],
            names=["doc", "place", "piece", "lang", "word"])
    rows = stored(texts.select(F.monotonically_increasing_id().alias("doc"), "lang", "text"), "texts")
    words = map_batches(rows, occurrences, "doc long, place long, piece long, lang string, word string")
    known = words.join(vocabulary.select("lang", "word", F.col("id").cast("long").alias("id")).hint("merge"), ["lang", "word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({c: pa.array([], pa.int64()) for c in ("doc", "place", "piece", "id")})
        for part in _chunks(batches):
            rows = pa.concat_tables([held, part.select(held.column_names)])
            doc, place, piece, ids = (rows.column(c).to_numpy() for c in held.column_names)
            last = doc == doc[-1]  # the last document may go on
            yield from _one_run(doc[~last], place[~last], piece[~last], ids[~last])
            held = rows.filter(pa.array(last))
        yield from _one_run(*(held.column(c).to_numpy() for c in held.column_names))
        give_back()
    return known.repartition("doc").sortWithinPartitions("doc", "place").mapInArrow(run, schema)


def _one_run(doc: np.ndarray, place: np.ndarray, piece: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(doc):
        follows = np.append(False, (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1]) & (place[1:] == place[:-1] + 1))
        out = windows_of(ids, follows)
        if out is not None:
            yield out


def _chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[pa.Table]:
    """Batches put together to about ``size`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _prefix(keys: list[np.ndarray], n: int) -> list[np.ndarray]:
    """The first ``n`` (2 to 5) words of packed phrases."""
    k1, k2, k3 = keys
    nothing = np.zeros_like(k1)
    return [k1, nothing if n == 2 else k2 & ~LOW if n == 3 else k2, k3 if n == 5 else nothing]


def _lengths(keys: list[np.ndarray]) -> np.ndarray:
    k1, k2, k3 = keys
    return 2 + (k2 >> 32 > 0) + (k2 & LOW > 0) + (k3 > 0)


def _differs(keys: list[np.ndarray]) -> np.ndarray:
    """Whether a row's key is not that of the row before."""
    out = np.ones(len(keys[0]), bool)
    out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


class _Counter:
    """Counts of the phrases of one length in a prefix-ordered stream of windows.  A phrase
    that is the first or last of its range may be in another range too: it is given whatever
    its count."""

    def __init__(self, length: int, least: int):
        self.length, self.least = length, least
        self.open: tuple[list[int], int] | None = None
        self.first = True

    def feed(self, keys: list[np.ndarray], c: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        if not len(c):
            return
        start = np.flatnonzero(_differs(keys))
        sums = np.add.reduceat(c, start)
        keys = [k[start] for k in keys]
        if self.open is not None:
            key, n = self.open
            if all(k[0] == x for k, x in zip(keys, key)):
                sums[0] += n
            else:
                keys, sums = [np.append(x, k) for k, x in zip(keys, key)], np.append(n, sums)
        self.open = [int(k[-1]) for k in keys], int(sums[-1])
        given = sums[:-1] >= self.least
        if len(given) and self.first:
            given[0], self.first = True, False
        yield [k[:-1][given] for k in keys], sums[:-1][given]

    def close(self) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        if self.open is not None:
            yield [np.array([k], np.int64) for k in self.open[0]], np.array([self.open[1]], np.int64)


def _reversed(keys: list[np.ndarray], length: int) -> list[np.ndarray]:
    w = [keys[0] >> 32, keys[0] & LOW, keys[1] >> 32, keys[1] & LOW, keys[2]][:length][::-1]
    w += [np.zeros_like(w[0])] * (LONGEST - length)
    return [w[0] << 32 | w[1], w[2] << 32 | w[3], w[4]]


def phrase_counts(counted: DataFrame, least: int) -> DataFrame:
    """(k1, k2, k3, r1, r2, r3, f) of all phrases of two to five words with ``least``
    occurrences, packed as they are read and reversed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [_Counter(n, least) for n in range(2, LONGEST + 1)]

        def rows(counter, found):
            for keys, f in found:
                if len(f):
                    columns = [*keys, *_reversed(keys, counter.length), f]
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=[*KEYS, *REVERSED, "f"])

        for part in _chunks(batches):
            keys, c = [part.column(k).to_numpy() for k in KEYS], part.column("c").to_numpy()
            lens = _lengths(keys)
            for counter in counters:
                long = lens >= counter.length
                yield from rows(counter, counter.feed(_prefix([k[long] for k in keys], counter.length), c[long]))
        for counter in counters:
            yield from rows(counter, counter.close())
        give_back()
    schema = ", ".join(f"{c} long" for c in [*KEYS, *REVERSED, "f"])
    ordered = counted.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    return (ordered.mapInArrow(run, schema).groupBy(*KEYS, *REVERSED).agg(F.sum("f").alias("f"))
            .filter(F.col("f") >= least))


def lockstep(phrases: DataFrame, order: list[str], parts: int, name: str) -> DataFrame:
    """``phrases`` with, from one pass in the given order, the counts ``name``2 to ``name``4 of
    their first two to four words in that order (0 where they have not more words) and
    ``name``_ext, the highest count of a phrase one word longer in that order."""
    added = [f"{name}{d}" for d in range(2, LONGEST)] + [f"{name}_ext"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        keys, f = [rows.column(k).to_numpy() for k in order], rows.column("f").to_numpy()
        lens = _lengths(keys)
        longer = np.zeros(len(f), np.int64)
        for depth in range(2, LONGEST):
            at = np.flatnonzero(lens >= depth)
            first = np.flatnonzero(_differs(_prefix([k[at] for k in keys], depth)))
            part = np.zeros(len(f), np.int64)
            part[at] = np.repeat(f[at[first]], np.diff(np.append(first, len(at))))
            rows = rows.append_column(f"{name}{depth}", pa.array(np.where(lens > depth, part, 0)))
            if len(at):
                longer[at[first]] = np.maximum.reduceat(np.where(lens[at] == depth + 1, f[at], 0), first)
        yield from rows.append_column(f"{name}_ext", pa.array(longer)).to_batches(max_chunksize=CHUNK)
        give_back()
    schema = ", ".join(f"{c} {t}" for c, t in phrases.dtypes) + "".join(f", {c} long" for c in added)
    return (phrases.repartitionByRange(parts, order[0]).sortWithinPartitions(*order)
            .mapInArrow(run, schema))


def _word(k: int, keys: list[str] = KEYS) -> F.Column:
    """The k-th word id (from 1) of a packed phrase; 0 where it has fewer."""
    key = F.col(keys[(k - 1) // 2])
    return (F.shiftright(key, 32) if k in (1, 3) else key.bitwiseAND(F.lit(0xFFFFFFFF))).cast("int")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, lang_col: str = "lang", text_col: str = "text",
                 max_shipped: int = MAX_SHIPPED) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Candidates have two to five words and ``least`` (1 at least) occurrences a; a cut after the
    first k words gives l, r and floor(1000 a n / (l r)); the lowest score counts, of equal ones
    the smallest k.  Candidates inside a longer one that occurs as often are left out.  Order:
    score and a descending, phrase (UTF-8) ascending.  Numbers are exact: products are
    38-digit decimals."""
    texts = _texts(docs, lang_col, text_col)
    counts = stored(word_counts(texts, least), "word-counts", few=True)
    totals = counts.filter("word is null").select("lang", F.col("f").alias("n"))
    vocabulary = stored(numbered(counts.filter(F.col("word").isNotNull() & (F.col("f") >= least)), ["lang", "word"], "id", start=1)
                        .withColumn("id", F.col("id").cast("int")), "vocabulary", few=True)
    phrases = stored(phrase_counts(windows(texts, vocabulary, max_shipped), least), "phrases")
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-phrases.count() // RANGE))
    rows = lockstep(lockstep(phrases, REVERSED, parts, "r_"), KEYS, parts, "l_")
    best = _scored(rows, Dimension.of(vocabulary), totals).select("lang", "phrase", "a", "n", "best.*")
    # The first ones of every language by two steps, so that a large language is no single task.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = stored(best, "scored")
    spread = max(1, int((best.count() / top) ** 0.5))
    first = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(spread)))
    first = (first.withColumn("at", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
             .filter(F.col("at") <= top))
    out = stored(first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
                 .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations", few=True)
    discard(counts, phrases, best)
    return out


def _scored(rows: DataFrame, vocabulary: Dimension, totals: DataFrame) -> DataFrame:
    """Candidates that no longer one replaces, with their words and their lowest-scoring cut."""
    rows = rows.filter(F.greatest("l__ext", "r__ext") < F.col("f"))
    for k in range(1, LONGEST + 1):
        rows = rows.withColumn(f"w{k}", _word(k))
    side = [F.col("id"), F.col("word"), F.col("f").alias("own"), F.col("lang")]
    for k in range(1, LONGEST + 1):
        named = vocabulary.select(*[c.alias(f"{n}{k}") for n, c in zip(("id", "t", "c", "lang"), side)])
        rows = named.joined_to(rows, F.col(f"w{k}") == F.col(f"id{k}"), "left")
    length = sum((F.col(f"w{k}") > 0).cast("int") for k in range(1, LONGEST + 1))
    rows = (rows.withColumn("size", length).withColumn("lang", F.col("lang1"))
            .withColumn("phrase", F.concat_ws(" ", *[f"t{k}" for k in range(1, LONGEST + 1)])))
    rows = rows.join(F.broadcast(totals), "lang") if totals.count() <= 100_000 else rows.join(totals, "lang")
    whole = "decimal(19,0)"
    last = F.get(F.array(*[f"c{k}" for k in range(1, LONGEST + 1)]), F.col("size") - 1)
    right = F.array(last, "r_2", "r_3", "r_4")  # counts of the last one to four words
    cuts = []
    for k in range(1, LONGEST):
        l = F.col("c1") if k == 1 else F.col(f"l_{k}")
        r = F.get(right, F.col("size") - k - 1)
        score = F.call_function("div", F.col("f").cast(whole) * F.col("n").cast(whole) * F.lit(1000).cast("decimal(4,0)"),
                                l.cast(whole) * r.cast(whole))
        cuts.append(F.when(F.col("size") > k, F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))))
    return rows.select("lang", "phrase", F.col("f").alias("a"), "n", F.array_min(F.array(*cuts)).alias("best"))
