"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and stripped of punctuation; numbers, units after a number and names
(capitalised words inside a sentence) become typed placeholders, whose values are the slots.
Every five-word window of the resulting template is hashed and hash-joined with the windows
of the benchmark.  Matches of one document and item on one alignment (document position
minus item position) form an occurrence, and its slots must agree: one item value maps to
one document value.  A question with other numbers or names keeps its template and maps
consistently.  Where an item value meets several document values, the most frequent one
counts and the windows with the others do not; windows with the item's own values always
count, and two item values may share a document value.  (``strict`` drops the whole
occurrence for any value that does not map one to one.)

A window with fewer than ``MIN_LITERALS`` words that are no placeholder says little as a
template; it is named by its words as written and has no slots.  An item with at least
``MIN_TEMPLATES`` template windows is known by these; any other item, such as a row of
numbers or names, by all its windows, and is found where it is copied.  A changed slot counts
only in an occurrence of at least ``MIN_TEMPLATES`` windows.

A document is contaminated by an item when the windows that count cover at least
``MIN_SHARE`` of the item's windows.  Items shorter than a window are one window of their
whole length and need an occurrence of that length.  Every row is a document of its own, also
where rows repeat an id or have none; items are told apart by their ids, rows that repeat one
put their windows together.  Extra columns are never read, whatever their names.

The benchmark's window hashes go to every task as a sorted array while there are at most
``MAX_SHIPPED`` of them (8 bytes each); beyond that, document windows are shuffled to the
join instead, with the same rows as the result.  Null and empty texts have no windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_tasks, stored, text_rows, texts_of

WINDOW = 5
MIN_SHARE = 0.4
#: A template window has this many words that are no placeholder (shorter items: half).
MIN_LITERALS = 3
MIN_TEMPLATES = 2
MAX_SHIPPED = 1_000_000
MEMORY = 100_000  # words a task remembers
SLICE = 2 << 20  # bytes of text handled together
#: Ids of contaminated documents broadcast at most (8 bytes each); beyond, a shuffle join.
MAX_DROPPED = 2_000_000

# Units that may follow a number.
UNITS = frozenset("""% $ € £ kg g mg t lb lbs oz km m cm mm mi mile miles ft in l ml s ms min h hr
    hour hours minute minutes second seconds day days week weeks month months year years
    usd eur dollar dollars euro euros cent cents kb mb gb tb hz khz mhz w kw v""".split())

_EDGES = re.compile(r"^[^\w%$€£]+|[^\w%$€£]+$")
_NUMBER = re.compile(r"[$€£]?\d[\d.,:/]*$")
_GLUED = re.compile(r"([$€£]?\d[\d.,:/]*)([^\W\d_]+|%)$")
WORD, NUMBER, UNIT_WORD, NAME, NOTHING = range(5)


def _name(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


_NUM, _UNIT, _PERSON = _name("<num>"), _name("<unit>"), _name("<name>")
_STEP, _RAW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Words:
    """What each distinct word is, learned as they come."""

    def __init__(self):
        self._forget()

    def _forget(self):
        self.number: dict[str, int] = {}
        self.name = np.zeros(0, np.uint64)
        self.kind = np.zeros(0, np.int8)
        self.ends = np.zeros(0, bool)
        self.value: list[str] = []

    def _learn(self, new: list[str]) -> None:
        name, kind = np.zeros(len(new), np.uint64), np.zeros(len(new), np.int8)
        for k, word in enumerate(new):
            core = _EDGES.sub("", word)
            self.value.append(core)
            low = core.lower()
            name[k] = _name(low)
            if not core:
                kind[k] = NOTHING
            elif _NUMBER.match(core) or ((m := _GLUED.match(core)) and m[2].lower() in UNITS):
                kind[k] = NUMBER
            elif low in UNITS:
                kind[k] = UNIT_WORD
            elif len(core) > 1 and core[0].isupper() and not core.isupper():
                kind[k] = NAME
        self.name = np.append(self.name, name)
        self.kind = np.append(self.kind, kind)
        self.ends = np.append(self.ends, [w.rstrip("\"')]}”’»")[-1:] in (".", "!", "?", ":") for w in new])

    def read(self, texts: Iterator[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts, document of each word); words without a letter, digit
        or sign are left out."""
        if len(self.number) > MEMORY:
            self._forget()
        number, found, new = self.number, [], []
        for text in texts:
            words = text.split()
            for w in set(words).difference(number):
                number[w] = len(number)
                new.append(w)
            found.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        if new:
            self._learn(new)
        at = np.concatenate(found) if found else np.zeros(0, np.int32)
        doc = np.repeat(np.arange(len(found)), [len(x) for x in found])
        solid = self.kind[at] != NOTHING
        return at[solid], doc[solid]


def windows(words: Words, at: np.ndarray, doc: np.ndarray, size: int):
    """(window name, its first position, number of literals, template names, is a slot)."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), None, np.zeros(0, bool)
    kind = words.kind[at]
    opens = np.append(True, doc[1:] != doc[:-1])
    starts = opens | np.append(True, words.ends[at[:-1]])
    number = kind == NUMBER
    unit = (kind == UNIT_WORD) & np.append(False, number[:-1]) & ~opens
    person = (kind == NAME) & ~starts
    names = words.name[at].copy()
    names[number], names[unit], names[person] = _NUM, _UNIT, _PERSON
    slot = number | unit | person
    n = len(at) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), names, slot
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ (h >> np.uint64(29))) * _STEP + names[k:k + n]
    held = np.append(0, np.cumsum(~slot))
    literals = held[size:] - held[:-size]
    whole = doc[:n] == doc[size - 1:]
    first = np.flatnonzero(whole)
    return h[first], first, literals[first], names, slot


def _least(size: int) -> int:
    return MIN_LITERALS if size >= WINDOW else (size + 1) // 2


def _as_written(words: Words, at: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Names of the windows at ``first`` by their words, placeholders or not."""
    h = np.full(len(first), _RAW, np.uint64)
    for k in range(size):
        h = (h ^ (h >> np.uint64(29))) * _STEP + words.name[at[first + k]]
    return h


def window_rows(rows: DataFrame, sizes: list[int], wanted: np.ndarray | None = None) -> DataFrame:
    """(doc_id, row_no, window, size, pos, raw, slots) of the windows of (doc_id, text, row_no)
    rows; only the wanted names when those are given.  ``raw`` windows are named as written."""
    schema = "doc_id long, row_no long, window long, size int, pos int, raw boolean, slots array<string>"

    def run(words: Words, batch: pa.RecordBatch) -> pa.RecordBatch | None:
        at, doc = words.read(texts_of(batch.column(1)))
        begin = np.searchsorted(doc, np.arange(batch.num_rows))
        out: list[list] = [[], [], [], [], [], [], []]
        ids, numbers = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        value = words.value
        for size in sizes:
            h, first, literals, _, slot = windows(words, at, doc, size)
            raw = literals < _least(size)
            h[raw] = _as_written(words, at, first[raw], size)
            h = h.view(np.int64)
            if wanted is not None and len(h):
                k = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                hit = wanted[k] == h if len(wanted) else np.zeros(len(h), bool)
                h, first, raw = h[hit], first[hit], raw[hit]
            owner = doc[first] if len(first) else first
            out[0] += [ids[d] for d in owner.tolist()]
            out[1] += [numbers[d] for d in owner.tolist()]
            out[2] += h.tolist()
            out[3] += [size] * len(h)
            out[4] += (first - begin[owner]).tolist() if len(first) else []
            out[5] += raw.tolist()
            out[6] += [[] if r else [value[at[p]] for p in range(f, f + size) if slot[p]] for f, r in zip(first.tolist(), raw.tolist())]
        if not out[0]:
            return None
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)],
                                          names=["doc_id", "row_no", "window", "size", "pos", "raw", "slots"])
    return map_tasks(rows, Words, run, schema, SLICE)


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, window, size, pos, slots, n_windows): five-word windows, or the whole of a
    shorter item; the template windows, or all where those are too few."""
    items = text_rows(benchmark, id_col, text_col).withColumn("row_no", F.lit(0).cast("long"))
    found = window_rows(items, list(range(1, WINDOW + 1)))
    sizes = found.groupBy(F.col("doc_id").alias("item"), "size").agg(
        F.count(F.lit(1)).alias("n"), F.sum((~F.col("raw")).cast("long")).alias("templates"))
    longest = (sizes.groupBy("item").agg(F.max(F.struct("size", "n", "templates")).alias("most")).select("item", "most.*")
               .withColumn("known_by", F.least(F.lit(MIN_TEMPLATES), F.col("n")) <= F.col("templates"))
               .withColumn("n_windows", F.when(F.col("known_by"), F.col("templates")).otherwise(F.col("n")))
               .withColumnRenamed("size", "most_size"))
    return (found.join(longest, F.col("doc_id").eqNullSafe(F.col("item")) & (F.col("size") == F.col("most_size")))
            .filter(~(F.col("known_by") & F.col("raw")))
            .select(F.col("doc_id").alias("item_id"), "window", "size", "pos",
                    F.col("slots").alias("item_slots"), "n_windows"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_share: float = MIN_SHARE, max_shipped: int = MAX_SHIPPED, strict: bool = False) -> DataFrame:
    """(doc_id, item_id, matched, n_windows, share, reworded): one row per contaminated
    row of ``docs`` and item; ``reworded`` says that some slot has another value than the item's.
    ``strict``: an occurrence whose slots do not map one to one counts for nothing; otherwise
    only its windows in conflict do not count (see above)."""
    bench = stored(benchmark_windows(benchmark), "benchmark-windows")
    names = bench.select("window").distinct()
    wanted = None
    if names.count() <= max_shipped:
        wanted = np.sort(np.array([r[0] for r in names.collect()], np.int64))
    sizes = sorted(r[0] for r in bench.select("size").distinct().collect()) or [WINDOW]
    rows = text_rows(docs, id_col, text_col).withColumn("row_no", F.monotonically_increasing_id())
    hits = window_rows(rows, sizes, wanted).withColumnRenamed("pos", "doc_pos").drop("raw")
    line = F.col("doc_pos") - F.col("item_pos")
    pairs = F.array_distinct(F.arrays_zip("item_slots", "slots"))
    occurrences = (hits.join(bench.withColumnRenamed("pos", "item_pos"), ["window", "size"])
                   .groupBy("doc_id", "row_no", "item_id", "n_windows", line.alias("line"))
                   .agg(F.collect_set(F.struct("item_pos", pairs.alias("pairs"))).alias("found"))
                   .withColumn("all_pairs", F.flatten("found.pairs"))
                   .withColumn("slots", F.array_distinct("all_pairs")))
    theirs = F.transform("slots", lambda s: s["item_slots"])
    ours = F.transform("slots", lambda s: s["slots"])
    differs = lambda s: ~s["item_slots"].eqNullSafe(s["slots"])
    changed = F.exists("slots", differs)
    if strict:
        occurrences = occurrences.filter((F.size(F.array_distinct(theirs)) == F.size("slots"))
                                         & (F.size(F.array_distinct(ours)) == F.size("slots")))
    else:
        # Of the document values of an item value the one in most windows wins, then the item's
        # own, then the greatest; the others are in conflict.
        often = F.transform("slots", lambda s: F.struct(
            s["item_slots"].alias("item"), F.struct(
                F.size(F.filter("all_pairs", lambda q: q == s)).alias("n"), (~differs(s)).alias("own"),
                s["slots"].alias("ours")).alias("vote")))
        lost = F.filter("votes", lambda s: F.exists("votes", lambda q: (q["item"] == s["item"]) & (q["vote"] > s["vote"])))
        lost = F.transform(lost, lambda s: F.struct(s["item"].alias("item_slots"), s["vote"]["ours"].alias("slots")))
        stays = lambda w: ~F.exists(w["pairs"], differs) | ~F.arrays_overlap(w["pairs"], F.col("lost"))
        occurrences = (occurrences.withColumn("votes", often).withColumn("lost", lost)
                       .withColumn("found", F.filter("found", stays)).filter(F.size("found") > 0))
    occurrences = (occurrences.withColumn("at", F.array_distinct("found.item_pos"))
                   .filter(~F.exists(F.flatten("found.pairs"), differs) | (F.size("at") >= MIN_TEMPLATES)))
    matched = F.size(F.array_distinct(F.flatten(F.collect_set("at"))))
    return (occurrences.withColumn("changed", changed)
            .groupBy("doc_id", "row_no", "item_id", "n_windows")
            .agg(matched.cast("long").alias("matched"), F.max("changed").alias("reworded"))
            .withColumn("share", F.col("matched") / F.col("n_windows"))
            .filter(F.col("share") >= min_share)
            .select("doc_id", "item_id", "matched", "n_windows", "share", "reworded"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is not contaminated, all columns kept.  Rows that
    repeat an id go together; rows without an id stay."""
    leaks = stored(find_leaks(docs, benchmark, id_col, text_col).filter(F.col("doc_id").isNotNull())
                   .select(F.col("doc_id").alias(id_col)).distinct(), "leaks", batch=SLICE)
    small = leaks.count() <= MAX_DROPPED
    return docs.join(F.broadcast(leaks) if small else leaks, id_col, "left_anti").select(*docs.columns)
