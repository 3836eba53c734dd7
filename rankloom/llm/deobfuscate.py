"""Toxicity by noisy-channel deobfuscation.

Obfuscated words are restored before they are scored.  A suspicious span (letters mixed with
digits or signs, letters spaced out, letters repeated), of any length, becomes a lattice of
characters: every sign may stand for the letters it resembles, separators and repeats may be
dropped, each at a cost, and spaced letters may be parted into words.  A Viterbi search over the lattice under a character trigram model, whose
counts come from all documents, finds the best restorations, exactly.

A document's features are its words and the stems of longer words, as written and as
restored.  A feature's weight is a lower confidence bound of its log-odds between toxic and
clean labelled documents.  A document is scored by the sum of its strongest weights through
a logistic function, fitted on the same documents with each one's own share taken out of
the weights that it is scored with.

Labels are learned from rows that are not held out, at most ``PER_CLASS`` of each class;
the character model counts every document.  Null counts as empty; an empty text, which has
no feature, gets the score of a document without toxic features.  Every row is scored by
itself, rows that repeat an id too; a row without an id counts as held out.  Columns other than the id
and the text are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, is_held_out, map_batches, map_tasks, stored, text_rows, texts_of
from .linear import Logistic, bounded_sample, rows_of, sigmoid

PER_CLASS = 3000
STEM = 4
#: A feature must be in this many toxic documents of the sample and have this log-odds.
MIN_DOCS, MIN_WEIGHT = 3, 1.0
CAUTION = 1.64  # standard errors below the estimate
MAX_FEATURES = 50_000
STRONGEST = 4
LETTERS = 59  # boundary, a-z, the accented letters of Latin-1, any other letter

# What letters a sign resembles.
LOOKS_LIKE = {"0": "o", "1": "il", "!": "il", "|": "li", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s",
              "7": "t", "+": "t", "8": "b", "9": "g", "6": "g", "2": "z", "€": "e", "(": "c", "¡": "i"}
HIDDEN = "*#"  # may stand for any vowel
_LIKE_LETTERS = frozenset(c for c in [*LOOKS_LIKE, *HIDDEN] if not c.isdigit())
SUBSTITUTED, HID, DROPPED, REPEATED = 1.0, 2.5, 0.7, 0.3
BEST = 3
_NAMES = (1 << 61) - 1
REMEMBERED = 64  # longer spans are decoded every time, so that what a worker remembers stays small

_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = r"@$!|+€¡(*#.\-"
# A maximal run of letters, digits and signs that is more than letters.
_MIXED = re.compile(rf"(?<![\w{_SIGNS}])[^\W\d_]*+[\d_{_SIGNS}][\w{_SIGNS}]*+")
_SPACED = re.compile(r"(?<![^\s])[^\s](?:[ \t]{1,3}[^\s]){3,}(?![^\s])")
_REPEATED = re.compile(r"(?<!\w)[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*(?!\w)")
_SEPARATORS = "._-"
_PARTED = re.compile(r"[._\-]+")
_FAR = re.compile(r"[^\w]{3,}")
_SIGN = re.compile(rf"[\d_{_SIGNS}]")
_THRICE = re.compile(r"([^\W\d_])\1\1")

def _code_table() -> np.ndarray:
    table = np.zeros(0x250, np.uint8)
    for c in range(0x250):
        ch = chr(c).lower()
        if ch.isalpha():
            o = ord(ch)
            table[c] = o - 96 if 97 <= o <= 122 else 27 + (o - 0xE0) if 0xE0 <= o <= 0xFE else LETTERS - 1
    return table


_CODES = _code_table()


def codes(text: str) -> np.ndarray:
    """Letter classes of a text; what is no letter is the boundary 0."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(raw) and raw.max() >= 0x250:
        return np.where(raw < 0x250, _CODES[np.minimum(raw, 0x24F)],
                        np.array([LETTERS - 1 if chr(c).isalpha() else 0 for c in raw.tolist()], np.uint8)
                        ).astype(np.uint8)
    return _CODES[raw]


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """How often each letter trigram stands in all documents: a LETTERS^3 table.

    Each slice of a task adds to one table; tables meet in a sum per cell."""
    def run(batches):
        total = np.zeros(LETTERS ** 3, np.int64)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                for start in range(0, len(text), 1 << 20):
                    c = np.concatenate(([0, 0], codes(text[start:start + (1 << 20)]), [0])).astype(np.int32)
                    total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS ** 3)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(at[k:k + 65536].astype(np.int32)),
                                              pa.array(total[at[k:k + 65536]])], names=["cell", "n"])
        give_back()

    found = (text_rows(docs).select("text").mapInArrow(run, "cell int, n long").groupBy("cell")
             .agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(LETTERS ** 3)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return counts.reshape(LETTERS, LETTERS, LETTERS)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), trigrams backed by bigrams and single letters."""
    one = counts.sum((0, 1)) + 1.0
    one /= one.sum()
    two = counts.sum(0)
    two = (two + 5 * one) / (two.sum(-1, keepdims=True) + 5)
    three = (counts + 5 * two) / (counts.sum(-1, keepdims=True) + 5)
    return np.log(three).astype(np.float32)


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each step the strings it may write, with their costs.  A span that begins with a
    space is a phrase without its word boundaries: each of its letters may begin a word."""
    phrase = span.startswith(" ")
    steps, k, s = [], 0, span.lower().strip(" ")
    while k < len(s):
        c, run = s[k], 1
        while k + run < len(s) and s[k + run] == c:
            run += 1
        if c.isalpha():
            if run == 1:
                steps.append([(c, 0.0)])
            elif run == 2:
                steps.append([(c * 2, 0.0), (c, DROPPED)])
            else:
                steps.append([(c * 2, REPEATED), (c, REPEATED)])
        elif c in LOOKS_LIKE:
            ways = [("", DROPPED + 1.5)]
            for a in LOOKS_LIKE[c]:
                ways += [(a, SUBSTITUTED)] + ([(a * 2, SUBSTITUTED)] if run > 1 else [])
            steps.append(ways)
        elif c in HIDDEN:
            steps.append([("", DROPPED)] + [(v, HID) for v in "aeiou"])
        else:
            steps.append([("", DROPPED if not c.isspace() else 0.0)])
        if phrase:
            if c.isalpha() and run > 1:
                steps[-1] += [(f"{c} {c}", 0.0 if run == 2 else REPEATED)]
                steps[-1] += [(f"{c * 2} {c}", REPEATED), (f"{c} {c * 2}", REPEATED)] if run > 2 else []
            if k:
                steps[-1] += [(" " + out, cost) for out, cost in steps[-1] if out]
        k += run
    return steps


def restore(span: str, model: np.ndarray) -> list[str]:
    """The best readings of a span, best first (at most BEST): an exact n-best Viterbi search.

    A state is the last two letters written, and keeps its BEST readings that differ.  The
    readings are linked backwards and told apart by a running hash, so the work grows with
    the span and not with its square."""
    def code(ch: str) -> int:
        o = ord(ch)
        return int(_CODES[o]) if o < 0x250 else LETTERS - 1

    chance, known = model.reshape(-1).item, {}
    states = {0: [(0.0, 0, None)]}  # last two letters -> (score, hash of the text, (what came before, last piece))
    for ways in lattice(span):
        grown: dict[int, dict[int, tuple]] = {}
        for state, readings in states.items():
            for out, cost in ways:
                to, gain = state, -cost
                for ch in out:
                    c = known.get(ch)
                    if c is None:
                        c = known[ch] = code(ch)
                    at = to * LETTERS + c
                    gain += chance(at)
                    to = at % (LETTERS * LETTERS)
                into = grown.setdefault(to, {})
                for score, name, text in readings:
                    for ch in out:
                        name = (name * 1_000_003 + ord(ch) + 1) % _NAMES
                    old = into.get(name)
                    if old is None or score + gain > old[0]:
                        into[name] = (score + gain, name, (text, out) if out else text)
        states = {to: sorted(into.values(), key=lambda r: (-r[0], r[1]))[:BEST] if len(into) > 1 else list(into.values())
                  for to, into in grown.items()}
    ended = sorted(((score + chance(state * LETTERS), name, text) for state, readings in states.items()
                    for score, name, text in readings), key=lambda r: (-r[0], r[1]))
    found = []
    for _, _, text in ended[:BEST]:
        pieces = []
        while text is not None:
            text, out = text
            pieces.append(out)
        if pieces:
            found.append("".join(reversed(pieces)))
    return found


def _hides(span: str) -> bool:
    """Letters together with signs, a letter three times, or signs alone that look like letters."""
    if _WORD.search(span):
        return len(span) > 1 and (_SIGN.search(span) or _THRICE.search(span)) is not None
    return len(set(span)) > 1 and not {"@", "$"}.isdisjoint(span) and set(span) <= _LIKE_LETTERS


def suspicious(text: str) -> list[str]:
    """Spans that may hide words, however long.  Spaced letters are one span, and once more
    with a space before it, as a phrase whose word boundaries are to be found."""
    found = {m.group() for m in _REPEATED.finditer(text)}
    for m in _MIXED.finditer(text):
        span = m.group().strip(_SEPARATORS)
        if not _hides(span):
            continue
        found.add(span)
        found.update(v for v in (span.rstrip("!"), span.lstrip("("), span.strip("!(")) if _hides(v))
        # Separators may also stand between words.
        parts = _PARTED.split(span)
        if len(parts) > 1:
            found.update(filter(_hides, parts))
            if len(parts) > 3 and max(map(len, parts)) == 1:
                found.add(" " + "".join(parts))
        if _FAR.search(span):
            found.update(filter(_hides, (v.strip(_SEPARATORS) for v in _FAR.split(span))))
    for m in _SPACED.finditer(text):
        parts = re.split(r"([ \t]+)", m.group())
        if len(set(parts[::2])) > 1:  # wider gaps part words
            wide = max(map(len, parts[1::2])) > min(map(len, parts[1::2]))
            words = [[parts[0]]]
            for gap, ch in zip(parts[1::2], parts[2::2]):
                if wide and len(gap) > 1:
                    words.append([])
                words[-1].append(ch)
            for word in map("".join, words):
                found.add(word)
                if len(word) > 3 and _WORD.search(word):
                    found.add(" " + word)
    return [s for s in found if len(s) >= 2]


def features(text: str, model: np.ndarray, seen: dict) -> set[str]:
    """Words and stems of a text, as written and as restored.  ``seen`` remembers spans."""
    words = set(_WORD.findall(text.lower()))
    for span in suspicious(text):
        read = seen.get(span)
        if read is None:
            read = [w for reading in restore(span, model) for w in reading.split()]
            if len(span) <= REMEMBERED:
                if len(seen) > 200_000:
                    seen.clear()
                seen[span] = read
        words.update(read)
    return words | {w[:STEM] + "~" for w in words if len(w) > STEM}


def bound(a, b, n1: int, n0: int):
    """Lower confidence bound of the log-odds of a feature in ``a`` of n1 toxic and ``b`` of
    n0 clean documents."""
    return (np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
            - CAUTION * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)))


class Scorer:
    """Counts of the telling features, their weights, and the logistic function over the sum
    of a document's strongest weights."""

    def __init__(self, model: np.ndarray, counts: dict[str, tuple[int, int]], n1: int, n0: int):
        self.model, self.counts, self.n1, self.n0 = model, counts, n1, n0
        self.weights = {f: float(bound(a, b, n1, n0)) for f, (a, b) in counts.items()}
        self.names = set(counts)
        self.bias, self.slope = -3.0, 1.0 if counts else 0.0

    def evidence(self, text: str, seen: dict, label: int | None = None) -> float:
        found = self.names.intersection(features(text, self.model, seen))
        if label is None:
            w = [self.weights[f] for f in found]
        else:  # as if this document were not in the sample
            w = [float(bound(a - label, b - (1 - label), self.n1 - label, self.n0 - (1 - label)))
                 for a, b in map(self.counts.__getitem__, found) if a - label >= MIN_DOCS]
        return sum(sorted((v for v in w if v >= MIN_WEIGHT), reverse=True)[:STRONGEST])


def _labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, toxic) of the sample; copies of a text count once."""
    known = (labels.filter(F.col("toxic").isin(0, 1) & ~is_held_out("doc_id"))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    chosen = bounded_sample(known, F.col("toxic"), per_class)
    rows = rows_of(text_rows(docs), chosen.withColumnRenamed("stratum", "toxic"), "inner")
    return rows.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Scorer:
    model = letter_model(trigram_counts(docs))
    sample = stored(_labelled(docs, labels, per_class), "labelled")

    def listed(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        seen, names, toxic = {}, [], []
        for text, label in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
            own = features(text, model, seen)
            names += own
            toxic += [label] * len(own)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(toxic, pa.int32())],
                                          names=["feature", "toxic"])

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Scorer(model, {}, n1, n0)
    counted = (map_batches(sample.select("text", "toxic"), listed, "feature string, toxic int").groupBy("feature")
               .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    weight = F.log(a / (n1 + 1)) - F.log(b / (n0 + 1)) - CAUTION * F.sqrt(1 / a + 1 / b)
    top = (counted.filter(F.col("a") >= MIN_DOCS).withColumn("weight", weight).filter(F.col("weight") >= MIN_WEIGHT)
           .orderBy(F.col("weight").desc(), "feature").limit(MAX_FEATURES))
    scorer = Scorer(model, {r["feature"]: (r["a"], r["b"]) for r in top.collect()}, n1, n0)

    def weighed(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict = {}
        labels_ = batch.column(1).to_pylist()
        x = [scorer.evidence(t, seen, y) for t, y in zip(texts_of(batch.column(0)), labels_)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], names=["x", "toxic"])

    found = map_batches(sample.select("text", "toxic"), weighed, "x double, toxic int").toArrow()
    x, y = found["x"].to_numpy(), found["toxic"].to_numpy().astype(float)
    m = Logistic(x[:, None], y, l2=0.5)
    slope = float(m.w[1] / m.scale[0])
    if scorer.names and slope > 0:
        scorer.bias, scorer.slope = float(m.w[0] - slope * m.mean[0]), slope
    return scorer


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its text alone."""
    def run(seen: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        z = np.array([scorer.evidence(t, seen) for t in texts_of(batch.column(2))])
        p = sigmoid(scorer.bias + scorer.slope * z)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"])
    rows = text_rows(docs).select("doc_id", is_held_out("doc_id").alias("held_out"), "text")
    return map_tasks(rows, dict, run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
