"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased; digits, ASCII punctuation and white space become one space each;
its byte n-grams (2 to 4) are hashed into ``BUCKETS`` rows of an embedding table.  The mean
of the rows goes through a linear softmax.  Embeddings and softmax are trained together by
stochastic gradient descent in numpy, on a bounded sample: at most ``per_lang`` documents
of every language, whole, plus two short windows of each so that short texts are known too.
Since the softmax is linear in the mean, documents are scored with the product of the two
tables, one small row per bucket.

A held-back fifth of the sample sets a temperature, which calibrates the score, and the
rejection threshold: the smallest score above which at least ``TRUST`` of the predictions
are right.  ``rejected`` marks scores below it; the prediction itself stands.

Texts that are null or have no letter get ``und`` and score 0, as does every text when no
labelled row exists.  Every row is predicted by itself, rows that repeat an id too; a row
without an id counts as held out.  Columns other than the id, the text and, to learn from, the language are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, map_batches
from .linear import bounded_sample, rows_of

BUCKETS = 1 << 15
DIM = 16
PER_LANG = 384
TRUST = 0.99
SLICE = 1 << 20  # bytes hashed at once

_LETTER = re.compile(r"[^\W\d_]")
_BLANK = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))


def _grams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text, a slice at a time."""
    raw = b" " + text.lower().encode("utf-8", "surrogatepass").translate(_BLANK) + b" "
    for start in range(0, max(1, len(raw) - 3), SLICE):
        b = np.frombuffer(raw[start:start + SLICE + 3], np.uint8).astype(np.uint32)
        h = b[:-1] * np.uint32(0x9E3779B1) ^ b[1:] * np.uint32(0x85EBCA77)
        yield h >> np.uint32(17)
        if len(b) > 2:
            h = h[:-1] * np.uint32(0x01000193) ^ b[2:] * np.uint32(0xC2B2AE3D)
            yield h >> np.uint32(17)
        if len(b) > 3:
            h = h[:-1] * np.uint32(0x01000193) ^ b[3:] * np.uint32(0x27D4EB2F)
            yield h >> np.uint32(17)


def _counts(text: str) -> np.ndarray:
    total = np.zeros(BUCKETS)
    for g in _grams(text):
        total += np.bincount(g, minlength=BUCKETS)
    return total


def _sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """(lang, doc_id, size, at, share) of the sample: buckets and their shares, for the whole text
    and for two windows of it."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                           & ~is_held_out("doc_id")).select("doc_id", "lang")
    chosen = bounded_sample(labelled, F.col("lang"), per_lang).select("doc_id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = [[], [], [], [], []]
        for doc_id, lang, text in zip(*(batch.column(k) for k in range(3))):
            doc_id, lang, text = doc_id.as_py(), lang.as_py(), text.as_py()
            rng = np.random.default_rng(doc_id & 0xFFFFFFFF)
            parts = [text]
            for size in (40, 160):
                start = int(rng.integers(0, max(1, len(text) - size)))
                parts.append(text[start:start + size])
            for part in parts:
                if _LETTER.search(part):
                    c = _counts(part)
                    at = np.flatnonzero(c)
                    found = (lang, doc_id, len(part), at.astype(np.int32), (c[at] / c.sum()).astype(np.float32))
                    for k, v in enumerate(found):
                        out[k].append(v)
        if not out[0]:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0]), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
             pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.list_(pa.float32()))],
            names=["lang", "doc_id", "size", "at", "share"])

    rows = rows_of(docs.select("doc_id", "lang", "text"), chosen)
    return map_batches(rows, run, "lang string, doc_id long, size int, at array<int>, share array<float>")


class Model:
    """Languages, the product table, the temperature and the rejection threshold."""

    def __init__(self, langs, table, bias, temperature=1.0, threshold=0.0):
        self.langs, self.table, self.bias = langs, table, bias
        self.temperature, self.threshold = temperature, threshold

    def score(self, text: str) -> tuple[str, float]:
        total, n = np.zeros(len(self.langs)), 0
        for g in _grams(text):
            total += self.table[g].sum(0, dtype=np.float64)
            n += len(g)
        p = _softmax((total / max(n, 1) + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(docs: DataFrame, per_lang: int = PER_LANG, epochs: int = 6, rate: float = 40.0) -> Model | None:
    rows = _sample(docs, per_lang).toArrow().sort_by([("doc_id", "ascending"), ("size", "descending")]).combine_chunks()
    if not rows.num_rows:
        return None
    lang, doc_id = rows["lang"].to_pylist(), rows["doc_id"].to_numpy()
    langs = sorted(set(lang))
    y = np.array([langs.index(v) for v in lang])
    at = [v.values.to_numpy() for v in rows["at"]]
    share = [v.values.to_numpy() for v in rows["share"]]
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    held = doc_id % 5 == 0
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(y))
    total, done = epochs * len(fit), 0
    for _ in range(epochs):
        for k in rng.permutation(fit):
            step = rate * (1 - done / total)
            done += 1
            mean = share[k] @ emb[at[k]]
            err = _softmax(mean @ soft + bias)
            err[y[k]] -= 1
            down = soft @ err
            soft -= 0.02 * step / rate * 10 * np.outer(mean, err)
            bias -= 0.002 * step / rate * err
            emb[at[k]] -= step * 0.5 * share[k][:, None] * down
    table = (emb @ soft).astype(np.float32)
    if not held.any():
        return Model(langs, table, bias)
    z = np.stack([share[k] @ table[at[k]] + bias for k in np.flatnonzero(held)])
    truth = y[held]
    rows_at = np.arange(len(truth))
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(z / t)[rows_at, truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / temperature)
    order = np.argsort(-p.max(1))
    right = np.cumsum(p.argmax(1)[order] == truth[order]) / np.arange(1, len(order) + 1)
    trusted = np.flatnonzero(right >= TRUST)
    threshold = float(p.max(1)[order][trusted[-1]]) if len(trusted) else 1.0
    return Model(langs, table, bias, temperature, threshold)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row, from its text alone."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score, rejected = [], [], []
        for text in batch.column(2):
            text = text.as_py()
            known = model is not None and text is not None and _LETTER.search(text)
            best, p = model.score(text) if known else ("und", 0.0)
            lang.append(best)
            score.append(p)
            rejected.append(not known or p < model.threshold)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
             pa.array(rejected, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out("doc_id").alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out, then identify every row."""
    return identify(docs, train(docs))
