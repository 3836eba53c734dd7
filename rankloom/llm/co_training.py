"""Quality classification by co-training.

Two views of a document have a classifier each:

* text content: character shares, word repetition, word lengths;
* page metadata: source, language, declared length and the layout (lines, their lengths,
  repeated lines).

Both start from the same labelled documents (at most ``PER_CLASS`` of each class, the only
sample).  The features of every unlabelled document are computed once, by the tasks, and
stored; texts never leave them.  In each of ``ROUNDS`` rounds all unlabelled documents are
scored by both views, and each view hands every document that it is sure of, and that the
other one does not contradict with confidence, to the other view's training set; both views
are then fitted anew by Newton steps whose sums Spark adds up over the stored features.  So
the pseudo-labels grow with the corpus, and nothing but those sums (one number per pair of
features) reaches the driver.  The pseudo-labelled documents of a class weigh together
``HANDED_OVER`` times what its labelled ones do.

Each view is then calibrated on labelled documents that neither was trained on, the two
calibrated views are combined there, and every document is scored with the combination.
Classes are weighted to their true frequencies.  score is the probability of label 1; a
document with score < 0.5 is rejected.  Null counts as the empty text, which is scored 0;
without labels of both classes every other document is scored 1.  Every row gets its own
score, rows that repeat an id or have none included; a labelled id that has several rows is
learned from the first of them by text, rows without an id are unlabelled.  Missing columns
count as null, extra ones are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, give_back, map_batches, slices, stored
from .linear import MAX_SHIPPED, Logistic, View, bounded_sample, newton_sums, rows_of, sigmoid

PER_CLASS = 1500
ROUNDS = 4
#: Newton steps of a round (each starts where the round before ended).
STEPS = 3
HANDED_OVER = 1.0
SURE = 0.95
SOURCE_CELLS, LANG_CELLS = 32, 8
N_TEXT = 128 + 9
N_META = SOURCE_CELLS + LANG_CELLS + 9


def text_view(text: str) -> np.ndarray:
    """Features of the content."""
    out = np.zeros(N_TEXT)
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return out
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    out[:128] = np.sqrt(seen[:128] / len(raw))
    words = text.split()
    n = max(1, len(words))
    distinct = set(words)
    out[128] = np.sqrt(seen[128:].sum() / len(raw))
    out[129] = len(distinct) / n
    out[130] = len(distinct) / np.sqrt(n)
    out[131] = np.sqrt(sum(a == b for a, b in zip(words, words[1:])) / n)
    out[132] = len(text) / n
    out[133] = np.sqrt(seen[65:91].sum() / len(raw))
    out[134] = np.sqrt((seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()) / len(raw))
    out[135] = np.log1p(n)
    out[136] = np.log1p(max(map(len, distinct), default=0))
    return out


def metadata_view(source: str | None, lang: str | None, n_chars: int | None, text: str) -> np.ndarray:
    """Features of the page around the content."""
    out = np.zeros(N_META)
    cell = lambda v, n: xxhash.xxh64_intdigest("" if v is None else str(v)) % n
    out[cell(source, SOURCE_CELLS)] = 1
    out[SOURCE_CELLS + cell(lang, LANG_CELLS)] = 1
    lines = text.split("\n")
    sizes = np.array([len(x) for x in lines])
    k = SOURCE_CELLS + LANG_CELLS
    out[k:] = (np.log1p(max(0, n_chars or 0)), n_chars is None, np.log1p(len(lines)), np.log1p(sizes.mean()),
               np.log1p(sizes.max()), len(set(lines)) / len(lines), (sizes == 0).mean(),
               np.mean([x.rstrip()[-1:] in (".", "?", "!") for x in lines]),
               np.mean([x.count("|") > 2 for x in lines]))
    return out


def _columns(docs: DataFrame, id_col: str) -> DataFrame:
    have = {c.lower() for c in docs.columns}
    opt = lambda c, t: (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       opt("source", "string"), opt("lang", "string"), opt("n_chars", "long"))


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.zeros((batch.num_rows, N_TEXT)), np.zeros((batch.num_rows, N_META))
    for k in range(batch.num_rows):
        text, source, lang, n_chars = (batch.column(c)[k].as_py() for c in range(1, 5))
        a[k], b[k] = text_view(text), metadata_view(source, lang, n_chars, text)
    return a, b


def _features(rows: DataFrame) -> DataFrame:
    """(doc_id, x): both views of every row, as 32-bit floats."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = np.hstack(_views(batch)).astype("<f4")
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in both], pa.binary())], names=["doc_id", "x"])
    return map_batches(rows, run, "doc_id long, x binary")


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """The two views of a column of packed features."""
    x = np.array([np.frombuffer(v.as_py(), "<f4") for v in column], np.float64).reshape(len(column), N_TEXT + N_META)
    return [x[:, :N_TEXT], x[:, N_TEXT:]]


def _added(pool: DataFrame, sums: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray:
    """``sums`` of the rows of ``pool``, a flat array for every slice, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches):
            found = sums(_matrix(batch.column(0)))
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["k", "v"])
        give_back()
    found = pool.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow().sort_by("k")
    return found["v"].to_numpy()


class Model:
    """Two calibrated views and how they combine."""

    def __init__(self, views: list[Logistic], calibrated: list[tuple[float, float]], mix: np.ndarray):
        self.views, self.calibrated, self.mix = views, calibrated, mix

    def score(self, xs) -> np.ndarray:
        z = [a * v.logit(x) + b for v, x, (a, b) in zip(self.views, xs, self.calibrated)]
        return sigmoid(self.mix[0] + self.mix[1] * z[0] + self.mix[2] * z[1])


def _platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    m = Logistic(z[:, None], y, weight, l2=0.5)
    return float(m.w[1] / m.scale[0]), float(m.w[0] - m.w[1] * m.mean[0] / m.scale[0])


def handed_over(p: list[np.ndarray], other: int, cls: int) -> np.ndarray:
    """Rows that the view beside ``other`` labels ``cls`` with confidence, uncontradicted."""
    own = 1 - other
    sure, against = (p[own], 1 - p[other]) if cls else (1 - p[own], p[other])
    return (sure >= SURE) & (against < SURE)


def _exchange(views: list[View], at: list[np.ndarray]) -> Callable[[list[np.ndarray]], np.ndarray]:
    """Newton sums of the rows that ``views`` hand each other, at the weights ``at``: for each
    view and class the number of rows, gradient and curvature, laid end to end."""
    def sums(xs: list[np.ndarray]) -> np.ndarray:
        z = [v.design(x) for v, x in zip(views, xs)]
        p = [sigmoid(a @ v.w) for v, a in zip(views, z)]
        out = []
        for k in (0, 1):
            for cls in (0, 1):
                rows = z[k][handed_over(p, k, cls)]
                out += [np.array([float(len(rows))]), *newton_sums(rows, np.full(len(rows), float(cls)), np.ones(len(rows)), at[k])]
        return np.concatenate([np.ravel(x) for x in out])
    return sums


def _moments(xs: list[np.ndarray]) -> np.ndarray:
    x = np.hstack(xs)
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def co_train(xs, y: np.ndarray, weight: np.ndarray, pool: DataFrame, rounds: int = ROUNDS) -> Model:
    """``xs``: the two views of the labelled rows; ``pool``: a stored table of (x), those of
    the unlabelled ones."""
    rng = np.random.default_rng(11)
    held = rng.random(len(y)) < 0.25
    for label in (0, 1):  # each side needs both classes
        at = np.flatnonzero(y == label)
        held[at[:1]], held[at[1:2]] = False, True
    fit = ~held if len(set(y[~held])) == 2 else np.ones(len(y), bool)
    moments = _moments([x[fit] for x in xs])
    unlabelled = _added(pool, _moments)
    moments = moments + unlabelled if len(unlabelled) else moments
    n, total, squares = moments[0], moments[1:1 + N_TEXT + N_META], moments[1 + N_TEXT + N_META:]
    mean, scale = total / n, np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0)) + 1e-6
    views = [View(mean[:N_TEXT], scale[:N_TEXT]), View(mean[N_TEXT:], scale[N_TEXT:])]
    own = [v.design(x[fit]) for v, x in zip(views, xs)]
    y_fit, share = y[fit], weight[fit]
    for v, z in zip(views, own):
        v.fit(lambda w, z=z: newton_sums(z, y_fit, share, w))
    of_class = [HANDED_OVER * share[y_fit == cls].sum() for cls in (0, 1)]
    for _ in range(rounds if len(unlabelled) else 0):
        now = [v.w.copy() for v in views]
        for _ in range(STEPS):
            flat, k = _added(pool, _exchange(views, now)), 0
            for view, z in enumerate(own):
                grad, curve = newton_sums(z, y_fit, share, now[view])
                d = len(now[view])
                for cls in (0, 1):
                    part = of_class[cls] / max(flat[k], 1.0)
                    grad = grad + part * flat[k + 1:k + 1 + d]
                    curve = curve + part * flat[k + 1 + d:k + 1 + d + d * d].reshape(d, d)
                    k += 1 + d + d * d
                now[view] = views[view].step(now[view], grad, curve)
        for v, w in zip(views, now):
            v.w = w
    on = held if len(set(y[held])) == 2 else fit
    z = [v.logit(x[on]) for v, x in zip(views, xs)]
    calibrated = [_platt(zk, y[on], weight[on]) for zk in z]
    z = np.column_stack([a * zk + b for zk, (a, b) in zip(z, calibrated)])
    m = Logistic(z, y[on], weight[on], l2=0.5)
    mix = np.concatenate([[m.w[0] - (m.w[1:] * m.mean / m.scale).sum()], m.w[1:] / m.scale])
    return Model(views, calibrated, mix)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", learn: Column | None = None,
        per_class: int = PER_CLASS, rounds: int = ROUNDS) -> Model | None:
    """A model from (doc_id, quality) labels; ``learn`` restricts the labels that may be used
    (other labelled documents are left out altogether)."""
    known = labels.filter(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = _columns(docs, id_col)
    here = (known if learn is None else known.filter(learn)).join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["quality"]: r["count"] for r in here.groupBy("quality").count().collect()}
    if set(counts) != {0, 1}:
        return None
    chosen = {r["doc_id"]: r["stratum"] for r in bounded_sample(here, F.col("quality"), per_class).collect()}
    wanted = docs.sparkSession.createDataFrame([(k,) for k in sorted(chosen)], "doc_id long")
    one = rows_of(rows, wanted).groupBy("doc_id").agg(F.min(F.struct("text", "source", "lang", "n_chars")).alias("row"))
    labelled = _features(one.select("doc_id", "row.*")).toArrow().sort_by("doc_id").combine_chunks()
    xs = _matrix(labelled["x"])
    y = np.array([chosen[i] for i in labelled["doc_id"].to_pylist()], float)
    total = sum(counts.values())
    weight = np.where(y == 1, counts[1] / total / max(1, (y == 1).sum()), counts[0] / total / max(1, (y == 0).sum()))
    ids = stored(known.select("doc_id"), "labelled", few=True)
    small = ids.count() <= MAX_SHIPPED
    others = rows.join(F.broadcast(ids) if small else ids, "doc_id", "left_anti")
    pool = stored(_features(others).select("x"), "unlabelled")
    model = co_train(xs, y, weight * len(y), pool, rounds)
    discard(pool, ids)
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id") -> DataFrame:
    """doc_id, score, accepted of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        empty = np.array([not t.as_py() for t in batch.column(1)], bool)
        p = np.ones(batch.num_rows) if model is None else model.score(_views(batch))
        p = np.where(empty, 0.0, p)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(p >= 0.5)],
                                          names=["doc_id", "score", "accepted"])
    return map_batches(_columns(docs, id_col), run, "doc_id long, score double, accepted boolean")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns kept.

    What is stored and joined is the rejected rows' ids and text hashes."""
    model = fit(docs, labels)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = np.ones(batch.num_rows) if model is None else model.score(_views(batch))
        empty = np.array([not t.as_py() for t in batch.column(1)], bool)
        bad = pa.array((p < 0.5) | empty)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(5)], names=["bad_id", "bad_text"]).filter(bad)

    rows = _columns(docs, "doc_id").withColumn("tag", F.xxhash64("text"))
    bad = stored(map_batches(rows, run, "bad_id long, bad_text long"), "rejected").distinct()
    small = bad.count() <= MAX_SHIPPED
    own_text = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    on = docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (own_text == bad["bad_text"])
    return docs.join(F.broadcast(bad) if small else bad, on, "left_anti")
