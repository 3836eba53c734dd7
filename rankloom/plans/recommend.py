"""Scoring and top-N from factor tables (id INT, features ARRAY<numeric>).

* ``predict_pairs``: pairs ⋈ user factors ⋈ product factors, dot product as a native
  higher-order expression — no Python.
* ``top_n``: every query id's N best candidates.  The larger side is packed into blocks (ids
  and one matrix) of at most ``BLOCK_BYTES`` or ``max_block_rows``; each block is one task,
  which holds it while the rows of the smaller side stream past in Arrow batches, and scores
  them with dense matrix products (numpy): in single precision, and again in double what may
  be listed; candidates that no row of a group of like direction can list are left out.  So the larger side is sent once and the smaller
  one once per block, and a task holds one block and one batch.  Where the block is of
  queries, their lists are kept in the task; where it is of candidates, N rows per (query,
  block) leave it.  A window limit merges the lists.  No factor reaches the driver, nothing
  is broadcast, and no block is a hot key.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot_expr
from ..operators.joins import join_dimension, materialize

# The block scorer runs in Python workers that may not have this package installed
# (cluster executors, or a driver started outside the repo): ship its code by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Candidates of one norm-ordered block (plans/pruned.py).
DEFAULT_BLOCK_ROWS = 50_000
# Matrix bytes of one packed block: 200,000 vectors of rank 10, 31,250 of 64 dimensions.
BLOCK_BYTES = 16_000_000
# Score-matrix cells per numpy step inside a task (x 8 bytes): they stay in a core's cache.
SCORE_CELLS = 250_000
# The same for single precision: a tile's rows (a group of like direction) and columns, and the
# rows whose lists are brought up to date together.
TILE_ROWS, TILE_COLS, MERGE_ROWS = 64, 2_048, 1_024
# Likely candidates of a group that are tried first.
FIRST_COLS = 512
# Dimensions above which groups of like direction are too wide to leave candidates out.
GROUPED_WIDTH = 16
# Longest vectors that are scored in single precision first.
SINGLE_MAX = 1e18
# Held candidates that are scored at once, and passing rows that are collected for it.
PART_ROWS = 40_000
# Candidates of one group, where a row's k best are looked for by the groups' best.
GROUP = 64


def predict_pairs(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                  user: str = "user", item: str = "product", cold_start: str = "drop") -> DataFrame:
    """(user, product, prediction) for each input pair; repeated pairs stay repeated.

    ``cold_start='drop'`` removes pairs with an unknown id, ``'nan'`` keeps them as NaN,
    ``'mark'`` keeps them with a NULL prediction and adds ``known``.  The factor tables are
    first cut to the ids that the pairs name, then joined as checked-broadcast dimensions:
    one pair reads two vectors, many pairs are never shuffled under the bound (a user with a
    huge share of them costs nothing extra), and over it AQE skew-splits a shuffle join.
    """
    def side(factors, key, name):
        wanted = pairs.select(F.col(key).alias("id")).distinct()
        return (factors.join(wanted, "id", "left_semi")
                .select(F.col("id").alias(key), F.col("features").alias(name)))
    how = "inner" if cold_start == "drop" else "left"
    joined = join_dimension(join_dimension(pairs, side(user_factors, user, "_uf"), user, how),
                            side(item_factors, item, "_if"), item, how)
    pred = dot_expr("_uf", "_if")
    if cold_start == "nan":
        pred = F.coalesce(pred, F.lit(float("nan")))
    marks = [F.col("_uf").isNotNull().__and__(F.col("_if").isNotNull()).alias("known")] if cold_start == "mark" else []
    return joined.select(*pairs.columns, pred.alias("prediction"), *marks)


def predict_one(user_id: int, item_id: int, user_factors: DataFrame, item_factors: DataFrame) -> float | None:
    """The score of one pair, from its two factor rows; None if either is unknown."""
    both = [f.filter(F.col("id") == i).select("features").limit(1).collect()
            for f, i in ((user_factors, user_id), (item_factors, item_id))]
    if not all(both):
        return None
    return float(np.dot(*(np.array(rows[0][0], float) for rows in both)))


def _top_k_rows(s: np.ndarray, cand_ids: np.ndarray, k: int):
    """Row-wise exact top-k of a score block, ordered by (score desc, candidate id asc);
    a NaN score comes after every number.

    Wide rows are first cut to the groups of ``GROUP`` columns whose best score reaches the
    k-th best of all groups' best: no other group holds one of the k.  Returns (row index,
    rank, candidate position, score) arrays."""
    n_rows, n_cols = s.shape
    groups = n_cols // GROUP
    if groups > 4 * k:
        best = s[:, :groups * GROUP].reshape(n_rows, GROUP, groups).max(axis=1)
        if not np.isnan(best).any():
            least = -np.partition(-best, k - 1, axis=1)[:, k - 1]
            r, g = np.nonzero(best >= least[:, None])
            pos = (g[:, None] + groups * np.arange(GROUP)).ravel()
            r = np.repeat(r, GROUP)
            rest = np.arange(groups * GROUP, n_cols)
            r = np.concatenate([r, np.repeat(np.arange(n_rows), len(rest))])
            pos = np.concatenate([pos, np.tile(rest, n_rows)])
            sc = s[r, pos]
            near = ~(sc < least[r])
            return _ranked(r[near], pos[near], sc[near], cand_ids, k)
    order_by = np.where(np.isnan(s), -np.inf, s)
    kth = -np.partition(-order_by, k - 1, axis=1)[:, k - 1]
    r, pos = np.nonzero(order_by >= kth[:, None])
    return _ranked(r, pos, s[r, pos], cand_ids, k)


def _by_score(r: np.ndarray, sc: np.ndarray) -> np.ndarray | None:
    """The order by (row, score desc); None if scores of a row are equal or no numbers, which
    need more keys."""
    if not len(r) or np.isnan(sc).any():
        return None
    order = np.argsort(-sc)
    low = r.min()
    # Numbers of two bytes are sorted by counting.
    keys = (r - low).astype(np.uint16) if r.max() - low < 1 << 16 else r
    order = order[np.argsort(keys[order], kind="stable")]
    rows, scores = r[order], sc[order]
    return None if ((rows[1:] == rows[:-1]) & (scores[1:] == scores[:-1])).any() else order


def _ranked(r: np.ndarray, pos: np.ndarray, sc: np.ndarray, cand_ids: np.ndarray, k: int):
    """The k first of every row's (position, score) by (score desc, id asc), NaN last."""
    order = _by_score(r, sc)
    if order is None:
        nan = np.isnan(sc)
        order = np.lexsort((cand_ids[pos], -np.where(nan, -np.inf, sc), nan, r))
    r, pos, sc = r[order], pos[order], sc[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r, side="left") + 1
    first = rank <= k
    return r[first], rank[first], pos[first], sc[first]


def _set(mask: np.ndarray) -> np.ndarray:
    """The places of a flat mask that hold, where few do: eight are looked at together."""
    whole = len(mask) // 8 * 8
    words = np.flatnonzero(mask[:whole].view(np.uint64) != 0)
    word, bit = np.nonzero(mask[:whole].reshape(-1, 8)[words])
    return np.concatenate([words[word] * 8 + bit, np.flatnonzero(mask[whole:]) + whole])


def _products(a: np.ndarray, r: np.ndarray, b: np.ndarray, pos: np.ndarray, rows_at_once: int = 100_000) -> np.ndarray:
    """a[r] · b[pos] row by row, summed left to right: equal vectors have equal scores."""
    out = np.zeros(len(r))
    for lo in range(0, len(r), rows_at_once):
        at = slice(lo, lo + rows_at_once)
        left, right = a[r[at]], b[pos[at]]
        for j in range(a.shape[1]):
            out[at] += left[:, j] * right[:, j]
    return out


def _by_direction(units: np.ndarray) -> np.ndarray:
    """The rows in an order that has those of like direction together: halved along the axis of
    their greatest spread until a group is left."""
    done, todo = [], [np.arange(len(units))]
    while todo:
        rows = todo.pop()
        if len(rows) <= TILE_ROWS:
            done.append(rows)
            continue
        x = units[rows]
        x = x - x.mean(axis=0)
        along = x @ np.linalg.eigh(x.T @ x)[1][:, -1]
        # Whole groups on the left, so that the groups are runs of TILE_ROWS rows.
        half = -(-len(rows) // (2 * TILE_ROWS)) * TILE_ROWS
        order = np.argpartition(along, half) if half < len(rows) else np.argsort(along)
        todo += [rows[order[half:]], rows[order[:half]]]
    return np.concatenate(done) if done else np.arange(0)


class _Lists:
    """The n best candidates so far of every query row of a block, while candidates pass by.

    Scores are first computed in single precision, and those that reach a row's n-th best less
    the rounding error that single precision can have are computed again in double; so the lists
    are those of the doubles.  Vectors that are not finite, or too long for it, are scored in
    double at once.

    Rows of like direction are taken together: of unit vectors in a cone of half angle a about
    m, none has a score of t > 0 or more with a candidate c of m·c < t cos a - sin a sqrt(|c|² - t²).
    Such candidates are left out of a group, with its least n-th score for length 1 as t.

    ``kth``: scores below need not be listed; at first what is known from elsewhere."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, n: int, kth: np.ndarray | None = None, struck=None):
        self.ids, self.matrix, self.n, self.struck = ids, matrix, n, struck
        self.kth = np.full(len(ids), -np.inf) if kth is None else kth.copy()
        self.size = np.zeros(len(ids), np.int64)
        self.cand, self.score = np.zeros((len(ids), n), np.int64), np.zeros((len(ids), n))
        self.norms = np.linalg.norm(matrix, axis=1)
        self.order = None
        with np.errstate(over="ignore", invalid="ignore"):
            self.single = matrix.astype(np.float32)

    def take(self, cand_ids: np.ndarray, cands: np.ndarray, rows: np.ndarray | None = None) -> int:
        """Score the candidates for ``rows`` (all by default); the number of scores."""
        rows = np.arange(len(self.ids)) if rows is None else rows
        if not len(rows) or not len(cand_ids):
            return 0
        lengths = np.linalg.norm(cands, axis=1)
        if lengths.max() < SINGLE_MAX and self.norms[rows].max() < SINGLE_MAX:
            single = np.ascontiguousarray(cands.astype(np.float32).T)
            wanted = np.zeros(len(self.ids), bool)
            wanted[rows] = True
            rows = self._grouped()[wanted[self._grouped()]]
            for lo in range(0, len(rows), MERGE_ROWS):
                self._pass(rows[lo:lo + MERGE_ROWS], cand_ids, cands, single, lengths)
        else:
            step = max(1, SCORE_CELLS // len(cand_ids))
            for lo in range(0, len(rows), step):
                at = rows[lo:lo + step]
                self._merge(at, self.matrix[at] @ cands.T, cand_ids)
        return len(rows) * len(cand_ids)

    def _listed_at_first(self, n_cands: int) -> int:
        return min(self.n + (self.struck.most if self.struck else 0), n_cands)

    def _grouped(self) -> np.ndarray:
        if self.order is None:
            if self.matrix.shape[1] <= GROUPED_WIDTH and np.isfinite(self.norms).all():
                self.order = _by_direction(self.matrix / np.maximum(self.norms, 1e-300)[:, None])
            else:
                self.order = np.arange(len(self.ids))
        return self.order

    def _pass(self, rows: np.ndarray, cand_ids: np.ndarray, cands: np.ndarray, single: np.ndarray, lengths: np.ndarray) -> None:
        (n_cands, width), queries, norms, longest = cands.shape, self.single[rows], self.norms[rows], lengths.max()
        # Twice the bound of a product's rounding in any order, and what underflow can take.
        error = (width + 8) * 2.0 ** -23 * norms * longest + width * 1e-37 * (1 + norms + longest)
        square = np.square(lengths).astype(np.float32)
        groups = [slice(at, at + TILE_ROWS) for at in range(0, len(rows), TILE_ROWS)]
        scores, mask = np.empty(TILE_ROWS * TILE_COLS, np.float32), np.empty(TILE_ROWS * TILE_COLS, bool)

        def reached(group, least, vectors):
            """(row of the group, column) of the scores that are not below ``least``, which is
            set to this tile's n-th best for rows without one."""
            n_cols = vectors.shape[1]
            s, over = (x[:len(least) * n_cols].reshape(len(least), -1) for x in (scores, mask))
            np.matmul(queries[group], vectors, out=s)
            free = least == -np.inf
            if free.any():
                k = self._listed_at_first(n_cols)
                least = least.copy()
                least[free] = -np.partition(-s[free], k - 1, axis=1)[:, k - 1] - 2 * error[group][free]
            np.greater_equal(s, least.astype(np.float32)[:, None], out=over)
            return np.divmod(_set(over.ravel()), n_cols)

        def listed(found):
            r, pos = (np.concatenate(x) for x in zip(*found))
            sc = _products(self.matrix, rows[r], cands, pos)
            near = sc >= self.kth[rows[r]]
            self._add(rows[r[near]], cand_ids[pos[near]], sc[near])

        cosines, along = self._directions(rows, groups, single)
        # For rows without a threshold, first the group's likely candidates.
        tried = [np.arange(0)] * len(groups)
        if (self.kth[rows] == -np.inf).any():
            found = []
            for k, group in enumerate(groups):
                if n_cands <= FIRST_COLS:
                    tried[k] = np.arange(n_cands)
                else:
                    tried[k] = np.arange(FIRST_COLS) if along is None else np.argpartition(along[k], -FIRST_COLS)[-FIRST_COLS:]
                r, pos = reached(group, self.kth[rows[group]] - error[group], single.take(tried[k], axis=1))
                found.append((r + group.start, tried[k][pos]))
            listed(found)
        found, n_found = [], 0
        for k, group in enumerate(groups):
            near = np.ones(n_cands, bool) if along is None else self._within_reach(rows[group], error[group], cosines[k], along[k], lengths, square)
            near[tried[k]] = False
            places = np.flatnonzero(near)
            # Of a tile's columns; all of them are not copied.
            for lo in range(0, len(places), TILE_COLS):
                at = places[lo:lo + TILE_COLS]
                whole = at[-1] - at[0] + 1 == len(at)
                vectors = single[:, at[0]:at[-1] + 1] if whole else single.take(at, axis=1)
                r, pos = reached(group, self.kth[rows[group]] - error[group], vectors)
                found.append((r + group.start, at[pos]))
                n_found += len(r)
                if n_found > 2 * self.n * MERGE_ROWS:
                    listed(found)
                    found, n_found = [], 0
        if found:
            listed(found)

    def _directions(self, rows: np.ndarray, groups: list, single: np.ndarray):
        """Per group the least cosine of a row with the group's mean direction, and the candidates'
        products with that; None where groups are too wide to be of use."""
        if self.matrix.shape[1] > GROUPED_WIDTH:
            return None, None
        units = self.matrix[rows] / np.maximum(self.norms[rows], 1e-300)[:, None]
        means = np.stack([units[group].mean(axis=0) for group in groups])
        means /= np.maximum(np.linalg.norm(means, axis=1), 1e-300)[:, None]
        cosines = [(units[group] @ mean).min() - 1e-12 for group, mean in zip(groups, means)]
        return cosines, means.astype(np.float32) @ single

    def _within_reach(self, rows: np.ndarray, error: np.ndarray, cos: float, along: np.ndarray, lengths: np.ndarray, square: np.ndarray) -> np.ndarray:
        """Whether a candidate may have a score for a list of the group ``rows``."""
        longest, norms = lengths.max(), self.norms[rows]
        t = ((self.kth[rows] - error) / np.maximum(norms, 1e-300)).min()
        if not (norms.min() > 1 / SINGLE_MAX and longest > 1e3 / SINGLE_MAX and cos > 0 and t > 0):
            return np.ones(len(along), bool)
        # Single precision takes less than the thousandth part of the longest from the root.
        root = np.sqrt(np.maximum(square - np.float32(t * t), 0))
        return along + np.float32(np.sqrt(max(0.0, 1 - cos * cos))) * root >= np.float32(cos * t - 1e-3 * longest)

    def _merge(self, rows: np.ndarray, s: np.ndarray, cand_ids: np.ndarray) -> None:
        kth = self.kth[rows]
        # Without a threshold every score counts, also one that is no number.
        free = kth == -np.inf
        r, pos = np.divmod(np.flatnonzero(s >= np.where(free, np.nan, kth)[:, None]), len(cand_ids))
        r, c, sc = rows[r], cand_ids[pos], s[r, pos]
        if free.any():
            r2, _, pos2, sc2 = _top_k_rows(s if free.all() else s[free], cand_ids, self._listed_at_first(len(cand_ids)))
            r, c, sc = (np.concatenate(x) for x in ((r, rows[free][r2]), (c, cand_ids[pos2]), (sc, sc2)))
        self._add(r, c, sc)

    def _add(self, r: np.ndarray, c: np.ndarray, sc: np.ndarray) -> None:
        if self.struck:
            keep = ~self.struck.has(self.ids[r], c)
            r, c, sc = r[keep], c[keep], sc[keep]
        if not len(r):
            return
        own = np.unique(r)
        i, j = np.nonzero(np.arange(self.n) < self.size[own][:, None])
        r, c, sc = (np.concatenate(x) for x in ((r, own[i]), (c, self.cand[own[i], j]), (sc, self.score[own[i], j])))
        r, rank, at, sc = _ranked(r, np.arange(len(r)), sc, c, self.n)
        self.cand[r, rank - 1], self.score[r, rank - 1] = c[at], sc
        self.size[own] = np.bincount(np.searchsorted(own, r), minlength=len(own))
        full = own[self.size[own] == self.n]
        last = self.score[full, self.n - 1]
        self.kth[full] = np.fmax(self.kth[full], np.where(np.isnan(last), -np.inf, last))

    def listed(self, rows_at_once: int = 50_000):
        """(query row, rank, candidate id, score) arrays, some rows at once."""
        for lo in range(0, len(self.ids), rows_at_once):
            size = self.size[lo:lo + rows_at_once]
            r, place = np.nonzero(np.arange(self.n) < size[:, None])
            yield r + lo, place + 1, self.cand[r + lo, place], self.score[r + lo, place]


def _packed(factors: DataFrame, block_rows: int | None, side: str) -> DataFrame:
    """(block, ids, matrix) with blocks numbered from 0, materialised.

    Blocks are runs of a task's rows, so repeats of an id never make a block too large."""
    def pack(batches):
        part, count, held = TaskContext.get().partitionId(), 0, []

        def block(rows):
            ids = np.array([r[0] for r in rows], np.int64)
            mat = np.stack([np.asarray(r[1], np.float64) for r in rows])
            return pd.DataFrame({"key": [(part << 32) + count], "ids": [ids.tobytes()],
                                 "matrix": [mat.tobytes()]})
        for pdf in batches:
            held += list(zip(pdf["id"], pdf["features"]))
            most = block_rows or (rows_of_block(len(held[0][1])) if held else 1)
            while len(held) >= most:
                yield block(held[:most])
                held, count = held[most:], count + 1
        if held:
            yield block(held)

    # Dealt out, so that there are blocks for all tasks however few files the rows come from.
    rows = _vectors(factors).repartition(factors.sparkSession.sparkContext.defaultParallelism)
    blocks = materialize(rows.mapInPandas(pack, "key long, ids binary, matrix binary"))
    # Only the keys, one per block, are numbered together.
    number = F.row_number().over(Window.orderBy("key")).cast("int") - 1
    numbers = blocks.select("key").withColumn(f"{side}_block", number)
    return (blocks.join(numbers, "key")
            .select(f"{side}_block", *[F.col(c).alias(f"{side}_{c}") for c in ("ids", "matrix")]))


def rows_of_block(width: int) -> int:
    return max(1, BLOCK_BYTES // (8 * max(1, width)))


def rows_of_pass(width: int) -> int:
    return max(1, min(PART_ROWS, BLOCK_BYTES // 4 // (8 * max(1, width))))


def _vectors(factors: DataFrame) -> DataFrame:
    return (factors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("features"))
            .filter(F.col("features").isNotNull()))


def _scorer(n: int, q: str, c: str, held: str):
    """Each block (``held``: q or c) comes before the rows that are sent to it."""
    def lists(qids, rank, cids, score):
        return pd.DataFrame({q: qids.astype(np.int32), "rank": rank.astype(np.int32), c: cids.astype(np.int32), "score": score})

    def done(found):
        for r, rank, cids, sc in found.listed() if found is not None else ():
            yield lists(found.ids[r], rank, cids, sc)

    def score(batches):
        found = ids = mat = None
        waiting, n_waiting = [], 0

        def passed():
            """The rows that have been collected, against the block."""
            nonlocal waiting, n_waiting
            if not waiting:
                return
            some, vectors = (np.concatenate(x) for x in zip(*waiting))
            waiting, n_waiting = [], 0
            if held == "q":
                found.take(some, vectors)
                return
            # The held candidates by parts, as a row's first ones set a threshold for the others.
            passing = _Lists(some, vectors, n)
            for k in range(0, len(ids), PART_ROWS):
                passing.take(ids[k:k + PART_ROWS], mat[k:k + PART_ROWS])
            yield from done(passing)

        for pdf in batches:
            block = pdf["ids"].notna().to_numpy()
            starts = np.flatnonzero(block)
            cuts = np.unique(np.concatenate([[0], starts, starts + 1, [len(pdf)]]))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if block[lo]:
                    yield from passed()
                    yield from done(found)
                    ids = np.frombuffer(pdf["ids"].iat[lo], np.int64)
                    mat = np.frombuffer(pdf["matrix"].iat[lo], np.float64).reshape(len(ids), -1)
                    if held == "q":
                        found = _Lists(ids, mat, n)
                    else:
                        # The longest come first, as they set the highest thresholds.
                        order = np.argsort(-np.linalg.norm(mat, axis=1), kind="stable")
                        ids, mat = ids[order], mat[order]
                    continue
                some, vectors = pdf["id"].to_numpy()[lo:hi], np.stack(pdf["features"].iloc[lo:hi].to_list()).astype(np.float64)
                waiting.append((some, vectors))
                n_waiting += hi - lo
                if n_waiting >= rows_of_pass(vectors.shape[1]):
                    yield from passed()
        yield from passed()
        yield from done(found)
    return score


def top_n(query_factors: DataFrame, cand_factors: DataFrame, n: int = 10, q: str = "user",
          c: str = "product", max_block_rows: int | None = None, unique: bool = False) -> DataFrame:
    """(q, rank, c, score): the n best candidates of every query id, ties by lower id.

    Rows without a vector are left out.  A NaN score ranks after every number.  Every row of
    a repeated candidate id is a candidate; a repeated query id gets one list of the best of
    all its rows.  ``unique``: no query id is repeated, so that the lists of held queries are
    whole and need no merge (``recommend`` knows it of a model's factors)."""
    held, passing = ("q", cand_factors) if query_factors.count() >= cand_factors.count() else ("c", query_factors)
    blocks = _packed(query_factors if held == "q" else cand_factors, max_block_rows, "b")
    n_blocks = blocks.count()
    none = F.lit(None)
    first = blocks.select("b_block", F.lit(0).alias("place"), F.col("b_ids").alias("ids"), F.col("b_matrix").alias("matrix"),
                          F.lit(0).cast("long").alias("id"), none.cast("array<double>").alias("features"))
    rows = _vectors(passing if n_blocks else passing.limit(0)).select(
        F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks, 1) - 1))).alias("b_block"), F.lit(1).alias("place"), none.cast("binary").alias("ids"),
        none.cast("binary").alias("matrix"), "id", "features")
    # A block is a partition: it is sorted before the rows sent to it.
    sent = first.unionByName(rows).repartitionById(max(n_blocks, 1), F.col("b_block")).sortWithinPartitions("b_block", "place").drop("b_block", "place")
    out = sent.mapInPandas(_scorer(n, q, c, held), f"{q} int, rank int, {c} int, score double")
    if unique and held == "q":
        return out
    w = Window.partitionBy(q).orderBy(F.isnan("score"), F.col("score").desc(), F.col(c))
    return (out.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= n)
               .select(q, "rank", c, "score"))
