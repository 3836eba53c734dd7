"""Top-N with one side held in blocks and the other passing by, and fits that leave no files."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rankloom import operators as ops
from rankloom.plans import pruned, recommend, tune
from rankloom.plans.factorize import fit, make_als
from rankloom.plans.factorize import recommend as listed_by_model
from rankloom.queries import QUERIES, _split_pairs
from rankloom.session import checkpoint_root


def _ratings(spark):
    rng = np.random.default_rng(5)
    rows = [(int(u), int(p), float(r)) for u, p, r in zip(rng.integers(0, 60, 900), rng.integers(0, 25, 900), rng.integers(1, 4, 900))]
    return spark.createDataFrame(rows, "user int, product int, rating double")


@pytest.mark.parametrize("for_users", [True, False])
def test_model_lists_need_no_cross_join(spark, for_users):
    model = fit(_ratings(spark), implicit=False, rank=4, max_iter=3)
    got = listed_by_model(model, 5, for_users)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "collect_top_k" not in plan.lower()
    q, c = ("user", "product") if for_users else ("product", "user")
    theirs = model.recommendForAllUsers(5) if for_users else model.recommendForAllItems(5)
    want = {(r[q], i + 1): x["rating"] for r in theirs.collect() for i, x in enumerate(r["recommendations"])}
    have = {(r[q], r["rank"]): r["score"] for r in got.collect()}
    assert have.keys() == want.keys() and max(abs(have[k] - want[k]) for k in want) < 1e-4
    assert dict(got.dtypes) == {q: "int", "rank": "int", c: "int", "score": "double"}


def test_wide_rows_are_cut_to_their_best_groups():
    rng = np.random.default_rng(6)
    for trial in range(40):
        k, n_cols = int(rng.integers(1, 6)), int(rng.integers(1500, 3000))
        s = rng.integers(0, 200, (4, n_cols)).astype(float) if trial % 2 else rng.normal(size=(4, n_cols))
        if trial % 5 == 0:
            s[1, rng.integers(0, n_cols, 30)] = np.nan
        ids = rng.permutation(n_cols)
        r, rank, pos, _ = recommend._top_k_rows(s, ids, k)
        for i in range(4):
            best = sorted(range(n_cols), key=lambda j: (np.isnan(s[i, j]), -s[i, j], ids[j]))[:k]
            assert list(pos[r == i]) == best and list(rank[r == i]) == list(range(1, k + 1))


@pytest.mark.parametrize("shape", [(70, 30), (30, 70)])
def test_either_side_may_be_held(spark, shape):
    rng = np.random.default_rng(7)
    frame = lambda n: spark.createDataFrame([(k, [float(x) for x in rng.integers(-3, 4, 3)]) for k in range(n)], "id int, features array<double>")
    users, products = frame(shape[0]), frame(shape[1])
    u, p = ({r["id"]: np.array(r["features"]) for r in f.collect()} for f in (users, products))
    want = {(a, k + 1): b for a in u for k, b in enumerate(sorted(p, key=lambda b: (-(u[a] @ p[b]), b))[:4])}
    got = recommend.top_n(users, products, 4, max_block_rows=9)
    assert {(r["user"], r["rank"]): r["product"] for r in got.collect()} == want


def test_a_query_leaves_a_round_with_one_list():
    """However many candidate blocks it meets; before, every block gave it one."""
    rng = np.random.default_rng(8)
    q = rng.normal(size=(5, 3))
    sent = [{"q_block": 0, "c_block": pruned.BLOCK, "q_ids": np.arange(5).tobytes(), "q_matrix": q.tobytes(),
             "q_norms": np.linalg.norm(q, axis=1).tobytes(), "kth": None, "q_id": 0, "c_id": 0, "c_vector": None, "c_norm": None}]
    cands = rng.normal(size=(40, 3))
    sent += [sent[0] | {"c_block": k // 10, "c_id": k, "c_vector": v, "c_norm": float(np.linalg.norm(v)), "q_ids": None,
                        "q_matrix": None, "q_norms": None} for k, v in enumerate(cands)]
    out = pd.concat(pruned._scorer(4)(iter([pd.DataFrame(sent[:17]), pd.DataFrame(sent[17:])])))
    lists = out[out["q_row"] >= 0]
    assert (lists.groupby("q").size() == 4).all()
    assert {k: list(v["c"]) for k, v in lists.groupby("q")} == {i: list(np.argsort(-(cands @ q[i]))[:4]) for i in range(5)}


def _kept(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return {d for d in os.listdir(root) if d.startswith("stored-")}


def test_a_fit_holds_few_iterations_on_disk():
    assert make_als(False).getCheckpointInterval() <= 3  # a cut deletes the shuffle files before it


def test_models_one_after_the_other_leave_no_files(spark, tmp_path):
    li = [(o, s, "2020-01-0%d" % (o % 9 + 1), "NRA"[(o + s) % 3], s % 4) for o in range(12) for s in range(7)]
    (spark.createDataFrame(li, "l_orderkey long, l_suppkey long, l_shipdate string, l_returnflag string, l_linenumber int")
     .withColumn("l_shipdate", F.to_timestamp("l_shipdate")).withColumn("l_partkey", F.col("l_suppkey"))
     .withColumn("l_quantity", F.lit(1.0)).withColumn("l_linestatus", F.lit("O")).write.parquet(f"{tmp_path}/lineitem.parquet"))
    ev = [(k, k % 12, "view", '{"k": %d}' % (k % 7)) for k in range(60)]
    (spark.createDataFrame(ev, "event_id long, user_id long, event_type string, props string")
     .withColumn("ts", F.to_timestamp(F.lit("2020-01-01"))).write.parquet(f"{tmp_path}/events.parquet"))
    before = _kept(spark)
    out = QUERIES["als_holdout_metrics"](spark, str(tmp_path))
    assert _kept(spark) == before
    assert sorted(r["model"] for r in out.collect()) == [1, 2, 3, 4]


def test_split_pairs_are_stored_once(spark):
    train, test = _split_pairs(_ratings(spark))
    assert "FileScan parquet" in train._jdf.queryExecution().executedPlan().toString()
    table = ops.stored(spark.range(5).toDF("x"))
    assert table.count() == 5 and train.count() + test.count() == 900
    ops.discard(table)
    assert table._stored_at.rsplit("/", 1)[1] not in _kept(spark)


def test_a_pair_is_hashed_once(spark):
    """A row's side is stored with it: neither the fit nor the scoring hashes the pairs again."""
    rows = [(u, p, float(1 + (u + p) % 3)) for u in range(30) for p in range(10)] + [(1, 1, 1.0), (None, 2, 1.0), (3, None, 2.0)]
    ratings = spark.createDataFrame(rows, "user int, product int, rating double")
    sides = _split_pairs(ratings)
    plain = ops.hash_split(ratings, ["user", "product"])
    for side, name in zip(sides, ("train", "test")):
        assert "md5" not in side._jdf.queryExecution().optimizedPlan().toString()
        wanted = plain.filter(F.col("split") == name).drop("split")
        assert side.dtypes == ratings.dtypes
        assert sorted(map(repr, side.collect())) == sorted(map(repr, wanted.collect()))


@pytest.mark.parametrize("kind", ["plain", "like", "ties", "long", "short", "zero", "wide"])
def test_lists_score_a_part_and_keep_the_best(kind):
    """Candidates out of a group's reach are not scored, and the lists are those of all scores."""
    rng = np.random.default_rng(9)
    d = 20 if kind == "wide" else 5
    q, c = rng.normal(size=(400, d)), rng.normal(size=(3000, d))
    if kind == "like":
        q, c = 3 + 1e-5 * q, c[0] + 1e-6 * c
    elif kind == "ties":
        q, c = q.round(), c.round()
    elif kind in ("long", "short"):
        q, c = (x * (1e18 if kind == "long" else 1e-25) for x in (q, c))
    elif kind == "zero":
        q[::7], c[::3] = 0, 0
    ids, cands = rng.permutation(400), rng.permutation(3000)
    lists = recommend._Lists(ids, q, 6)
    for lo in range(0, 3000, 1000):
        assert lists.take(cands[lo:lo + 1000], c[lo:lo + 1000]) == 400_000
    s = sum(q[:, j, None] * c[None, :, j] for j in range(d))
    for i in range(400):
        best = sorted(range(3000), key=lambda j: (-s[i, j], cands[j]))[:6]
        assert list(lists.cand[i]) == [cands[j] for j in best]
        assert np.allclose(lists.score[i], s[i, best], rtol=1e-12 if kind == "long" else 0, atol=0)


def test_candidates_out_of_reach_are_left_out(monkeypatch):
    rng = np.random.default_rng(10)
    q, c = rng.normal(size=(4000, 4)), rng.normal(size=(20_000, 4))
    seen, plain = [], np.matmul
    monkeypatch.setattr(recommend.np, "matmul", lambda a, b, out: seen.append(len(a) * b.shape[1]) or plain(a, b, out=out))
    recommend._Lists(np.arange(4000), q, 10).take(np.arange(20_000), c)
    assert 0 < sum(seen) < 4000 * 20_000 // 4


def test_lists_of_held_model_rows_are_not_merged(spark):
    model = fit(_ratings(spark), implicit=False, rank=4, max_iter=2)
    plan = lambda for_users: listed_by_model(model, 5, for_users)._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(user" not in plan(True) and "windowspecdefinition(product" in plan(False)


def test_a_search_may_hold_one_fit_at_a_time(spark, monkeypatch):
    """Every fit, the best one's again too, begins with the files of the one before deleted."""
    calls, together = [], []
    monkeypatch.setattr(tune, "collect_garbage", lambda s: calls.append(1))
    split = tune.TrainValidationSplit
    monkeypatch.setattr(tune, "TrainValidationSplit", lambda **kw: together.append(kw["parallelism"]) or split(**kw))
    train, test = _split_pairs(_ratings(spark))
    settings = tune.grid(make_als(True), ranks=[3], iters=[2], regs=[0.1, 1.0])
    one, four = (tune.tune(train, test, method="tvs", param_grid=settings, parallelism=p)[1].collect() for p in (1, 4))
    assert one == four and len(calls) == 3 and together == [1, 4]


def test_the_basket_search_holds_one_fit_at_a_time(spark, monkeypatch):
    from rankloom import queries
    seen = []
    monkeypatch.setattr(queries, "_basket_ratings", lambda *a: iter([(2, _ratings(spark))]))
    monkeypatch.setattr(tune, "tune", lambda train, test, **kw: seen.append(kw["parallelism"]) or (None, spark.range(1)))
    queries.QUERIES["als_tuned_tvs_baskets"](spark, "")
    assert seen == [1]
