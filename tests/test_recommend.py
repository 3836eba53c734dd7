"""Trained-model and factor-table properties (no SQL oracle can exist for ALS)."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from rankloom import sources as src
from rankloom.plans.factorize import factors, fit, recommend
from rankloom.functions import dot_expr
from rankloom.plans.recommend import predict_pairs, top_n
from rankloom.queries import QUERIES, _model1_ratings, _split_pairs


def top_n_native(query_factors, cand_factors, n=10, q="user", c="product"):
    """Brute force for tests only: score every pair natively, keep row_number <= n."""
    from pyspark.sql import Window
    qf = query_factors.select(F.col("id").alias(q), F.col("features").alias("_qf"))
    cf = cand_factors.select(F.col("id").alias(c), F.col("features").alias("_cf"))
    s = qf.crossJoin(cf).select(q, c, dot_expr("_qf", "_cf").alias("score"))
    w = Window.partitionBy(q).orderBy(F.col("score").desc(), F.col(c).asc())
    return (s.withColumn("rank", F.row_number().over(w).cast("int"))
             .filter(F.col("rank") <= n).select(q, "rank", c, "score"))


def _rows(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(*cols).collect())


def test_blocked_top_n_equals_single_block_and_brute_force(spark):
    uf, pf = src.user_factors(spark, SF01), src.product_factors(spark, SF01)
    cols = ["user", "rank", "product", "score"]
    one = _rows(top_n(uf, pf, 10), cols)
    blocked = _rows(top_n(uf, pf, 10, max_block_rows=60), cols)   # 250 products -> 6 blocks
    brute = _rows(top_n_native(uf, pf, 10), cols)
    assert one == blocked == brute


def test_als_prediction_is_factor_dot_product_and_top_n_matches(spark):
    train, test = _split_pairs(_model1_ratings(spark, SF01))
    model = fit(train, implicit=True, rank=5, max_iter=5, alpha=0.01, reg_param=0.01)
    f = factors(model)
    uf = f.filter("side = 'user'").select("id", "features")
    pf = f.filter("side = 'product'").select("id", "features")
    pairs = train.select("user", "product")
    mine = predict_pairs(pairs, uf, pf).withColumnRenamed("prediction", "mine")
    theirs = model.transform(pairs).select("user", "product", "prediction").distinct()
    j = mine.join(theirs, ["user", "product"])
    assert j.count() == mine.count()
    assert j.agg(F.max(F.abs(F.col("mine") - F.col("prediction")))).first()[0] < 1e-5
    # MLlib's blocked recommendForAllUsers == our top-N over the exported factors
    recs = recommend(model, 5)
    ours = top_n(uf, pf, 5)
    a = {(r["user"], r["product"]) for r in recs.collect()}
    b = {(r["user"], r["product"]) for r in ours.collect()}
    assert len(a ^ b) <= 0.01 * len(a)   # float32 ties may swap at the cut


def test_same_seed_same_model(spark):
    train, _ = _split_pairs(_model1_ratings(spark, SF01))
    m1 = fit(train, implicit=False, rank=4, max_iter=5, seed=7)
    m2 = fit(train, implicit=False, rank=4, max_iter=5, seed=7)
    a = np.array([r["features"] for r in m1.userFactors.orderBy("id").collect()])
    b = np.array([r["features"] for r in m2.userFactors.orderBy("id").collect()])
    assert np.allclose(a, b, atol=1e-4)


def test_more_iterations_do_not_worsen_in_sample_fit(spark):
    r = _model1_ratings(spark, SF01).withColumn("rating", F.col("rating") - 1.5)
    from rankloom.plans import metrics as M
    def rmse(it):
        m = fit(r, implicit=False, rank=10, max_iter=it, reg_param=0.01)
        return M.regression_metrics(m.transform(r)).first()["rmse"]
    assert rmse(10) <= rmse(2) + 1e-6


def test_registered_als_queries_run(spark):
    for name in ["als_implicit_predict", "als_factors", "als_recommend_users",
                 "als_insample_metrics", "als_tuned_tvs", "als_holdout_metrics",
                 "als_ranking_metrics", "als_recommend_explicit"]:
        df = QUERIES[name](spark, SF01)
        assert df.count() > 0, name
    per_model = QUERIES["als_holdout_metrics"](spark, SF01).collect()
    assert sorted(r["model"] for r in per_model) == [1, 2, 3, 4]
    assert all(r["n"] > 0 and r["rmse"] >= 0 for r in per_model)


def test_top_k_rows_exact_with_ties():
    from rankloom.plans.recommend import _top_k_rows
    rng = np.random.default_rng(0)
    for trial in range(200):
        nq, nc = int(rng.integers(1, 20)), int(rng.integers(1, 30))
        k = min(int(rng.integers(1, 12)), nc)
        s = (rng.integers(0, 5, size=(nq, nc)).astype(float) if trial % 2
             else rng.normal(size=(nq, nc)))
        ids = rng.permutation(1000)[:nc]
        r, rank, pos, _ = _top_k_rows(s, ids, k)
        for i in range(nq):
            expect = sorted(range(nc), key=lambda j: (-s[i, j], ids[j]))[:k]
            assert list(pos[r == i]) == expect
            assert list(rank[r == i]) == list(range(1, k + 1))


def test_random_split_disjoint_and_complete(spark):
    from rankloom.operators import random_split
    df = _model1_ratings(spark, SF01)
    a, b = random_split(df, (0.8, 0.2), seed=3)
    assert a.count() + b.count() == df.count()
    assert a.intersect(b).count() == 0


def test_registered_random_split_is_complete(spark):
    from rankloom import sources as src
    df = QUERIES["split_random"](spark, SF01)
    assert df.count() == src.click_log(spark, SF01).count()
    share = df.filter("split = 'train'").count() / df.count()
    assert 0.7 < share < 0.9
