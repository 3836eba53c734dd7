"""The trained model does not depend on the cluster; exact parts of it; blocks and NaN in
top-N; metrics without fan-out; what a launcher sets is kept."""

import json
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from rankloom import sources as src
from rankloom.plans import metrics as M
from rankloom.plans.factorize import DEFAULT_BLOCKS, factors, fit, make_als
from rankloom.plans.ranking import ranking_metrics
from rankloom.plans.recommend import predict_one, predict_pairs, top_n
from rankloom.queries import QUERIES, _click_ratings, _model1_ratings

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _vectors(model):
    return {(r["side"], r["id"]): np.array(r["features"]) for r in factors(model).collect()}


def _close(a, b):
    assert a.keys() == b.keys()
    assert max(np.abs(a[k] - b[k]).max() for k in a) < 1e-3


def test_model_is_the_same_for_any_partitioning(spark):
    ratings = _model1_ratings(spark, SF01).checkpoint()
    models = [_vectors(fit(ratings.repartition(n), implicit=False, rank=4, max_iter=4)) for n in (1, 8)]
    _close(*models)
    als = make_als(False)
    assert als.getNumUserBlocks() == als.getNumItemBlocks() == DEFAULT_BLOCKS == 10


SCRIPT = """
import json, sys
from rankloom.session import build_session
from rankloom.queries import _model1_ratings
from rankloom.plans.factorize import factors, fit
spark = build_session()
model = fit(_model1_ratings(spark, sys.argv[1]), implicit=False, rank=3, max_iter=3)
rows = sorted((r["side"], r["id"], list(r["features"])) for r in factors(model).collect())
print(json.dumps({"master": spark.sparkContext.master, "rows": rows,
                  "width": spark.conf.get("spark.sql.shuffle.partitions")}))
"""


def _launched(args, *, script=SCRIPT):
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=f"{args} pyspark-shell", PYTHONPATH=REPO)
    done = subprocess.run([sys.executable, "-c", script, SF001], env=env, cwd=REPO, capture_output=True, text=True,
                          timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return json.loads(done.stdout.strip().splitlines()[-1])


def test_launcher_settings_are_kept_and_cores_do_not_change_the_model():
    two = _launched("--master local[2] --conf spark.sql.shuffle.partitions=77 --driver-memory 2g")
    four = _launched("--master local[4] --driver-memory 2g")
    assert two["master"] == "local[2]" and two["width"] == "77" and four["master"] == "local[4]"
    _close(*({(s, i): np.array(f) for s, i, f in x["rows"]} for x in (two, four)))


def test_user_factors_solve_the_last_ridge_step(spark):
    """The users' side is solved last: (sum v v' + reg n I) x = sum r v over a user's ratings."""
    ratings = _model1_ratings(spark, SF01).checkpoint()
    reg = 0.05
    f = _vectors(fit(ratings, implicit=False, rank=4, max_iter=5, reg_param=reg))
    rows = ratings.collect()
    for user in sorted({r["user"] for r in rows})[:40]:
        own = [(f["product", r["product"]], r["rating"]) for r in rows if r["user"] == user]
        v, y = np.array([a for a, _ in own]), np.array([b for _, b in own])
        x = np.linalg.solve(v.T @ v + reg * len(y) * np.eye(4), v.T @ y)
        assert np.allclose(x, f["user", user], atol=2e-3)


@pytest.mark.parametrize("sf", [SF01, "/root/testdata/sf0.1"])
def test_factor_sides_grow_and_no_pair_is_lost(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    users, products = src.user_factors(spark, sf), src.product_factors(spark, sf)
    assert users.count() == vectors // 2 and products.count() == vectors - vectors // 2
    marked = QUERIES["predict_pairs_marked"](spark, sf)
    assert marked.count() == _click_ratings(spark, sf).count()
    known = marked.filter("known")
    assert known.filter("prediction is null").count() == 0
    assert known.count() == QUERIES["predict_pairs_from_factors"](spark, sf).count()
    assert known.count() >= 0.5 * marked.count()


def test_one_prediction(spark):
    uf, pf = src.user_factors(spark, SF01), src.product_factors(spark, SF01)
    pair = spark.createDataFrame([(3, 5)], "user int, product int")
    assert abs(predict_one(3, 5, uf, pf) - predict_pairs(pair, uf, pf).first()["prediction"]) < 1e-9
    assert predict_one(10 ** 8, 5, uf, pf) is None


def _lists(df):
    out = {}
    for r in df.orderBy("user", "rank").collect():
        out.setdefault(r["user"], []).append(r["product"])
    return out


@pytest.mark.parametrize("rows", [2, 100])
def test_top_n_with_nan_vectors_and_repeated_ids(spark, rows):
    nan = float("nan")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [nan, 1.0])], "id int, features array<double>")
    c = spark.createDataFrame([(10, [1.0, 2.0]), (11, [nan, 0.0]), (12, [3.0, 1.0]), (13, None)],
                              "id int, features array<double>")
    got = _lists(top_n(q, c, 3, max_block_rows=rows))
    assert got == {1: [12, 10, 11], 2: [10, 12, 11], 4: [10, 11, 12]}
    assert _lists(top_n(q, c, 2, max_block_rows=rows))[1] == [12, 10]
    repeated = spark.createDataFrame([(7, [float(k), 0.0]) for k in range(50)] + [(8, [100.0, 0.0])],
                                     "id int, features array<double>")
    top = top_n(q.filter("id = 1"), repeated, 3, max_block_rows=rows).orderBy("rank").collect()
    assert [(r["product"], r["score"]) for r in top] == [(8, 100.0), (7, 49.0), (7, 48.0)]
    assert top_n(q, c.limit(0), 3).count() == 0 and top_n(q.limit(0), c, 3).count() == 0


def test_planning_top_n_collects_no_factor():
    text = open(os.path.join(REPO, "rankloom/plans/recommend.py")).read()
    body = text[text.index("def _packed"):]
    assert "toPandas" not in body and "broadcast(" not in body and ".collect(" not in body


def test_metrics_of_a_hot_pair_without_fan_out(spark):
    n = 10_000
    ratings = spark.range(n).select(F.lit(1).alias("user"), F.lit(1).alias("product"),
                                    (1.0 + F.col("id") % 3).alias("rating")).union(
        spark.createDataFrame([(2, 1, 3.0), (2, 2, 1.0)], "user int, product int, rating double"))
    preds = spark.range(n).select(F.lit(1).alias("user"), F.lit(1).alias("product"), F.lit(1.5).alias("prediction")) \
        .union(spark.createDataFrame([(2, 1, 2.0)], "user int, product int, prediction double"))
    sl = M.weighted_score_and_labels(ratings, preds)
    assert sl.count() == 4  # three values of the hot pair, one of the other
    got = M.regression_metrics(sl, weight="weight").first()
    r = np.array([1.0 + k % 3 for k in range(n)])
    labels, err = np.append(np.repeat(r, 1), []), 1.5 - r
    count = n * n + 1
    sse = n * (err ** 2).sum() + 1.0
    mean = (n * labels.sum() + 3.0) / count
    sst = n * ((labels - mean) ** 2).sum() + (3.0 - mean) ** 2
    assert got["n"] == count
    assert got["mse"] == pytest.approx(sse / count) and got["mae"] == pytest.approx((n * np.abs(err).sum() + 1) / count)
    assert got["r2"] == pytest.approx(1 - sse / sst, abs=1e-9)


@pytest.mark.parametrize("name", ["click", "model1"])
def test_weighted_metrics_equal_the_plain_join(spark, name):
    ratings = _click_ratings(spark, SF01) if name == "click" else _model1_ratings(spark, SF01)
    preds = ratings.select("user", "product", (F.col("product") % 3 + 0.5).alias("prediction"))
    plain = M.regression_metrics(M.score_and_labels(ratings, preds)).first()
    folded = M.regression_metrics(M.weighted_score_and_labels(ratings, preds), weight="weight").first()
    for k in ("n", "mse", "rmse", "mae", "r2"):
        assert folded[k] == pytest.approx(plain[k], rel=1e-9)


def test_users_without_a_list_count_as_zero(spark):
    top = spark.createDataFrame([(1, 1, 1)], "user int, rank int, hit int")
    rel = spark.createDataFrame([(1, 1), (2, 3)], "user int, n_rel long")
    r = ranking_metrics(top, rel, 10).first()
    assert r["users"] == 2 and r["map"] == 0.5


def test_tuning_reports_the_best_models_setting(spark):
    from rankloom.plans.tune import tune
    from rankloom.queries import _split_pairs
    train, test = _split_pairs(_model1_ratings(spark, SF01))
    best, summary = tune(train, test, method="tvs", param_grid=None)
    row = summary.first()
    assert row["rank"] == best.rank and best._java_obj.parent().getAlpha() == 1.0
    assert row["reg_param"] == best._java_obj.parent().getRegParam()


def test_round_trips_leave_no_files(spark):
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    for name in ("write_read_roundtrip", "load_rating_matrix", "scan_events_csv"):
        QUERIES[name](spark, SF001).count()
    assert not [d for d in os.listdir(root) if d.startswith("round-trip")]
