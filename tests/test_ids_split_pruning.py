"""Pruned top-N, id dictionaries, row-level split, contingency tables, model store."""

import collections
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from rankloom import operators as ops
from rankloom.plans import store
from rankloom.plans.pruned import pruned_top_n
from rankloom.plans.recommend import top_n
from rankloom.queries import QUERIES
from rankloom.session import scratch_path

# ---- pruned top-N


def factor_frame(spark, ids, vectors):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)],
                                 "id int, features array<double>")


def listed(df):
    return sorted((r["user"], r["rank"], r["product"], repr(r["score"] if r["score"] is None else round(r["score"], 9))) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Products as a factor model has them: few of great norm, many small ones."""
    rng = np.random.default_rng(1)
    norms = rng.lognormal(0, 1.5, 1200)
    return (factor_frame(spark, range(150), rng.normal(0, 1, (150, 8))),
            factor_frame(spark, rng.permutation(1200), rng.normal(0, 1, (1200, 8)) * norms[:, None]))


def test_most_cells_are_not_scored(skewed):
    users, products = skewed
    got = pruned_top_n(users, products, 10, block_rows=40, cand_block_rows=30)
    assert listed(got.lists) == listed(top_n(users, products, 10))
    assert got.cells < 0.35 * 150 * 1200 and got.rounds >= 4


def test_equal_norms_need_the_whole_grid(spark):
    rng = np.random.default_rng(2)
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    users, products = (factor_frame(spark, range(n), unit(rng.normal(0, 1, (n, 6)))) for n in (40, 200))
    got = pruned_top_n(users, products, 5, block_rows=16, cand_block_rows=25)
    assert listed(got.lists) == listed(top_n(users, products, 5))
    assert got.cells == 40 * 200  # the stated worst case, and no cell twice


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(3)
    vectors = [*rng.integers(-2, 3, (60, 3)), [0, 0, 0], None, [float("nan"), 1, 1]]
    users = factor_frame(spark, [*range(62), 61], vectors)  # an id twice, ties, zeros, a NaN, no vector
    products = factor_frame(spark, [*range(100, 162), 161], vectors)
    for rows in (200, 7):
        got = pruned_top_n(users, products, 4, block_rows=rows, cand_block_rows=rows)
        assert listed(got.lists) == listed(top_n(users, products, 4))
    empty = users.limit(0)
    assert pruned_top_n(empty, products).lists.count() == 0 and pruned_top_n(users, empty).lists.count() == 0


def test_excluded_pairs_are_not_listed(spark, skewed):
    users, products = skewed
    seen = top_n(users, products, 6).select("user", "product")  # the best ones, twice, and unknown ids
    seen = seen.unionByName(seen).unionByName(spark.createDataFrame([(1, 99999), (99999, 1)], "user int, product int"))
    got = pruned_top_n(users, products, 10, block_rows=40, cand_block_rows=50, exclude=seen).lists
    longer = top_n(users, products, 16).filter("rank > 6").withColumn("rank", F.col("rank") - 6)
    assert listed(got) == listed(longer)
    few = products.limit(3)
    everything = users.select(F.col("id").alias("user")).crossJoin(few.select(F.col("id").alias("product"))).filter("user < 100")
    assert {r["user"] for r in pruned_top_n(users, few, 10, exclude=everything).lists.collect()} == set(range(100, 150))


# ---- ids

def matrix(spark, rows):
    return spark.createDataFrame(rows, "visitorid string, itemid long, rating double")


def test_ids_stay_when_ids_are_added(spark):
    first = matrix(spark, [("b", 2**40, 1.0), ("a", 5, 2.0), (None, 7, 1.0), ("a", None, 1.0)])
    later = matrix(spark, [("c", 5, 1.0), ("a", -2**50, 3.0), ("0", 2**40, 1.0)])
    ids = ops.RatingIds.of(first)
    more = ids.extend(later)
    held = {r["raw"]: r["id"] for r in ids.users.table.collect()}
    all_ids = {r["raw"]: r["id"] for r in more.users.table.collect()}
    assert held == {"a": 0, "b": 1} and all_ids == {"a": 0, "b": 1, "0": 2, "c": 3}
    assert sorted(r["id"] for r in more.products.table.collect()) == [0, 1, 2, 3] and more.products.size == 4
    got = more.decode(more.ratings(first.unionByName(later)))
    want = [r for r in [tuple(r) for r in first.collect() + later.collect()] if None not in r]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert ids.ratings(later).count() == 0  # unknown ids go
    with pytest.raises(TypeError):
        ids.users.encode(later, "itemid")


def test_both_join_paths_and_reload(spark):
    rows = [(f"u{k % 37}", 2**33 + k % 11, float(k % 3)) for k in range(300)]
    m = matrix(spark, rows)
    ids = ops.RatingIds.of(m)
    path = scratch_path(spark, "ids")
    ids.save(path)
    again = ops.RatingIds.load(spark, path)
    small = sorted(map(tuple, ids.users.encode(m, "visitorid").collect()))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # nothing shipped at run time either
    try:
        large = again.users.encode(m, "visitorid", max_broadcast_bytes=0)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert small == sorted(map(tuple, large.collect()))
        assert sorted(map(tuple, again.users.decode(large, "visitorid", 0).collect())) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_numbers_ascend_with_the_key_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    got = sorted((r["k"], r["id"]) for r in ops.numbered(df, ["k"], start=10).collect())
    assert got == [(k, k + 10) for k in range(5000)]
    assert ops.numbered(df.limit(0), ["k"]).count() == 0


def test_string_ids_through_the_workflow(spark):
    from rankloom.workflow import train_and_recommend
    base = scratch_path(spark, "strings")
    m = QUERIES["model3_matrix"](spark, SF001).select(
        F.concat(F.lit("v"), "visitorid").alias("visitorid"), F.concat(F.lit("s"), "itemid").alias("itemid"), "rating")
    m.write.parquet(f"{base}/m")
    outs = train_and_recommend(spark, f"{base}/m", 3, f"{base}/out", rank=3, max_iter=2, ids="dictionary", id_type="string",
                               models=f"{base}/models", unseen=True)
    pairs = {(r["visitorid"], r["itemid"]) for r in m.select("visitorid", "itemid").collect()}
    top = spark.read.parquet(outs["top_products"]).collect()
    assert top and {r["user"] for r in top} <= {u for u, _ in pairs} and {r["product"] for r in top} <= {i for _, i in pairs}
    sides = {r["side"]: r["id"][0] for r in spark.read.parquet(outs["factors"]).collect()}
    assert sides == {"user": "v", "product": "s"}
    listed_pairs = {(r["user"], r["product"]) for r in top}
    assert len(listed_pairs & pairs) < 0.5 * len(pairs)  # training items are not listed; held-out ones may be
    assert len([d for d in os.listdir(f"{base}/models".removeprefix("file:")) if not d.startswith(("_", "."))]) == 1


# ---- row-level split

def test_the_split_is_that_of_the_rows(spark):
    rows = [(1, "a", None)] * 900 + [(k, "b", k * 2) for k in range(600)] + [(None, None, None)] * 50
    df = spark.createDataFrame(rows, "x long, y string, rows long")
    count = lambda d: collections.Counter(map(tuple, d.collect()))
    one = count(ops.row_split(df.repartition(1)))
    assert one == count(ops.row_split(df.repartition(200))) == count(ops.row_split(df, run_rows=7))
    kept = collections.Counter()
    for row, n in one.items():
        kept[row[:-1]] += n
    assert kept == collections.Counter(rows)
    hot = {row[-1]: n for row, n in one.items() if row[0] == 1 and row[1] == "a"}
    assert set(hot) == {"train", "test"} and 0.7 < hot["train"] / 900 < 0.9
    share = sum(n for row, n in one.items() if row[-1] == "train") / len(rows)
    assert 0.75 < share < 0.85
    assert ops.row_split(df.limit(0)).count() == 0


def test_a_hot_row_is_the_work_of_many_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("x"))
    parts = ops.row_split(df, run_rows=500).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 12_000


# ---- contingency tables

def test_contingency_forms_agree(spark):
    rows = [(k % 5 if k % 7 else None, f"l{k % 4}" if k % 6 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "a int, b string")
    want = collections.Counter(rows)
    long = ops.contingency(df, "a", "b", max_levels=4)
    assert not long.wide and long.n_levels == 5
    assert {(r["a"], r["b"]): r["n"] for r in long.table.collect()} == want
    wide = ops.contingency(df, "a", "b")
    levels = [r["level"] for r in sorted(wide.levels.collect(), key=lambda r: r["place"])]
    assert wide.wide and levels == [None, "l0", "l1", "l2", "l3"]
    got = {r["a"]: r["counts"] for r in wide.table.collect()}
    assert got == {a: [want[a, b] for b in levels] for a in {a for a, _ in rows}}
    same = ops.contingency(df, "b", "b").table.collect()  # a column against itself
    assert all(sum(map(bool, r["counts"])) == 1 for r in same)
    assert ops.contingency(df.limit(0), "a", "b").table.count() == 0
    empty = spark.createDataFrame([(1, ""), (1, None), (2, "")], "a int, b string")
    assert {r["a"]: r["counts"] for r in ops.contingency(empty, "a", "b").table.collect()} == {1: [1, 1], 2: [0, 1]}


# ---- model store

def test_nine_queries_share_one_fit(spark, monkeypatch):
    fits = []
    monkeypatch.setattr(store, "fit", lambda ratings, implicit, **kw: fits.append(kw) or fit(ratings, implicit, **kw))
    monkeypatch.setattr(store, "checkpoint_root", lambda s, root=scratch_path(spark, "fresh-store"): root)
    from rankloom.plans.factorize import fit
    for name in ("als_implicit_predict", "als_factors", "als_recommend_products", "als_recommend_users", "als_ranking_metrics",
                 "als_scored_pairs_m1", "als_factor_index", "als_listed_products", "als_listed_users"):
        assert QUERIES[name](spark, SF001).count() > 0
    assert len(fits) == 1


def test_other_data_or_parameters_are_other_models(spark):
    rows = [(u, p, float((u * p) % 3)) for u in range(8) for p in range(6)]
    df = spark.createDataFrame(rows, "user int, product int, rating double")
    name = store.fingerprint(df, True, rank=3)
    assert name == store.fingerprint(df.repartition(7), True, rank=3)
    others = [df.unionByName(df.limit(1)), df.filter("user > 0 or product > 0"), df.withColumn("rating", F.when(F.col("user") == 1, 9.0).otherwise(F.col("rating")))]
    assert len({name, store.fingerprint(df, False, rank=3), store.fingerprint(df, True, rank=4), *[store.fingerprint(o, True, rank=3) for o in others]}) == 6
    models = store.ModelStore(spark, scratch_path(spark, "models"))
    first = models.fit_once(df, False, rank=3, max_iter=2, reg_param=0.1)
    again = models.fit_once(df, False, rank=3, max_iter=2, reg_param=0.1)
    assert sorted(map(tuple, first.userFactors.collect())) == sorted(map(tuple, again.userFactors.collect()))
    # A torn write lies aside under another name; a second writer's model gives way.
    name = store.fingerprint(df, True, rank=2, max_iter=1)
    os.makedirs(f"{models.root}/_torn/metadata".removeprefix("file:"))
    assert not models.has(name)
    models.save(first, name)
    models.save(again, name)
    left = [d for d in os.listdir(models.root.removeprefix("file:")) if d.startswith("_") and d != "_torn"]
    assert models.has(name) and not left and models.load(name).rank == 3
