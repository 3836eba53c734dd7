"""One-pass latest rows, the bucketed matrix store, mergeable distinct counts, observed counts."""

import datetime
import os
import subprocess
import sys

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF01
from rankloom import operators as ops
from rankloom import sources as src
from rankloom.operators.latest import reduce_batches, reduce_rows
from rankloom.plans import metrics as M
from rankloom.queries import QUERIES
from rankloom.session import scratch_path

# ---- latest rows


def brute_latest(rows):
    best = {}
    for key, ts, _ in rows:
        if key is not None and ts is not None:
            best[key] = max(best.get(key, ts), ts)
    return sorted((r for r in rows if r[0] is not None and r[1] is not None and r[1] == best[r[0]]), key=repr)


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(-3, 3)), st.sampled_from("ab")), max_size=60)


@settings(max_examples=200, deadline=None)
@given(ROWS, st.integers(1, 9), st.integers(2, 20))
def test_what_a_task_keeps_is_a_superset(rows, batch, held):
    table = pa.table({"k": pa.array([r[0] for r in rows], pa.int64()), "t": pa.array([r[1] for r in rows], pa.int64()),
                      "v": pa.array([r[2] for r in rows], pa.string())})
    kept = [tuple(r.values()) for b in reduce_batches(iter(table.to_batches(batch)), "k", "t", held) for r in b.to_pylist()]
    assert brute_latest(kept) == brute_latest(rows)
    whole = [tuple(r.values()) for r in reduce_rows(table, "k", "t").to_pylist()]
    assert sorted((r for r in whole if r[0] is not None and r[1] is not None), key=repr) == brute_latest(rows)


def test_a_hot_key_leaves_one_group_per_task(spark):
    df = spark.range(0, 200_000, 1, 8).select(F.lit("hot").alias("k"), (F.col("id") % 5_000).alias("t"), "id")
    assert ops.latest_candidates(df, "k", "t").count() <= 8 * 5  # of 200,000 rows
    got = ops.latest_rows(df, "k", "t")
    assert sorted(r["id"] for r in got.collect()) == list(range(4_999, 200_000, 5_000))


def test_ties_beyond_what_a_task_holds(spark):
    df = spark.range(0, 30_000, 1, 4).select(F.lit(1).alias("k"), F.lit(7).alias("t"), "id")
    assert ops.latest_rows(df, "k", "t", held_rows=500).count() == 30_000
    assert ops.latest_rows(df, "k", "t", held_rows=500, max_broadcast_bytes=0).count() == 30_000


@pytest.mark.parametrize("method", ["join", "window", "onepass"])
def test_the_forms_agree_for_other_types_and_clashing_columns(spark, method):
    day = datetime.date(2020, 1, 1)
    rows = [("x", day, {"a": 1}, 1), ("x", day, {"a": 1}, 1), ("x", datetime.date(2019, 1, 1), None, 2), ("", day, None, 3)]
    df = spark.createDataFrame(rows, "item string, at date, _rk map<string,int>, indices int").repartition(3)
    if method == "window":
        df = df.drop("_rk")  # the window's own column
    got = ops.latest_per_key(df, "item", "at", method)
    assert got.columns == df.columns
    assert sorted(r["indices"] for r in got.collect()) == [1, 1, 3]
    assert ops.latest_per_key(df.limit(0), "item", "at", method).count() == 0


# ---- events of active visitors, window form


@pytest.mark.parametrize("least", [0, 1, 50, 5_000])
def test_visitors_beyond_a_window_are_joined(spark, least):
    ids = spark.range(0, 3_000, 1, 4)
    events = ids.select((F.when(F.col("id") < 1_000, 7).when(F.col("id") < 1_100, 8).when(F.col("id") < 2_990, F.col("id"))).alias("visitorid"),
                        (F.col("id") % 3).alias("itemid"))
    joined = ops.events_of_active(events, least)
    got = ops.events_of_active(events, least, method="window", max_window_rows=60)
    assert got.columns == joined.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))
    assert "Window" in plan(got) and "LeftAnti" in plan(got)  # 7 and 8 meet in no window


# ---- bucketed matrix


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_matrix(spark):
    return src.BucketedMatrix.write(QUERIES["model3_matrix"](spark, SF01), buckets=6)


def test_counts_per_user_need_no_exchange(spark, stored_matrix):
    rows = stored_matrix.rows()
    for df in (ops.ratings_per_user(rows), ops.user_rating_crosstab(rows)):
        assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
    stats = plan(ops.ratings_per_user_stats(rows))
    assert "hashpartitioning" not in stats  # only the one row per task of the summary moves


def test_both_sides_of_the_rating_join_stay_in_place(spark, stored_matrix, tmp_path):
    ratings = stored_matrix.rows()
    other = src.BucketedMatrix.write(ratings.withColumn("prediction", F.col("rating") / 2).drop("rating"), buckets=6)
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    group = "in-place"
    spark.sparkContext.setJobGroup(group, group)
    got = src.joined_in_place(ratings, other.rows(), ["visitorid", "itemid"])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    assert all(len(j.stageIds) == 1 for j in jobs)  # no shuffle: a job is one stage
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    plain = M.score_and_labels(ratings.select(F.col("visitorid").alias("user"), F.col("itemid").alias("product"), "rating"),
                               other.rows().select(F.col("visitorid").alias("user"), F.col("itemid").alias("product"), "prediction"))
    assert sorted(map(tuple, got.select("visitorid", "itemid", "rating", "prediction").collect())) == sorted(map(tuple, plain.collect()))


def test_a_stored_matrix_opens_again_and_leaves_no_table(spark, stored_matrix):
    again = src.BucketedMatrix.open(spark, stored_matrix.path)
    assert (again.key, again.buckets) == ("visitorid", 6)
    assert again.rows().exceptAll(QUERIES["model3_matrix"](spark, SF01)).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("matrix_")]
    files = [f for f in os.listdir(stored_matrix.path.removeprefix("file:") + "/rows") if f.endswith(".parquet")]
    assert len(files) <= 6


def test_null_users_and_empty_matrices(spark):
    schema = "visitorid bigint, itemid bigint, rating double, `a b` string"
    for rows in ([], [(None, 1, 1.0, "x"), (None, 1, 1.0, "x"), (1, None, None, None)]):
        stored = src.BucketedMatrix.write(spark.createDataFrame(rows, schema), buckets=3)
        assert sorted(map(repr, map(tuple, stored.rows().collect()))) == sorted(map(repr, rows))


def test_a_store_that_was_not_finished_cannot_be_opened(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/rows")
    with pytest.raises(Exception):
        src.BucketedMatrix.open(spark, str(tmp_path))


# ---- sketches


def test_parts_merge_within_the_error_bound(spark):
    log = spark.range(0, 300_000, 1, 8).select((F.col("id") % 3).cast("string").alias("day"),
                                               F.when(F.col("id") % 3 != 0, F.col("id") % 70_000).cast("int").alias("visitor"),
                                               F.concat(F.lit("sku-"), (F.col("id") % 900).cast("string")).alias("sku"))
    store = ops.SketchStore.open(spark, ["visitor", "sku"], scratch_path(spark, "sketch-test"))
    empty = store.estimates().first()
    assert (empty["n_rows"], empty["n_visitor"]) == (0, 0)
    for day in ("0", "1"):
        store.add(log.filter(F.col("day") == day), "day")
    # A later load sketches its own part alone; one that is repeated changes nothing.
    kept = {r["part"]: bytes(r["visitor"] or b"") for r in store.sketches().collect()}
    for _ in range(2):
        store.add(log.filter(F.col("day") == "2"), "day")
    now = {r["part"]: bytes(r["visitor"] or b"") for r in store.sketches().collect()}
    assert set(now) == {"0", "1", "2"} and {p: now[p] for p in kept} == kept
    got = store.estimates().first()
    assert got["n_rows"] == 300_000
    exact = log.agg(F.count_distinct("visitor").alias("v"), F.count_distinct("sku").alias("s")).first()
    bound = 4 * ops.relative_error()
    assert abs(got["n_visitor"] - exact["v"]) <= bound * exact["v"]
    assert abs(got["n_sku"] - exact["s"]) <= max(1, bound * exact["s"])
    by = {r["part"]: r for r in store.estimates(["part"]).collect()}
    assert by["0"]["n_rows"] == 100_000 and by["0"]["n_visitor"] == 0  # null ids are rows, not ids


def test_names_of_the_store_are_refused(spark):
    with pytest.raises(ValueError):
        ops.SketchStore.open(spark, ["part"])


# ---- counts of a run's stages


def inputs(spark, props, events):
    schema = "timestamp bigint, itemid int, property string, value string"
    return (spark.createDataFrame(events, "timestamp bigint, visitorid int, event string, itemid int, transactionid bigint"),
            [spark.createDataFrame(p, schema) for p in props])


PROPS = [[(1, 1, "categoryid", "7"), (2, 1, "categoryid", "8"), (2, 1, "categoryid", "9"), (1, 2, "size", "x")],
         [(5, 2, "categoryid", "7"), (None, 3, "categoryid", "1")]]
EVENTS = [(1, 10, "view", 1, None), (2, 10, "view", 1, None), (3, None, "transaction", 2, 5), (4, 11, "error", 2, None), (5, 11, "view", 4, None)]
COUNTED = {"item_props_part1": 4, "item_props_part2": 2, "item_props": 6, "category_rows": 5, "latest_items": 3, "latest_rows": 3,
           "events": 5, "events_with_category": 6, "model1_matrix": 3}


@pytest.mark.parametrize("bound", [1 << 28, 0])
def test_counts_and_matrix_of_one_run(spark, bound):
    events, parts = inputs(spark, PROPS, EVENTS)
    matrix, n = ops.audited_category_matrix(events, parts, "drop", max_broadcast_bytes=bound)
    assert n == COUNTED
    assert sorted(map(repr, map(tuple, matrix.collect()))) == sorted(map(repr, map(tuple, ops.category_matrix(events, parts, "drop").collect())))


@pytest.mark.parametrize("props, events", [([[], PROPS[1]], EVENTS), ([[], []], EVENTS), (PROPS, []), ([[], []], [])])
def test_counts_of_empty_inputs(spark, props, events):
    frame, parts = inputs(spark, props, events)
    matrix, n = ops.audited_category_matrix(frame, parts, "drop")
    assert n["item_props"] == sum(map(len, props)) and n["events"] == len(events)
    assert n["model1_matrix"] == matrix.count() == ops.category_matrix(frame, parts, "drop").count()


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from rankloom.operators.audit import StageCounts
spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def flaky(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2:
        raise RuntimeError("lost")

counts = StageCounts()
df = counts.watch(spark.range(0, 1000, 1, 4), "read")
counts.write(counts.watch(df.mapInArrow(flaky, "id long"), "mapped"))
print(counts.n)
"""


def test_tasks_that_are_run_again_count_once(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path)], cwd=repo, env={**os.environ, "PYTHONPATH": repo},
                          capture_output=True, text=True, timeout=180)
    assert "{'read': 1000, 'mapped': 1000}" in done.stdout, done.stderr[-2000:]
