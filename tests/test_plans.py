"""Plan-shape checks: the scale properties the design relies on stay true."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from rankloom.queries import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def static_plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", ["model1_matrix", "model2_matrix", "model3_matrix",
                                  "model4_matrix"])
def test_one_shuffle_of_the_event_side(spark, static_plans, name):
    plan = _plan(QUERIES[name](spark, SF01))
    # the dimension side is a broadcast (checked size); the only hash shuffle is the
    # final distinct, fed by a map-side partial aggregate
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
    assert "BroadcastHashJoin" in plan


def test_events_scan_is_pruned(spark, static_plans):
    plan = QUERIES["model1_matrix"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,event_type:string,props:string>" in plan


def test_top_n_emits_no_pair_table(spark, static_plans):
    plan = _plan(QUERIES["topn_products_per_user"](spark, SF01))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Join" in plan and "MapInPandas" in plan


def _jobs(spark, build):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_dimension_is_computed_and_measured_once(spark):
    from rankloom import operators as ops
    from rankloom import sources as src
    latest = ops.Dimension.of(QUERIES["latest_category_join"](spark, SF01))
    click = src.click_log(spark, SF01)
    assert _jobs(spark, lambda: [ops.events_with_category(ops.clean_events(click), latest) for _ in range(3)]) == 0
    assert _jobs(spark, lambda: ops.category_matrix_from_latest(click, latest, "drop")) == 0
    dim = latest.select("itemid", F.col("value").cast("int").alias("categoryid"))
    assert _jobs(spark, lambda: ops.join_dimension(click, dim, "itemid")) == 0


@pytest.mark.parametrize("name, most", [("model2_matrix", 5), ("model3_matrix", 5), ("model4_matrix", 5),
                                        ("model1_matrix", 11)])
def test_jobs_while_a_matrix_is_planned(spark, name, most):
    assert _jobs(spark, lambda: QUERIES[name](spark, SF01)) <= most


def test_stage_counts_scans_each_log_once(spark):
    plan = _plan(QUERIES["stage_counts"](spark, SF01))
    assert "FileScan parquet" not in plan  # only stored intermediates are left to read


@pytest.mark.parametrize("name", ["latest_category_join", "events_with_category",
                                  "events_of_active_semi", "events_of_active_gt1"])
def test_checked_dimension_joins_do_not_shuffle_the_fact_side(spark, static_plans, name):
    plan = _plan(QUERIES[name](spark, SF01))
    assert "Exchange hashpartitioning" not in plan, plan
    assert "BroadcastHashJoin" in plan
