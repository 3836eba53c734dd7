"""The over-the-bound (shuffle) branches give the same rows as the broadcast branches,
also when one visitor / one item holds a third of all rows (AQE skew splitting on)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from rankloom import operators as ops
from rankloom import sources as src


@pytest.fixture
def skew_conf(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_visitor_matrices_shuffle_path_with_hot_visitor(spark, skew_conf):
    ev = src.basket_log(spark, SF01)
    # one visitor takes a third of all rows
    hot = ev.withColumn("visitorid", F.when(F.col("visitorid") % 3 == 0, F.lit(0))
                        .otherwise(F.col("visitorid")))
    for k, dt in [(1, False), (1, True), (2, True)]:
        _same(ops.visitor_matrix(hot, k, dt), ops.visitor_matrix(hot, k, dt, max_broadcast_bytes=0))
    lit = (ops.weight_events(ops.events_of_active(hot, 1, method="join").distinct())
           .select("visitorid", "itemid", "rating").distinct())
    _same(lit, ops.visitor_matrix(hot, 1, True, max_broadcast_bytes=0))


def test_category_matrix_shuffle_path_with_hot_item(spark, skew_conf):
    click = src.click_log(spark, SF01)
    hot = click.withColumn("itemid", F.when(F.col("visitorid") % 3 == 0, F.lit(7))
                           .otherwise(F.col("itemid")))
    parts = list(src.item_props_parts(spark, SF01))
    _same(ops.category_matrix(hot, parts, "drop"), ops.category_matrix(hot, parts, "drop", max_broadcast_bytes=0))
    props = ops.filter_property(ops.union_parts(*parts))
    _same(ops.latest_per_key(props), ops.latest_per_key(props, max_broadcast_bytes=0))
    _same(ops.events_of_active(src.basket_log(spark, SF01), 1, method="semi"),
          ops.events_of_active(src.basket_log(spark, SF01), 1, method="join").drop("count"))
