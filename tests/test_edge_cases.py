"""FIXTURES.md part 4: small inline frames for the edge cases."""

import pytest
from pyspark.sql import functions as F

from rankloom import operators as ops
from rankloom import sources as src
from rankloom.plans import metrics as M
from rankloom.plans.recommend import predict_pairs

EV_COLS = "timestamp long, visitorid long, event string, itemid long, transactionid long"
PROP_COLS = "timestamp long, itemid int, property string, value string"


def test_ties_at_latest_timestamp_both_survive(spark):
    props = spark.createDataFrame([(10, 1, "categoryid", "5"), (10, 1, "categoryid", "6"),
                                   (5, 1, "categoryid", "7"), (3, 2, "categoryid", "8")],
                                  PROP_COLS)
    for method in ("join", "window"):
        got = sorted(r["value"] for r in ops.latest_per_key(props, method=method).collect())
        assert got == ["5", "6", "8"]


def test_uncategorised_item_dropped(spark):
    ev = spark.createDataFrame([(1, 1, "view", 1, None), (2, 2, "view", 99, None)],
                               "timestamp long, visitorid int, event string, itemid int, transactionid long")
    props = spark.createDataFrame([(10, 1, "categoryid", "5")], PROP_COLS)
    m = ops.category_matrix(ev, [props])
    assert [tuple(r) for r in m.collect()] == [(1, 5, 1.0)]


def test_duplicate_event_with_null_transaction_collapses(spark):
    ev = spark.createDataFrame([(1, 7, "view", 3, None), (1, 7, "view", 3, None),
                                (2, 7, "view", 4, None)], EV_COLS)
    m2 = ops.visitor_matrix(ev, 1, distinct_triples=False)
    assert m2.count() == 2


def test_repeated_pair_fans_out(spark):
    ratings = spark.createDataFrame([(1, 1, 1.0), (1, 1, 3.0)], "user int, product int, rating double")
    preds = spark.createDataFrame([(1, 1, 2.0), (1, 1, 2.0)], "user int, product int, prediction double")
    assert M.score_and_labels(ratings, preds).count() == 4
    assert M.score_and_labels(ratings, preds, dedupe_pairs=True).count() == 2


def test_unknown_label_policies(spark):
    ev = spark.createDataFrame([(1, 1, "view", 1, None), (2, 1, "signup", 1, None)], EV_COLS)
    with pytest.raises(Exception, match="unknown event label"):
        ops.weight_events(ev, on_unknown="error").collect()
    nulls = ops.weight_events(ev, on_unknown="null").filter(F.col("rating").isNull()).count()
    assert nulls == 1
    assert ops.weight_events(ev, on_unknown="drop").count() == 1


def test_label_text_in_other_column_left_alone(spark):
    props = spark.createDataFrame([(1, 1, "view", "view")], PROP_COLS)
    ev = props.withColumn("event", F.lit("addtocart"))
    out = ops.weight_events(ev).first()
    assert out["property"] == "view" and out["value"] == "view" and out["rating"] == 2.0


def test_unknown_id_at_prediction(spark):
    uf = spark.createDataFrame([(1, [1.0, 0.0])], "id int, features array<double>")
    pf = spark.createDataFrame([(1, [2.0, 1.0])], "id int, features array<double>")
    pairs = spark.createDataFrame([(1, 1), (2, 1)], "user int, product int")
    assert predict_pairs(pairs, uf, pf).count() == 1
    nan = predict_pairs(pairs, uf, pf, cold_start="nan").collect()
    assert len(nan) == 2 and any(r["prediction"] != r["prediction"] for r in nan)


def test_threshold_above_every_count_gives_empty_typed_matrix(spark):
    ev = spark.createDataFrame([(1, 7, "view", 3, None), (2, 7, "view", 4, None)], EV_COLS)
    m = ops.visitor_matrix(ev, 100)
    assert m.count() == 0
    assert m.columns == ["visitorid", "itemid", "rating"]
    assert dict(m.dtypes)["rating"] == "double"


def test_multi_part_csv_headers_do_not_leak(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 5, float(1 + i % 3)) for i in range(50)],
                               "visitorid long, itemid long, rating double").repartition(4)
    path = src.write_rating_matrix(df, str(tmp_path / "m"), "csv")
    import glob
    assert len(glob.glob(f"{path}/part-*.csv")) > 1
    back = src.load_rating_matrix(spark, path, "csv")
    assert back.count() == 50
    assert back.exceptAll(df).count() == 0
    # ledger: text lines = rows + one header per part file
    parts = glob.glob(f"{path}/part-*.csv")
    assert spark.read.text(path).count() == 50 + len(parts)
    assert src.load_rating_matrix(spark, path, "csv", header_lines="every").count() == 50


def test_id_above_int_range_is_a_clear_error(spark):
    df = spark.createDataFrame([(2 ** 31, 1, 1.0)], "visitorid long, itemid long, rating double")
    with pytest.raises(Exception, match="outside the INT range"):
        ops.to_ratings(df).collect()


def test_constant_labels_r2_null(spark):
    sl = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "rating double, prediction double")
    r = M.regression_metrics(sl).first()
    assert r["r2"] is None and abs(r["rmse"] - 0.5) < 1e-12


def test_epoch_millis_ignores_session_time_zone(spark):
    from rankloom.functions import epoch_millis
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:00:07.179575' AS ts")
        assert df.select(epoch_millis("ts")).first()[0] == 1719835207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_header_line_in_the_middle_dropped_everywhere(spark, tmp_path):
    d = tmp_path / "m"
    d.mkdir()
    (d / "part-0.csv").write_text("visitorid,itemid,rating\n1,2,1.0\nvisitorid,itemid,rating\n3,4,3.0\n")
    (d / "part-1.csv").write_text("visitorid,itemid,rating\n5,6,2.0\n")
    back = src.load_rating_matrix(spark, str(d), "csv", header_lines="every")
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2, 1.0), (3, 4, 3.0), (5, 6, 2.0)]
    assert dict(back.dtypes) == {"visitorid": "bigint", "itemid": "bigint", "rating": "double"}
    with pytest.raises(Exception):
        src.load_rating_matrix(spark, str(d), "csv").collect()   # first-line-only reader fails fast


def test_collapse_repeated_pairs(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 1, 3.0), (2, 1, 2.0)],
                               "visitorid long, itemid long, rating double")
    got = {c: sorted(tuple(r) for r in ops.to_ratings(df, collapse=c).collect())
           for c in ("none", "max", "sum", "mean")}
    assert got["none"] == [(1, 1, 1.0), (1, 1, 3.0), (2, 1, 2.0)]
    assert got["max"] == [(1, 1, 3.0), (2, 1, 2.0)]
    assert got["sum"] == [(1, 1, 4.0), (2, 1, 2.0)]
    assert got["mean"] == [(1, 1, 2.0), (2, 1, 2.0)]
    with pytest.raises(ValueError):
        ops.to_ratings(df, collapse="first")


def test_cluster_without_shared_checkpoint_folder_is_refused():
    from rankloom.session import checkpoint_root

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        sparkContext = _Ctx()
        conf = _Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session())
