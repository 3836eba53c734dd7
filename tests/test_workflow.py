"""Raw CSV inputs -> the four matrices -> ALS outputs, equal to the registered queries."""

from pyspark.sql import functions as F

from conftest import SF001
from rankloom import sources as src
from rankloom.queries import QUERIES
from rankloom.session import scratch_path
from rankloom.workflow import build_matrices, train_and_recommend


def test_csv_inputs_to_matrices_and_recommendations(spark):
    base = scratch_path(spark, "raw")
    src.click_log(spark, SF001).write.option("header", True).csv(f"{base}/events")
    p1, p2 = src.item_props_parts(spark, SF001)
    p1.write.option("header", True).csv(f"{base}/props1")
    p2.write.option("header", True).csv(f"{base}/props2")
    paths = build_matrices(spark, f"{base}/events", [f"{base}/props1", f"{base}/props2"],
                           f"{base}/out", on_unknown="drop")
    m1 = spark.read.parquet(paths[1])
    expect = QUERIES["model1_matrix"](spark, SF001)
    assert m1.count() == expect.count() and m1.exceptAll(expect).count() == 0
    assert spark.read.parquet(paths[2]).count() >= spark.read.parquet(paths[3]).count() \
        >= spark.read.parquet(paths[4]).count()
    outs = train_and_recommend(spark, paths[1], 1, f"{base}/als", rank=4, max_iter=3)
    top = spark.read.parquet(outs["top_products"])
    assert top.groupBy("user").count().agg(F.max("count")).first()[0] <= 10
    met = spark.read.parquet(outs["holdout_metrics"]).first()
    assert met["n"] > 0 and met["rmse"] >= 0


def test_cli_main(spark, capsys):
    import json

    from rankloom.__main__ import main
    base = scratch_path(spark, "cli")
    src.click_log(spark, SF001).write.option("header", True).csv(f"{base}/events")
    p1, p2 = src.item_props_parts(spark, SF001)
    p1.write.option("header", True).csv(f"{base}/p1")
    p2.write.option("header", True).csv(f"{base}/p2")
    main(["matrices", "--events", f"{base}/events", "--props", f"{base}/p1", f"{base}/p2",
          "--out", f"{base}/m", "--models", "1", "3", "--on-unknown", "drop"])
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(paths) == {"1", "3"}
    assert spark.read.parquet(paths["1"]).count() == 238
    main(["recommend", "--matrix", paths["1"], "--model", "1", "--out", f"{base}/r",
          "--rank", "4", "--iters", "3", "--collapse", "max"])
    outs = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert spark.read.parquet(outs["top_users"]).count() > 0
    main(["tune", "--matrix", paths["1"], "--model", "1", "--out", f"{base}/t", "--method", "tvs"])
    outs = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    row = spark.read.parquet(outs["tuning"]).first()
    assert row["model"] == 1 and row["rank"] in (5, 10) and row["n"] > 0
