"""Randomised properties (hypothesis): operators against straightforward references."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rankloom import operators as ops
from rankloom.plans.ranking import ranking_metrics

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

events_st = st.lists(st.tuples(st.integers(0, 3),            # timestamp
                               st.integers(0, 4),            # visitor
                               st.sampled_from(["view", "addtocart", "transaction"]),
                               st.integers(0, 3),            # item
                               st.one_of(st.none(), st.integers(0, 2))),
                     min_size=1, max_size=40)


@SETTINGS
@given(rows=events_st, k=st.integers(0, 3))
def test_visitor_matrices_match_pandas(spark, rows, k):
    df = spark.createDataFrame(rows, "timestamp long, visitorid long, event string, "
                                     "itemid long, transactionid long")
    pdf = pd.DataFrame(rows, columns=["timestamp", "visitorid", "event", "itemid", "transactionid"])
    counts = pdf.groupby("visitorid").size()
    keep = set(counts[counts > k].index)
    w = {"view": 1.0, "addtocart": 2.0, "transaction": 3.0}
    full = pdf[pdf.visitorid.isin(keep)].astype(object).where(pd.notnull(pdf), None)
    full_rows = {tuple(r) for r in full.itertuples(index=False)}
    m2_expect = sorted((v, i, w[e]) for (_, v, e, i, _) in full_rows)
    m3_expect = sorted(set(m2_expect))
    m2 = sorted(tuple(r) for r in ops.visitor_matrix(df, k, distinct_triples=False).collect())
    m3 = sorted(tuple(r) for r in ops.visitor_matrix(df, k, distinct_triples=True).collect())
    assert m2 == m2_expect
    assert m3 == m3_expect


props_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3),
                              st.sampled_from(["a", "b", "c"])), min_size=1, max_size=30)


@SETTINGS
@given(rows=props_st)
def test_latest_per_key_keeps_ties(spark, rows):
    df = spark.createDataFrame([(t, i, "categoryid", v) for t, i, v in rows],
                               "timestamp long, itemid int, property string, value string")
    pdf = pd.DataFrame(rows, columns=["timestamp", "itemid", "value"])
    mx = pdf.groupby("itemid").timestamp.transform("max")
    expect = sorted((t, i, "categoryid", v) for t, i, v in pdf[pdf.timestamp == mx].itertuples(index=False))
    for method in ("join", "window"):
        got = sorted(tuple(r) for r in ops.latest_per_key(df, method=method).collect())
        assert got == expect


lists_st = st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=8, unique=True),
                              st.lists(st.integers(0, 9), max_size=6, unique=True)),
                    min_size=1, max_size=10)


@SETTINGS
@given(data=lists_st, k=st.integers(1, 6))
def test_ranking_metrics_equal_spark_rankingevaluator(spark, data, k):
    from pyspark.ml.evaluation import RankingEvaluator
    top, rel = [], []
    for u, (pred, labels) in enumerate(data):
        labels_set = set(labels)
        top += [(u, r + 1, int(p in labels_set)) for r, p in enumerate(pred)]
        rel.append((u, len(labels_set)))
    ours = ranking_metrics(spark.createDataFrame(top, "user int, rank int, hit int"),
                           spark.createDataFrame(rel, "user int, n_rel int"), k).first()
    lists = spark.createDataFrame([([float(p) for p in pred], [float(x) for x in labels])
                                   for pred, labels in data],
                                  "prediction array<double>, label array<double>")
    def spark_metric(name):
        return RankingEvaluator(metricName=name, k=k).evaluate(lists)
    assert abs(ours["map"] - spark_metric("meanAveragePrecision")) < 1e-9
    assert abs(ours["map_at_k"] - spark_metric("meanAveragePrecisionAtK")) < 1e-9
    assert abs(ours["precision_at_k"] - spark_metric("precisionAtK")) < 1e-9
    assert abs(ours["recall_at_k"] - spark_metric("recallAtK")) < 1e-9
    assert abs(ours["ndcg_at_k"] - spark_metric("ndcgAtK")) < 1e-9
