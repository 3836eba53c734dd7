"""Ranking metrics of top-N lists against relevant-item sets, as DataFrame jobs.

Per user of ``relevant_counts`` (then averaged over them; a user without a list, or without
relevant items, scores 0):
  precision@k = hits in the first k / k
  recall@k    = hits in the first k / n_relevant
  AP          = sum over hit ranks r of (hits up to r) / r, divided by n_relevant
  AP@k        = the same over the first k, divided by min(n_relevant, k)
  NDCG@k      = sum over hit ranks r <= k of 1/ln(r+1), over the ideal sum up to min(n_relevant, k)
These are the definitions of Spark's RankingMetrics / RankingEvaluator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranking_metrics(topn: DataFrame, relevant_counts: DataFrame, k: int = 10,
                    user: str = "user", hit: str = "hit") -> DataFrame:
    """``topn``: (user, rank, hit 0/1); ``relevant_counts``: (user, n_rel), the users to judge.

    Lists have at most N rows per user, so the per-user window is bounded.
    """
    w = Window.partitionBy(user).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    r = F.col("rank")
    t = topn.withColumn("cum", F.sum(hit).over(w))
    in_k = r <= k
    sums = t.groupBy(user).agg(
        F.sum(F.when(in_k, F.col(hit)).otherwise(0)).alias("hits_k"),
        F.sum(F.col(hit) * F.col("cum") / r).alias("ap_sum"),
        F.sum(F.when(in_k, F.col(hit) * F.col("cum") / r).otherwise(0.0)).alias("apk_sum"),
        F.sum(F.when(in_k, F.col(hit) / F.log(r + 1)).otherwise(0.0)).alias("dcg"))
    per_user = (relevant_counts.select(user, "n_rel").join(sums, user, "left")
                .fillna(0, subset=["n_rel", "hits_k", "ap_sum", "apk_sum", "dcg"]))
    n_rel = F.col("n_rel")
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(n_rel, F.lit(k))), F.lit(0.0),
                        lambda s, i: s + F.lit(1.0) / F.log(i + 1))
    has = n_rel > 0
    scored = per_user.select(
        (F.col("hits_k") / F.lit(k)).alias("p"),
        F.when(has, F.col("hits_k") / n_rel).otherwise(0.0).alias("rec"),
        F.when(has, F.col("ap_sum") / n_rel).otherwise(0.0).alias("ap"),
        F.when(has, F.col("apk_sum") / F.least(n_rel, F.lit(k))).otherwise(0.0).alias("apk"),
        F.when(has, F.col("dcg") / ideal).otherwise(0.0).alias("ndcg"))
    return scored.agg(F.count(F.lit(1)).alias("users"), F.avg("ap").alias("map"),
                      F.avg("apk").alias("map_at_k"), F.avg("p").alias("precision_at_k"),
                      F.avg("rec").alias("recall_at_k"), F.avg("ndcg").alias("ndcg_at_k"))
