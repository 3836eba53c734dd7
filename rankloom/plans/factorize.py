"""Matrix factorisation with Spark MLlib's ALS (DataFrame API).

The reference's RDD calls map onto the estimator with every default made explicit:
``ALS.trainImplicit(r, rank, iters, alpha=0.01)`` and ``ALS.train(r, rank, iters, 0.01)``
use regParam 0.01 (the RDD API's default), alpha 0.01 — not the estimator's 0.1 / 1.0.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .recommend import top_n


# User and item blocks.  MLlib seeds the factors per block, so the block count is part of the
# model: it is a parameter with a fixed default (the estimator's own) and depends neither on
# cores nor on partitions nor on the number of ratings.  For large inputs raise it so that a
# block's ratings and factors fit a task; comparisons between runs need the same count.
DEFAULT_BLOCKS = 10


def make_als(implicit: bool, rank: int = 10, max_iter: int = 10, reg_param: float = 0.01,
             alpha: float = 0.01, seed: int = 42, cold_start: str = "drop",
             nonnegative: bool = False, blocks: int = DEFAULT_BLOCKS,
             checkpoint_interval: int = 3) -> ALS:
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, alpha=alpha,
              implicitPrefs=implicit, userCol="user", itemCol="product", ratingCol="rating",
              coldStartStrategy=cold_start, seed=seed,
              nonnegative=nonnegative, checkpointInterval=checkpoint_interval,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return als


def fit(ratings: DataFrame, implicit: bool, **kw) -> ALSModel:
    """Fit on (user INT, product INT, rating DOUBLE).

    The factor iterations cut their lineage into the session's shared checkpoint
    folder every ``checkpoint_interval`` iterations (survives executor loss; long
    lineages do not grow).  MLlib deletes the shuffle files of the iterations before a cut,
    so three iterations' are on disk at a time and not all of the fit's.  A cut writes the item
    factors only.
    """
    checkpoint_root(ratings.sparkSession)
    return make_als(implicit, **kw).fit(ratings)


def factors(model: ALSModel) -> DataFrame:
    """(side, id, dim, features) for users and products — a table, never collected."""
    def side(df, name):
        return df.select(F.lit(name).alias("side"), "id", F.size("features").alias("dim"),
                         "features")
    return side(model.userFactors, "user").unionByName(side(model.itemFactors, "product"))


def recommend(model: ALSModel, n: int = 10, for_users: bool = True) -> DataFrame:
    """(id, rank, other id, score): the n best for every id of one side, by ``top_n`` over the
    model's factors.  MLlib's own ``recommendForAll`` scores and ranks one id after the other
    and sends n rows per id and block of 4,096 through an aggregate.  Scores are floats, as
    MLlib's."""
    if for_users:
        recs = top_n(model.userFactors, model.itemFactors, n, "user", "product", unique=True)
    else:
        recs = top_n(model.itemFactors, model.userFactors, n, "product", "user", unique=True)
    return recs.withColumn("score", F.col("score").cast("float").cast("double"))


def recommend_for(model: ALSModel, users: DataFrame, n: int = 10) -> DataFrame:
    """Top-N products of the given users only (a ``user`` column)."""
    recs = model.recommendForUserSubset(users, n)
    return (recs.select("user", F.posexplode("recommendations").alias("pos", "rec"))
                .select("user", (F.col("pos") + 1).alias("rank"), F.col("rec.product").alias("product"),
                        F.col("rec.rating").cast("double").alias("score")))


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Score pairs; unknown ids follow the model's cold-start strategy."""
    return model.transform(pairs)
