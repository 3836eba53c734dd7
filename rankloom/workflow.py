"""End-to-end jobs over the reference's raw inputs (CSV event log + item-property parts).

``build_matrices`` writes the four rating matrices; ``train_and_recommend`` fits ALS on
one matrix and writes factors, top-N lists both ways and hold-out metrics.  Every output
is a table directory (parquet), written part-file per task — nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import operators as ops
from .plans import metrics as M
from .plans.factorize import factors, fit, predict, recommend
from .plans.pruned import pruned_top_n
from .sources.ratings_io import (EVENTS_SCHEMA, ITEM_PROPS_SCHEMA, load_rating_matrix,
                                 read_events_csv, write_rating_matrix)

MATRIX_ITEM_COL = {1: "categoryid", 2: "itemid", 3: "itemid", 4: "itemid"}


def matrices(events: DataFrame, props_parts: list[DataFrame],
             on_unknown: str = "error") -> dict[int, DataFrame]:
    """The four matrices; ``on_unknown`` is the policy for event labels without a weight."""
    known = ops.weight_events(events, on_unknown="drop").drop("rating") if on_unknown == "drop" else events
    return {1: ops.category_matrix(known, props_parts, on_unknown),
            2: ops.visitor_matrix(known, 1, distinct_triples=False, on_unknown=on_unknown),
            3: ops.visitor_matrix(known, 1, distinct_triples=True, on_unknown=on_unknown),
            4: ops.visitor_matrix(known, 2, distinct_triples=True, on_unknown=on_unknown)}


def build_matrices(spark: SparkSession, events_csv: str, props_csvs: list[str], out: str,
                   models=(1, 2, 3, 4), fmt: str = "parquet", on_unknown: str = "error") -> dict[int, str]:
    events = read_events_csv(spark, events_csv, EVENTS_SCHEMA)
    parts = [read_events_csv(spark, p, ITEM_PROPS_SCHEMA) for p in props_csvs]
    built = matrices(events, parts, on_unknown)
    paths = {}
    for m in models:
        paths[m] = write_rating_matrix(built[m], f"{out.rstrip('/')}/model{m}", fmt)
    return paths


def train_and_recommend(spark: SparkSession, matrix_path: str, model: int, out: str,
                        implicit: bool | None = None, rank: int = 10, max_iter: int = 10,
                        reg_param: float = 0.01, alpha: float = 0.01, n: int = 10,
                        seed: int = 42, fmt: str = "parquet", collapse: str = "none",
                        ids: str = "int", id_type: str = "long", models: str | None = None,
                        unseen: bool = False) -> dict[str, str]:
    """Model 1 defaults to implicit ALS, models 2-4 to explicit, as in the reference.

    ``ids='dictionary'``: ids of any type (``id_type``) or size go through id dictionaries,
    which are written to ``out``/ids, and every output has the raw ids again.  ``models``: a
    folder of fitted models; the same data and parameters are fitted once.  ``unseen``: the
    product lists leave a user's training items out."""
    from .plans.store import ModelStore
    if ids not in ("int", "dictionary"):
        raise ValueError(f"unknown ids {ids}")
    implicit = (model == 1) if implicit is None else implicit
    item, o = MATRIX_ITEM_COL[model], out.rstrip("/")
    m = load_rating_matrix(spark, matrix_path, fmt, item_col=item, id_type=T.StringType() if id_type == "string" else T.LongType())
    maps = None
    if ids == "dictionary":
        maps = ops.RatingIds.of(m, "visitorid", item)
        maps.save(f"{o}/ids")
        maps = ops.RatingIds.load(spark, f"{o}/ids")
        m = maps.ratings(m, "visitorid", item)
        ratings = ops.materialize(ops.to_ratings(m, "user", "product", "rating", collapse))
    else:
        ratings = ops.materialize(ops.to_ratings(m, "visitorid", item, "rating", collapse))
    s = ops.hash_split(ratings, ["user", "product"])
    train = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split")
    how = {"implicit": implicit, "rank": rank, "max_iter": max_iter, "reg_param": reg_param, "alpha": alpha, "seed": seed}
    als = ModelStore(spark, models).fit_once(train, **how) if models else fit(train, **how)
    lists = (pruned_top_n(als.userFactors, als.itemFactors, n, exclude=train.select("user", "product")).lists
             if unseen else recommend(als, n, True))
    outputs = {"factors": factors(als), "top_products": lists,
               "top_users": recommend(als, n, False),
               "holdout_metrics": M.regression_metrics(M.weighted_score_and_labels(
                   test, predict(als, test.select("user", "product"))), weight="weight")}
    paths = {}
    if maps is not None:
        outputs = {k: maps.decode_factors(df) if k == "factors" else maps.decode(df) for k, df in outputs.items()}
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{o}/{name}")
        paths[name] = f"{o}/{name}"
    return paths


def tune_model(spark: SparkSession, matrix_path: str, model: int, out: str,
               method: str = "cv", implicit: bool = True, fmt: str = "parquet",
               collapse: str = "none") -> dict[str, str]:
    """The reference's tuning for one matrix: 80/20 hash split, 3-fold CV (or one
    train/validation split) over the 8-setting grid, best model's hold-out RMSE."""
    from .plans.tune import tune
    item = MATRIX_ITEM_COL[model]
    m = load_rating_matrix(spark, matrix_path, fmt, item_col=item)
    ratings = ops.materialize(ops.to_ratings(m, "visitorid", item, "rating", collapse))
    s = ops.hash_split(ratings, ["user", "product"])
    train = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split")
    best, summary = tune(train, test, implicit=implicit, method=method)
    o = out.rstrip("/")
    summary.select(F.lit(model).alias("model"), *summary.columns) \
        .write.mode("overwrite").parquet(f"{o}/tuning")
    factors(best).write.mode("overwrite").parquet(f"{o}/best_factors")
    return {"tuning": f"{o}/tuning", "best_factors": f"{o}/best_factors"}
