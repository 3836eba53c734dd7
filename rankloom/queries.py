"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the driver's tables (through ``rankloom.sources``) and composes library
operators; numeric outputs that are compared against the DuckDB oracle are rounded
to 6 digits here, never inside the library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import operators as ops
from . import sources as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# ---- shared inputs -----------------------------------------------------------------

def _model1(spark, sf):
    """Events with a label that has no weight (error, signup) are no feedback: dropped."""
    return ops.category_matrix(src.click_log(spark, sf), list(src.item_props_parts(spark, sf)), on_unknown="drop")


@query
def model1_matrix(spark, sf):
    return _model1(spark, sf)


def _click(spark, sf):
    return src.click_log(spark, sf)


def _basket(spark, sf):
    return src.basket_log(spark, sf)


def _model3(spark, sf):
    return ops.visitor_matrix(_basket(spark, sf), 1, distinct_triples=True)


# ---- 2.1 scans, sources, sinks -----------------------------------------------------

@query
def scan_events(spark, sf):
    return _click(spark, sf)


@query
def clean_events(spark, sf):
    return ops.clean_events(_click(spark, sf))


@query
def preview_events(spark, sf):
    """The reference's ``show(5)``, made stable by a total order."""
    ev = _click(spark, sf)
    return ev.orderBy("timestamp", "visitorid", "itemid", "event",
                      F.col("transactionid").asc_nulls_first()).limit(5)


def _through_scratch(spark, write, read):
    """What ``read`` gives of the files that ``write`` made; the files go when it is done."""
    from .session import remove_path, scratch_path
    path = scratch_path(spark, "round-trip")
    write(path)
    out = ops.materialize(read(path))
    remove_path(spark, path)
    return out


@query
def load_rating_matrix(spark, sf):
    """Model-3 matrix written as CSV part files (header in each) and read back typed,
    dropping every header-equal line as the reference's text load does."""
    return _through_scratch(
        spark, lambda path: src.write_rating_matrix(_model3(spark, sf), path, "csv"),
        lambda path: src.load_rating_matrix(spark, path, "csv", header_lines="every"))


@query
def write_read_roundtrip(spark, sf):
    return _through_scratch(
        spark, lambda path: src.write_rating_matrix(_model3(spark, sf), path, "parquet"),
        lambda path: src.load_rating_matrix(spark, path, "parquet"))


@query
def scan_events_csv(spark, sf):
    """The click log as the reference finds it: CSV files with a header, typed on reading."""
    def write(path):
        _click(spark, sf).write.option("header", True).csv(path)
    return _through_scratch(spark, write, lambda path: src.read_events_csv(spark, path))


@query
def scan_item_props_csv(spark, sf):
    def write(path):
        union_item_props(spark, sf).write.option("header", True).csv(path)
    return _through_scratch(spark, write, lambda path: src.read_events_csv(spark, path, src.ITEM_PROPS_SCHEMA))


# ---- item properties and latest category --------------------------------------------

@query
def union_item_props(spark, sf):
    return ops.union_parts(*src.item_props_parts(spark, sf))


@query
def filter_category_props(spark, sf):
    return ops.filter_property(union_item_props(spark, sf), "categoryid")


@query
def latest_ts_per_item(spark, sf):
    return ops.latest_ts_per_key(filter_category_props(spark, sf), "itemid", "timestamp")


@query
def latest_category_join(spark, sf):
    return ops.latest_per_key(filter_category_props(spark, sf), "itemid", "timestamp", "join")


@query
def latest_category_window(spark, sf):
    return ops.latest_per_key(filter_category_props(spark, sf), "itemid", "timestamp", "window")


@query
def latest_category_ties(spark, sf):
    """Timestamps cut to the year: several categories tie at an item's latest time."""
    cats = ops.filter_property(ops.union_parts(*src.item_props_parts(spark, sf, "year")))
    return ops.latest_per_key(cats, "itemid", "timestamp", "join")


@query
def latest_category_onepass(spark, sf):
    return ops.latest_per_key(filter_category_props(spark, sf), "itemid", "timestamp", "onepass")


@query
def latest_category_onepass_ties(spark, sf):
    cats = ops.filter_property(ops.union_parts(*src.item_props_parts(spark, sf, "year")))
    return ops.latest_per_key(cats, "itemid", "timestamp", "onepass")


@query
def events_with_category(spark, sf):
    return ops.events_with_category(ops.clean_events(_click(spark, sf)),
                                    latest_category_join(spark, sf))


# ---- visitor activity (basket log) ---------------------------------------------------

@query
def events_per_visitor(spark, sf):
    return ops.events_per_visitor(_basket(spark, sf))


@query
def active_visitors_gt1(spark, sf):
    return ops.active_visitors(_basket(spark, sf), 1)


@query
def active_visitors_gt2(spark, sf):
    return ops.active_visitors(_basket(spark, sf), 2)


@query
def events_of_active_gt1(spark, sf):
    return ops.events_of_active(_basket(spark, sf), 1, method="join")


@query
def events_of_active_gt2(spark, sf):
    return ops.events_of_active(_basket(spark, sf), 2, method="join")


@query
def events_of_active_window(spark, sf):
    return ops.events_of_active(_basket(spark, sf), 1, method="window")


@query
def events_of_active_semi(spark, sf):
    return ops.events_of_active(_basket(spark, sf), 1, method="semi")


@query
def distinct_events_gt1(spark, sf):
    return events_of_active_gt1(spark, sf).distinct()


@query
def distinct_events_gt2(spark, sf):
    return events_of_active_gt2(spark, sf).distinct()


@query
def weight_events(spark, sf):
    return ops.weight_events(_basket(spark, sf))


@query
def recode_events_keep(spark, sf):
    """The click log's labels recoded in place, unknown ones (error, signup) kept."""
    return ops.recode_events(_click(spark, sf))


@query
def weight_events_drop(spark, sf):
    """The click log's weights, events with an unknown label dropped."""
    return ops.weight_events(_click(spark, sf), on_unknown="drop")


@query
def project_triple(spark, sf):
    return ops.project_triple(ops.weight_events(_basket(spark, sf)))


@query
def model2_matrix(spark, sf):
    return ops.visitor_matrix(_basket(spark, sf), 1, distinct_triples=False)


@query
def model3_matrix(spark, sf):
    return _model3(spark, sf)


@query
def model4_matrix(spark, sf):
    return ops.visitor_matrix(_basket(spark, sf), 2, distinct_triples=True)


# ---- matrix profile (model 3) ---------------------------------------------------------

@query
def distinct_users(spark, sf):
    return ops.distinct_ids(_model3(spark, sf), "visitorid")


@query
def distinct_products(spark, sf):
    return ops.distinct_ids(_model3(spark, sf), "itemid")


@query
def ratings_per_user(spark, sf):
    return ops.ratings_per_user(_model3(spark, sf))


@query
def ratings_per_user_stats(spark, sf):
    return round_doubles(ops.ratings_per_user_stats(_model3(spark, sf)))


@query
def user_rating_crosstab(spark, sf):
    return ops.user_rating_crosstab(_model3(spark, sf))


@query
def contingency_wide(spark, sf):
    """Items by event label, the labels found in the data; counts in the order of the labels."""
    table = ops.contingency(_click(spark, sf), "itemid", "event")
    return table.table.select("itemid", F.array_join(F.transform("counts", lambda n: n.cast("string")), ",").alias("counts"))


@query
def contingency_levels(spark, sf):
    return ops.contingency(_click(spark, sf), "itemid", "event").levels


@query
def contingency_long(spark, sf):
    """Items by visitor: too many levels for a row each, so the pairs that occur."""
    table = ops.contingency(_basket(spark, sf), "itemid", "visitorid", max_levels=100)
    assert not table.wide
    return table.table


def _string_ids(matrix, item="itemid"):
    """A matrix whose ids are strings, as of a shop that has no INT ids."""
    return matrix.select(F.concat(F.lit("visitor-"), F.col("visitorid").cast("string")).alias("visitorid"),
                         F.concat(F.lit("sku-"), F.col(item).cast("string")).alias("itemid"), "rating")


@query
def id_round_trip(spark, sf):
    """String ids through the dictionaries and back; the dictionaries of the first half of the
    matrix are extended by the second."""
    m = _string_ids(_model3(spark, sf))
    half = F.pmod(F.xxhash64("visitorid"), F.lit(2)) == 0
    ids = ops.RatingIds.of(m.filter(half)).extend(m.filter(~half))
    return ids.decode(ids.ratings(m))


@query
def id_dictionary(spark, sf):
    """One row a side: ids are dense and each is given once."""
    ids = ops.RatingIds.of(_string_ids(_model3(spark, sf)))

    def side(name, found):
        return found.table.agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("n"), F.min("id").alias("lowest"),
                               F.max("id").alias("highest"), F.countDistinct("id").alias("n_ids"), F.countDistinct("raw").alias("n_keys"))
    return side("user", ids.users).unionByName(side("product", ids.products))


@query
def matrix_profile(spark, sf):
    return round_doubles(ops.matrix_profile(_model3(spark, sf)))


def _model2(spark, sf):
    return ops.visitor_matrix(_basket(spark, sf), 1, distinct_triples=False)


def _model4(spark, sf):
    return ops.visitor_matrix(_basket(spark, sf), 2, distinct_triples=True)


def _register_profiles(model, matrix, item):
    """Exploration of the other three matrices, as of model 3 above."""
    for name, fn in {
        "distinct_users": lambda m: ops.distinct_ids(m, "visitorid"),
        "distinct_products": lambda m: ops.distinct_ids(m, item),
        "ratings_per_user_stats": lambda m: round_doubles(ops.ratings_per_user_stats(m)),
        "user_rating_crosstab": lambda m: ops.user_rating_crosstab(m),
        "matrix_profile": lambda m: round_doubles(ops.matrix_profile(m, item=item)),
    }.items():
        QUERIES[f"{name}_m{model}"] = lambda spark, sf, fn=fn: fn(matrix(spark, sf))


_register_profiles(1, _model1, "categoryid")
_register_profiles(2, _model2, "itemid")
_register_profiles(4, _model4, "itemid")


# ---- model 3's matrix stored in buckets of its users; sketches of the basket log -----------

def _bucketed3(spark, sf):
    return src.BucketedMatrix.write(_model3(spark, sf)).rows()


@query
def bucketed_ratings_per_user(spark, sf):
    return ops.ratings_per_user(_bucketed3(spark, sf))


@query
def bucketed_user_stats(spark, sf):
    return round_doubles(ops.ratings_per_user_stats(_bucketed3(spark, sf)))


@query
def bucketed_crosstab(spark, sf):
    return ops.user_rating_crosstab(_bucketed3(spark, sf))


@query
def bucketed_score_and_labels(spark, sf):
    """``score_and_labels`` of two tables stored by user: neither is shuffled for the join."""
    from .plans import metrics as M
    train, test = _holdout(spark, sf)
    preds = M.mean_user_predictor(train, test.select("user", "product"))
    labels = src.BucketedMatrix.write(test, "user")
    scored = src.BucketedMatrix.write(preds, "user", buckets=labels.buckets)
    return round_doubles(src.joined_in_place(labels.rows(), scored.rows(), ["user", "product"])
                         .select("user", "product", "rating", "prediction"))


@query
def sketched_distincts(spark, sf):
    """Rows, visitors and items of each year of the basket log and of all years, from sketches
    added in three loads (one of them again); beside the exact counts, whether the merged
    estimates lie within four standard errors."""
    log = _basket(spark, sf).select(F.col("timestamp").cast("string").alias("year"), "visitorid", "itemid")
    ids = ["visitorid", "itemid"]
    store = ops.SketchStore.open(spark, ids)
    early = log.filter(F.col("year") < "1995")
    for load in (early, log.filter(F.col("year") >= "1995"), early.filter(F.col("year") == "1994")):
        store.add(load, "year")
    told = (store.estimates(["part"]).select("part", "n_rows", "n_visitorid", "n_itemid")
            .unionByName(store.estimates().select(F.lit("all").alias("part"), "n_rows", "n_visitorid", "n_itemid")))
    parts = log.withColumn("part", F.explode(F.array("year", F.lit("all"))))
    exact = parts.groupBy("part").agg(F.count_distinct("visitorid").alias("visitors"), F.count_distinct("itemid").alias("items"))
    bound = 4 * ops.relative_error()

    def close(estimate, n):
        return F.abs(F.col(estimate) - F.col(n)) <= F.greatest(F.col(n) * bound, F.lit(1.0))
    return told.join(exact, "part").select(
        "part", "n_rows", "visitors", "items", close("n_visitorid", "visitors").alias("visitors_close"),
        close("n_itemid", "items").alias("items_close"))


@query
def stage_counts(spark, sf):
    """Row count after each stage of the model-1 chain (the reference's audit trail).

    Each log is scanned once: the property log for its four counts and the latest-category
    rows (tagged, grouped, stored), the click log for the last three counts; the latest rows
    are one dimension, computed and measured once.
    """
    p1, p2 = src.item_props_parts(spark, sf)
    tagged = ops.materialize(
        p1.withColumn("_part", F.lit(1)).unionByName(p2.withColumn("_part", F.lit(2)))
        .groupBy("_part", "property", F.when(F.col("property") == "categoryid",
                                             F.struct("timestamp", "itemid", "value")).alias("row"))
        .agg(F.count(F.lit(1)).alias("n")))  # one row per part and label, and the category rows
    props_counts = tagged.agg(
        F.sum(F.when(F.col("_part") == 1, F.col("n")).otherwise(0)).alias("p1"),
        F.sum(F.when(F.col("_part") == 2, F.col("n")).otherwise(0)).alias("p2"), F.sum("n").alias("props"),
        F.sum(F.when(F.col("property") == "categoryid", F.col("n")).otherwise(0)).alias("cats")).select(
        F.expr("stack(4, 'item_props_part1', p1, 'item_props_part2', p2, "
               "'item_props', props, 'category_rows', cats) AS (stage, n)"))
    cats = (tagged.filter(F.col("property") == "categoryid")
            .select("row.timestamp", "row.itemid", "property", "row.value",
                    F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_k")).drop("_k"))
    latest = ops.Dimension.of(ops.latest_per_key(cats))
    latest_counts = latest.df.agg(F.count_distinct("itemid").alias("items"), F.count(F.lit(1)).alias("rows")).select(
        F.expr("stack(2, 'latest_items', items, 'latest_rows', rows) AS (stage, n)"))
    # Per distinct (visitor, item, event) of the click log: how many events, how many joined.
    dim = latest.select("itemid", F.col("value").cast("int").alias("categoryid"))
    events = (_click(spark, sf).groupBy("visitorid", "itemid", "event").agg(F.count(F.lit(1)).alias("n")))
    joined = ops.materialize(ops.join_dimension(ops.weight_events(events, on_unknown="null"), dim, "itemid", "left")
                             .select("visitorid", "itemid", "event", "n", "rating", "categoryid",
                                     F.col("categoryid").isNotNull().alias("known")))
    once = joined.groupBy("visitorid", "itemid", "event").agg(
        F.first("n").alias("n"), F.sum(F.col("known").cast("long")).alias("k"))
    click_counts = once.agg(F.sum("n").alias("events"), F.sum(F.col("n") * F.col("k")).alias("joined")).select(
        F.expr("stack(2, 'events', events, 'events_with_category', joined) AS (stage, n)"))
    matrix = (joined.filter("known and rating is not null").select("visitorid", "categoryid", "rating").distinct()
              .agg(F.count(F.lit(1)).alias("n")).select(F.lit("model1_matrix").alias("stage"), "n"))
    out = props_counts
    for part in (latest_counts, click_counts, matrix):
        out = out.unionByName(part)
    return out


@query
def stage_counts_observed(spark, sf):
    """``stage_counts`` as by-products of one run of the model-1 chain."""
    _, n = ops.audited_category_matrix(_click(spark, sf), list(src.item_props_parts(spark, sf)), on_unknown="drop")
    return spark.createDataFrame(list(n.items()), "stage string, n bigint")


@query
def collapse_pairs(spark, sf):
    """Click-log weights per (visitor, item), duplicates collapsed four ways."""
    ev = ops.weight_events(_click(spark, sf), on_unknown="drop")
    return round_doubles(ops.collapse_pairs(ev, "visitorid", "itemid", "rating"))


# ---- ratings, pairs, splits ------------------------------------------------------------

@query
def shift_ratings(spark, sf):
    m = _model1(spark, sf)
    return m.select("visitorid", "categoryid", (F.col("rating") - F.lit(1.5)).alias("rating"))


@query
def split_hash(spark, sf):
    return ops.hash_split(_click(spark, sf), ["visitorid", "itemid", "event"])


@query
def split_rows(spark, sf):
    """Row by row: copies of a row can be on both sides."""
    return ops.row_split(_click(spark, sf))


@query
def split_random(spark, sf):
    """The reference's 80/20 ``randomSplit``, seeded; labelled rows of both sides.
    Reproducible for a fixed input partitioning only, so no SQL oracle (rows-only);
    ``split_hash`` is the engine-independent split."""
    train, test = ops.random_split(_click(spark, sf), (0.8, 0.2), seed=42)
    return (train.withColumn("split", F.lit("train"))
                 .unionByName(test.withColumn("split", F.lit("test"))))


@query
def test_pairs(spark, sf):
    """(user, product) pairs of the test side of model 1's matrix; repeats kept."""
    m = ops.hash_split(_model1(spark, sf), ["visitorid", "categoryid"])
    return m.filter(F.col("split") == "test").select("visitorid", "categoryid")


# ---- scoring and regression metrics on a hold-out (fixed baseline predictor) -------------

def _click_ratings(spark, sf):
    """Distinct (user, product, rating) triples of the click log."""
    ev = ops.weight_events(_click(spark, sf), on_unknown="drop")
    return ops.to_ratings(ev.select("visitorid", "itemid", "rating").distinct())


def _holdout(spark, sf):
    s = ops.hash_split(_click_ratings(spark, sf), ["user", "product"])
    train = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split")
    return train, test


def _baseline_sl(spark, sf, dedupe=False):
    from .plans import metrics as M
    train, test = _holdout(spark, sf)
    preds = M.mean_user_predictor(train, test.select("user", "product"))
    return M.score_and_labels(test, preds, dedupe_pairs=dedupe)


@query
def score_and_labels(spark, sf):
    return round_doubles(_baseline_sl(spark, sf))


@query
def score_and_labels_dedup(spark, sf):
    return round_doubles(_baseline_sl(spark, sf, dedupe=True))


@query
def squared_errors(spark, sf):
    from .plans import metrics as M
    return round_doubles(M.squared_errors(_baseline_sl(spark, sf)))


@query
def mse_holdout(spark, sf):
    from .plans import metrics as M
    return round_doubles(M.mse(_baseline_sl(spark, sf)))


@query
def rmse_holdout(spark, sf):
    from .plans import metrics as M
    return round_doubles(M.rmse(_baseline_sl(spark, sf)))


@query
def regression_metrics(spark, sf):
    from .plans import metrics as M
    return round_doubles(M.regression_metrics(_baseline_sl(spark, sf)))


@query
def regression_metrics_all_ratings(spark, sf):
    """The reference's own join: predictions of the held-out pairs against ALL ratings of
    those pairs, held out or not (the split is by row here, so pairs are on both sides)."""
    from .plans import metrics as M
    ratings = _click_ratings(spark, sf)
    s = ops.hash_split(ratings, ["user", "product", "rating"])
    train, test = (s.filter(F.col("split") == side).drop("split") for side in ("train", "test"))
    preds = M.mean_user_predictor(train, test.select("user", "product"))
    return round_doubles(M.regression_metrics(M.weighted_score_and_labels(ratings, preds), weight="weight"))


@query
def regression_metrics_weighted(spark, sf):
    """``regression_metrics`` without the join's fan-out; same numbers."""
    from .plans import metrics as M
    train, test = _holdout(spark, sf)
    preds = M.mean_user_predictor(train, test.select("user", "product"))
    return round_doubles(M.regression_metrics(M.weighted_score_and_labels(test, preds), weight="weight"))


# ---- factor tables: scoring, top-N both ways, ranking metrics -----------------------------

@query
def predict_pairs_from_factors(spark, sf):
    from .plans.recommend import predict_pairs
    pairs = _click_ratings(spark, sf).select("user", "product")
    return round_doubles(predict_pairs(pairs, src.user_factors(spark, sf),
                                       src.product_factors(spark, sf)))


@query
def predict_pairs_marked(spark, sf):
    """One row per input pair; a pair with an unknown id has no prediction and is marked."""
    from .plans.recommend import predict_pairs
    pairs = _click_ratings(spark, sf).select("user", "product")
    return round_doubles(predict_pairs(pairs, src.user_factors(spark, sf), src.product_factors(spark, sf),
                                       cold_start="mark"))


@query
def factor_dims(spark, sf):
    def dims(df, side):
        return df.select(F.lit(side).alias("side"), "id", F.size("features").alias("dim"),
                         F.col("features")[0].alias("f0"))
    return round_doubles(dims(src.user_factors(spark, sf), "user")
                         .unionByName(dims(src.product_factors(spark, sf), "product")))


@query
def topn_products_per_user(spark, sf):
    from .plans.recommend import top_n
    return round_doubles(top_n(src.user_factors(spark, sf), src.product_factors(spark, sf),
                               10, "user", "product"))


@query
def topn_users_per_product(spark, sf):
    from .plans.recommend import top_n
    return round_doubles(top_n(src.product_factors(spark, sf), src.user_factors(spark, sf),
                               10, "product", "user"))


@query
def topn_products_pruned(spark, sf):
    """The same lists, blocks that no query can need left out."""
    from .plans.pruned import pruned_top_n
    return round_doubles(pruned_top_n(src.user_factors(spark, sf), src.product_factors(spark, sf), 10, "user", "product",
                                      cand_block_rows=1_000).lists)


@query
def topn_users_pruned(spark, sf):
    from .plans.pruned import pruned_top_n
    return round_doubles(pruned_top_n(src.product_factors(spark, sf), src.user_factors(spark, sf), 10, "product", "user",
                                      cand_block_rows=1_000).lists)


def _unseen(spark, sf, n=10):
    """Top-N lists without the products a user has in training, and the held-out pairs."""
    from .plans.pruned import pruned_top_n
    train, test = _holdout(spark, sf)
    lists = pruned_top_n(src.user_factors(spark, sf), src.product_factors(spark, sf), n, "user", "product",
                         exclude=train.select("user", "product")).lists
    return lists, test.select("user", "product").distinct()


@query
def topn_products_unseen(spark, sf):
    return round_doubles(_unseen(spark, sf)[0])


@query
def ranking_metrics_unseen(spark, sf):
    """Ranking metrics of lists that leave training items out, so that they cannot take the
    places of held-out ones; judged on every user with held-out products."""
    from .plans.ranking import ranking_metrics as rank_metrics
    lists, held = _unseen(spark, sf)
    hits = (lists.join(held.withColumn("hit", F.lit(1)), ["user", "product"], "left")
            .select("user", "rank", F.coalesce("hit", F.lit(0)).alias("hit")))
    return round_doubles(rank_metrics(hits, held.groupBy("user").agg(F.count(F.lit(1)).alias("n_rel")), 10))


@query
def ranking_metrics(spark, sf):
    """Top-10 products per user; relevant = products sharing the user's label."""
    from .plans.ranking import ranking_metrics as rank_metrics
    from .plans.recommend import top_n
    uf, pf = src.user_factors(spark, sf), src.product_factors(spark, sf)
    top = top_n(uf, pf, 10, "user", "product")
    plab = pf.select(F.col("id").alias("product"), F.col("label").alias("plabel"))
    ulab = uf.select(F.col("id").alias("user"), F.col("label").alias("ulabel"))
    hits = (ops.join_dimension(ops.join_dimension(top, plab, "product"), ulab, "user")
               .select("user", "rank",
                       F.coalesce((F.col("plabel") == F.col("ulabel")).cast("int"),
                                  F.lit(0)).alias("hit")))
    per_label = pf.groupBy("label").agg(F.count(F.lit(1)).alias("n_rel"))
    rel = (ulab.join(per_label, ulab["ulabel"] == per_label["label"], "left")
               .select("user", F.coalesce("n_rel", F.lit(0)).alias("n_rel")))
    return round_doubles(rank_metrics(hits, rel, 10))


# ---- ALS (trained models; checked by property tests, no SQL oracle) -----------------------

def _model1_ratings(spark, sf):
    return ops.to_ratings(_model1(spark, sf), "visitorid", "categoryid", "rating")


def _split_pairs(ratings):
    """Hash split on the pair.  The matrix is stored first, each row with its side: ALS reads
    the train side, scoring reads the test side, and neither recomputes the matrix chain or
    the hashes; the iterations start from a short lineage."""
    return _sides(ops.stored(ops.hash_split(ratings, ["user", "product"])))


def _split_stored(ratings):
    return _sides(ops.hash_split(ratings, ["user", "product"]))


def _sides(s):
    return (s.filter(F.col("split") == "train").drop("split"),
            s.filter(F.col("split") == "test").drop("split"))


def _implicit_model(spark, sf):
    """Model 1's implicit model, fitted once: every query that uses it loads the same one."""
    from .plans.store import ModelStore
    train, test = _split_pairs(_model1_ratings(spark, sf))
    return ModelStore(spark).fit_once(train, implicit=True, rank=10, max_iter=10, alpha=0.01, reg_param=0.01), test


@query
def als_implicit_predict(spark, sf):
    """Model 1: implicit ALS (rank 10, 10 iterations, alpha 0.01) scored on held-out pairs."""
    from .plans.factorize import predict
    model, test = _implicit_model(spark, sf)
    return predict(model, test)


@query
def als_explicit_predict(spark, sf):
    """Model 3: explicit ALS (rank 10, 10 iterations, lambda 0.01) on held-out pairs."""
    from .plans.factorize import fit, predict
    train, test = _split_pairs(ops.to_ratings(_model3(spark, sf)))
    model = fit(train, implicit=False, rank=10, max_iter=10, reg_param=0.01)
    return predict(model, test)


@query
def als_factors(spark, sf):
    from .plans.factorize import factors
    model, _ = _implicit_model(spark, sf)
    return factors(model)


@query
def als_recommend_products(spark, sf):
    from .plans.factorize import recommend
    model, _ = _implicit_model(spark, sf)
    return recommend(model, 10, for_users=True)


@query
def als_recommend_users(spark, sf):
    from .plans.factorize import recommend
    model, _ = _implicit_model(spark, sf)
    return recommend(model, 10, for_users=False)


MODELS = {1: _model1, 2: _model2, 3: _model3, 4: _model4}


def _ratings_of(spark, sf, model):
    return ops.to_ratings(MODELS[model](spark, sf), "visitorid", "categoryid" if model == 1 else "itemid")


def _basket_ratings(spark, sf):
    """(model, ratings) of models 2 to 4, one after the other, from one pass
    over the basket log: the full-row distinct and the visitors' counts are stored; model 3 is
    the distinct of model 2's triples, model 4 its part of visitors with more than two rows.
    What a model's fits left behind goes before the next, and model 2's rows after model 2."""
    basket = _basket(spark, sf)
    active = ops.Dimension.of(ops.active_visitors(basket, 1))
    m2 = ops.stored(ops.join_dimension(ops.weight_events(basket.distinct()), active, "visitorid")
                    .select("visitorid", "itemid", "rating", "count"))
    m3 = ops.stored(m2.distinct())
    yield 2, ops.to_ratings(m2)
    ops.discard(m2)
    yield 3, ops.to_ratings(m3)
    ops.collect_garbage(spark)
    yield 4, ops.to_ratings(m3.filter("count > 2"))
    ops.discard(m3)


def _four_ratings(spark, sf):
    """(model, ratings) of the four matrices, stored, one after the other."""
    m1 = ops.stored(_model1_ratings(spark, sf))
    yield 1, m1
    ops.discard(m1)
    yield from _basket_ratings(spark, sf)


def _explicit_model(spark, sf, model):
    from .plans.factorize import fit
    train, test = _split_pairs(_ratings_of(spark, sf, model))
    return fit(train, implicit=False, rank=10, max_iter=10, reg_param=0.01), test


def _register_explicit(model):
    """Top-N both ways and the factor tables of the explicit models 2 to 4 (rank 10, 10
    iterations, lambda 0.01 on the 80 % split)."""
    from .plans.factorize import factors, recommend
    QUERIES[f"als_recommend_products_m{model}"] = lambda spark, sf: recommend(
        _explicit_model(spark, sf, model)[0], 10, for_users=True)
    QUERIES[f"als_recommend_users_m{model}"] = lambda spark, sf: recommend(
        _explicit_model(spark, sf, model)[0], 10, for_users=False)
    QUERIES[f"als_factors_m{model}"] = lambda spark, sf: factors(_explicit_model(spark, sf, model)[0])


for _m in (2, 3, 4):
    _register_explicit(_m)


@query
def als_recommend_explicit(spark, sf):
    """Top-10 products for every user from the explicit model of the model-3 matrix."""
    return QUERIES["als_recommend_products_m3"](spark, sf)


@query
def als_implicit_rank5(spark, sf):
    """Model 1 with rank 5 and 5 iterations (alpha 0.01), scored on held-out pairs."""
    from .plans.factorize import fit, predict
    train, test = _split_pairs(_model1_ratings(spark, sf))
    return predict(fit(train, implicit=True, rank=5, max_iter=5, alpha=0.01, reg_param=0.01), test)


# The part of a trained model's output that is exact: which rows there are, not their scores.

@query
def als_scored_pairs_m1(spark, sf):
    """Held-out pairs that survive the cold start: user and product both occur in training."""
    return als_implicit_predict(spark, sf).select("user", "product", "rating")


@query
def als_scored_pairs_m3(spark, sf):
    return als_explicit_predict(spark, sf).select("user", "product", "rating")


@query
def als_factor_index(spark, sf):
    """Which factor rows are exported, and their length."""
    return als_factors(spark, sf).select("side", "id", "dim")


@query
def als_listed_products(spark, sf):
    """Which (user, rank) the top-N lists have."""
    return als_recommend_products(spark, sf).select("user", "rank")


@query
def als_listed_users(spark, sf):
    return als_recommend_users(spark, sf).select("product", "rank")


@query
def als_string_ids_listed(spark, sf):
    """String ids through fit and top-N: which (user, rank) the lists have, ids decoded."""
    from .plans.factorize import recommend
    from .plans.store import ModelStore
    m = ops.materialize(_string_ids(_model1(spark, sf), "categoryid"))
    ids = ops.RatingIds.of(m)
    model = ModelStore(spark).fit_once(ops.materialize(ids.ratings(m)), implicit=True, rank=5, max_iter=3, alpha=0.01)
    return ids.decode(recommend(model, 10, for_users=True)).select("user", "rank")


@query
def als_string_ids_predict(spark, sf):
    """The same through prediction: the pairs that get a score."""
    from .plans.factorize import predict
    from .plans.store import ModelStore
    m = ops.materialize(_string_ids(_model1(spark, sf), "categoryid"))
    ids = ops.RatingIds.of(m)
    ratings = ops.materialize(ids.ratings(m))
    model = ModelStore(spark).fit_once(ratings, implicit=True, rank=5, max_iter=3, alpha=0.01)
    scored = predict(model, ratings).filter(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    return ids.decode(scored).select("user", "product", "rating")


def _metrics_of(model, predictions, ratings):
    from .plans import metrics as M
    met = M.regression_metrics(M.weighted_score_and_labels(ratings, predictions), weight="weight")
    return met.select(F.lit(model).alias("model"), *met.columns)


@query
def als_insample_metrics(spark, sf):
    """For each of the four matrices: explicit ALS (rank 10, 10 iterations, lambda 0.01)
    on weights shifted by -1.5, scored on its own training pairs (ratings ⋈ predictions,
    a row for every pair of a rating and a prediction), with RMSE and R²."""
    from .plans.factorize import fit, predict

    def scored(m, r):
        model = fit(r, implicit=False, rank=10, max_iter=10, reg_param=0.01)
        # Computed here: the ratings and what the fit left go before the next model.
        return ops.materialize(_metrics_of(m, predict(model, r.select("user", "product")), r))

    out = None
    for m, ratings in _four_ratings(spark, sf):
        met = scored(m, ratings.withColumn("rating", F.col("rating") - F.lit(1.5)))
        out = met if out is None else out.unionByName(met)
    return out


@query
def als_holdout_metrics(spark, sf):
    """Train on 80 % and score the held-out 20 % for each matrix, with the reference's
    settings (model 1: implicit, alpha 0.01; models 2-4: explicit, lambda 0.01; rank 10,
    10 iterations): one row per model with MSE / RMSE / R² (implicit scores against the
    1-3 weights, as the reference reports them)."""
    from .plans.factorize import fit, predict

    def scored(m, ratings):
        train, test = _split_stored(ratings)
        model = fit(train, implicit=(m == 1), rank=10, max_iter=10, reg_param=0.01, alpha=0.01)
        met = _metrics_of(m, predict(model, test.select("user", "product")), test)
        return ops.materialize(met.select("model", F.lit(m == 1).alias("implicit"), *met.columns[1:]))

    out = None
    for m, ratings in _four_ratings(spark, sf):
        met = scored(m, ratings)
        out = met if out is None else out.unionByName(met)
    return out


@query
def als_ranking_metrics(spark, sf):
    """Ranking evaluation of ALS recommendations (the reference's stated last step):
    implicit ALS on model 1's 80 % split, top-10 categories per user, relevant = the
    user's held-out categories; over all users with held-out items (one whom training never
    saw has no list and scores 0)."""
    from .plans.factorize import recommend_for
    from .plans.ranking import ranking_metrics as rank_metrics
    model, test = _implicit_model(spark, sf)
    held = test.select("user", "product").distinct()
    rel = held.groupBy("user").agg(F.count(F.lit(1)).alias("n_rel"))
    top = recommend_for(model, rel.select("user"), 10)
    hits = (top.join(held.withColumn("hit", F.lit(1)), ["user", "product"], "left")
               .select("user", "rank", F.coalesce("hit", F.lit(0)).alias("hit")))
    return rank_metrics(hits, rel, 10)


@query
def als_tuned(spark, sf):
    """Implicit ALS, 8-setting grid, 3-fold CV on 80 %, best model's RMSE on 20 %."""
    from .plans.tune import tune
    train, test = _split_pairs(_model1_ratings(spark, sf))
    _, summary = tune(train, test, implicit=True, method="cv")
    return summary


@query
def als_tuned_tvs(spark, sf):
    """Same grid with one seeded train/validation split (trainRatio 0.8)."""
    from .plans.tune import tune
    train, test = _split_pairs(_model1_ratings(spark, sf))
    _, summary = tune(train, test, implicit=True, method="tvs")
    return summary


@query
def als_tuned_tvs_baskets(spark, sf):
    """The single-split search for models 2 to 4, one row each."""
    from .plans.tune import tune

    def searched(m, ratings):
        train, test = _split_stored(ratings)
        # One fit's files at a time: four at once take four times the disk.
        _, summary = tune(train, test, implicit=True, method="tvs", parallelism=1)
        return ops.materialize(summary.select(F.lit(m).alias("model"), *summary.columns))

    out = None
    for m, ratings in _basket_ratings(spark, sf):
        summary = searched(m, ratings)
        out = summary if out is None else out.unionByName(summary)
    return out
