"""Matrix exploration: distinct ids, per-user counts, summary stats, crosstab."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weights import EVENT_WEIGHTS
from .ids import numbered
from .joins import join_dimension, materialize

#: Levels of the second column up to which a contingency table has one array a row.
MAX_LEVELS = 1_000


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def ratings_per_user(df: DataFrame, user: str = "visitorid") -> DataFrame:
    return df.groupBy(user).count()


def ratings_per_user_stats(df: DataFrame, user: str = "visitorid") -> DataFrame:
    """Typed one-row ``describe()`` of ratings per user (sample stddev)."""
    c = F.col("count")
    return (ratings_per_user(df, user)
            .agg(F.count(c).alias("n"), F.avg(c).alias("mean"),
                 F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"),
                 F.max(c).alias("max")))


def user_rating_crosstab(df: DataFrame, user: str = "visitorid", rating: str = "rating") -> DataFrame:
    """Counts per user and weight level (w1, w2, w3), zero when absent.

    Fixed output columns (the weight levels are known), so no distinct pass over
    the ratings and no column-count limit; partial aggregation map-side.
    """
    aggs = [F.count(F.when(F.col(rating) == F.lit(w), 1)).alias(f"w{int(w)}")
            for w in EVENT_WEIGHTS.values()]
    return df.groupBy(user).agg(*aggs)


@dataclass
class Contingency:
    """A contingency table of two columns.  ``levels`` holds (level, place), the second
    column's values in order.  ``wide``: ``table`` has one row per value of the first column
    with ``counts``, an array in the order of the places (0 where a pair is absent).
    Otherwise ``table`` is the long form (first, second, n) of the pairs that occur."""

    table: DataFrame
    levels: DataFrame
    n_levels: int
    wide: bool


def contingency(df: DataFrame, first: str, second: str, max_levels: int = MAX_LEVELS) -> Contingency:
    """How often each value of ``first`` meets each value of ``second``, for any two columns.

    The pairs are counted once (map-side first) and kept.  Levels are numbered by ranges, no
    list of them is made on the driver; their checked count decides the form.  In the wide
    form a row gathers at most ``max_levels`` counts.  Null is a value like any other: first
    in the order of levels, a row of its own."""
    pairs = materialize(df.groupBy(F.col(first).alias("first"), F.col(second).alias("second")).agg(F.count(F.lit(1)).alias("n")))
    levels = numbered(pairs.select(F.col("second").alias("level")).distinct(), ["level"], "place")
    n_levels = levels.count()
    if n_levels > max_levels:
        return Contingency(pairs.select(F.col("first").alias(first), F.col("second").alias(second), "n"), levels, n_levels, False)
    placed = levels.select(F.coalesce(F.col("level").cast("string"), F.lit("")).alias("_level"),
                           F.col("level").isNull().alias("_null"), "place")
    keyed = pairs.withColumn("_level", F.coalesce(F.col("second").cast("string"), F.lit(""))).withColumn("_null", F.col("second").isNull())
    rows = join_dimension(keyed, placed, ["_level", "_null"])
    held = F.map_from_entries(F.collect_list(F.struct("place", "n")))
    places = F.sequence(F.lit(0).cast("long"), F.lit(n_levels - 1).cast("long"))
    table = rows.groupBy("first").agg(held.alias("held")).select(
        F.col("first").alias(first), 
        F.transform(places, lambda p: F.coalesce(F.try_element_at("held", p), F.lit(0))).alias("counts"))
    return Contingency(table, levels, n_levels, True)


def matrix_profile(df: DataFrame, user: str = "visitorid", item: str = "itemid",
                   rating: str = "rating", approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row: ratings, distinct users, products, (user, product) pairs, density.

    Exact: the ratings are folded to one row per pair (map-side first), users and products
    are counted from the pairs.  ``approx=True`` uses HyperLogLog++ sketches (relative
    standard deviation ``rsd``): one pass, fixed-size partial states, the option for
    billions of users.  Null ids count as no user, product or pair.
    """
    if approx:
        prof = df.agg(F.count(F.lit(1)).alias("n_ratings"),
                      F.approx_count_distinct(user, rsd).alias("n_users"),
                      F.approx_count_distinct(item, rsd).alias("n_products"),
                      F.approx_count_distinct(F.struct(user, item), rsd).alias("n_pairs"),
                      F.avg(rating).alias("mean_rating"))
    else:
        pairs = df.groupBy(user, item).agg(F.count(F.lit(1)).alias("_n"), F.sum(rating).alias("_s"),
                                           F.count(rating).alias("_k"))
        users = pairs.groupBy(user).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.sum("_k").alias("_k"),
                                        F.count(F.when(F.col(user).isNotNull(), F.col(item))).alias("_p"))
        totals = users.agg(F.sum("_n").alias("n_ratings"), F.count(user).alias("n_users"),
                           F.sum("_p").alias("n_pairs"), (F.sum("_s") / F.sum("_k")).alias("mean_rating"))
        # one row each, side by side
        products = pairs.groupBy(item).agg(F.lit(1).alias("_one")).agg(F.count(item).alias("n_products"))
        prof = (totals.withColumn("_k", F.lit(0)).join(products.withColumn("_k", F.lit(0)), "_k")
                .select(F.coalesce("n_ratings", F.lit(0)).alias("n_ratings"), "n_users", "n_products",
                        F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), "mean_rating"))
    return prof.withColumn(
        "density", F.try_divide(F.col("n_ratings"), F.col("n_users") * F.col("n_products")))
