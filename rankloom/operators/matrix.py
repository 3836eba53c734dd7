"""The four user-by-product rating matrices, and helpers around them.

Plans are chosen for skew: every shuffle of the big side is preceded by a map-side
partial aggregation (distinct / count), and filters by visitor activity are
left-semi joins that AQE can skew-split.  Results equal the reference's literal
chains (the tests check both forms).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_MAX_BROADCAST_BYTES, Dimension, join_dimension
from .prep import (active_visitors, filter_property, latest_per_key, union_parts,
                   weight_events)


def category_matrix(events: DataFrame, props_parts: list[DataFrame], on_unknown: str = "error",
                    latest_method: str = "join",
                    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Model 1: distinct (visitorid, categoryid, rating) over each item's latest category.

    Only (itemid, categoryid) of the latest rows reach the events join, which is a
    checked-broadcast dimension join: below the bound the events are never shuffled
    by item (a hot item costs nothing extra); the one shuffle of the event side is the
    final distinct, after a map-side partial distinct.
    """
    cats = filter_property(union_parts(*props_parts), "categoryid")
    latest = latest_per_key(cats, "itemid", "timestamp", latest_method, max_broadcast_bytes)
    return category_matrix_from_latest(events, latest, on_unknown, max_broadcast_bytes)


def category_matrix_from_latest(events: DataFrame, latest: DataFrame | Dimension, on_unknown: str = "error",
                                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Model 1 from already computed latest-category rows (itemid, ..., value); a measured
    ``Dimension`` is not computed or measured again."""
    dim = latest.select("itemid", F.col("value").cast("int").alias("categoryid"))
    ev = weight_events(events.select("visitorid", "itemid", "event"), on_unknown=on_unknown)
    return (join_dimension(ev, dim, "itemid", max_broadcast_bytes=max_broadcast_bytes)
            .select("visitorid", "categoryid", "rating")
            .distinct())


def visitor_matrix(events: DataFrame, min_events_exclusive: int = 1, distinct_triples: bool = True,
                   user: str = "visitorid", item: str = "itemid",
                   on_unknown: str = "error",
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Models 2–4: events of visitors with more than k events as (user, item, rating).

    ``distinct_triples=False`` (model 2): full-row distinct of the events, then the
    projection keeps duplicate triples.  ``True`` (models 3, 4): distinct triples.
    Distinct runs before the activity filter: the filter depends on the visitor only,
    so the two commute, and the distinct's map-side pass shrinks the semi-join input.
    The visitor set is broadcast behind a measured size check (then the distinct rows are
    shuffled once); above the bound the semi join shuffles and AQE splits hot visitors.
    """
    keep = active_visitors(events, min_events_exclusive, user).select(user)
    if distinct_triples:
        base = weight_events(events.select(user, item, "event"), on_unknown=on_unknown) \
            .select(user, item, "rating").distinct()
    else:
        base = weight_events(events.distinct(), on_unknown=on_unknown)
    return (join_dimension(base, keep, user, "left_semi", max_broadcast_bytes=max_broadcast_bytes)
            .select(user, item, "rating"))


def collapse_pairs(ratings: DataFrame, user: str = "visitorid", item: str = "itemid",
                   rating: str = "rating") -> DataFrame:
    """One row per (user, item) with the count, max, sum and mean of its weights.

    ALS treats repeated pairs as separate observations; this is the opt-in collapse.
    """
    return (ratings.groupBy(user, item)
                   .agg(F.count(F.lit(1)).alias("n"), F.max(rating).alias("rating_max"),
                        F.sum(rating).alias("rating_sum"), F.avg(rating).alias("rating_mean")))


INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


COLLAPSE = ("none", "max", "sum", "mean")


def to_ratings(df: DataFrame, user: str = "visitorid", item: str = "itemid",
               rating: str = "rating", collapse: str = "none") -> DataFrame:
    """(user INT, product INT, rating DOUBLE) for ALS; ids outside INT raise a clear error.

    ``collapse``: ``none`` keeps repeated (user, product) rows as separate observations
    (what ALS does with them, and the reference's behaviour); ``max`` / ``sum`` /
    ``mean`` fold each pair into one rating first (partial aggregation map-side).
    """
    if collapse not in COLLAPSE:
        raise ValueError(f"collapse must be one of {COLLAPSE}")
    if collapse != "none":
        fold = {"max": F.max, "sum": F.sum, "mean": F.avg}[collapse]
        df = df.groupBy(user, item).agg(fold(rating).alias(rating))
    def as_int(c: str):
        col = F.col(c)
        ok = col.isNull() | col.between(INT_MIN, INT_MAX)
        return F.when(ok, col.cast("int")).otherwise(
            F.raise_error(F.concat(F.lit(f"{c} outside the INT range required by ALS: "),
                                   col.cast("string"))).cast("int"))
    return df.select(as_int(user).alias("user"), as_int(item).alias("product"),
                     F.col(rating).cast("double").alias("rating"))
