"""Event-log and property-log preparation.

Every function is DataFrame -> DataFrame.  All are lazy but for the dimension joins
(``latest_per_key``, ``events_with_category``, ``events_of_active``), which compute and
measure their small side while the plan is built (see ``joins``).  Where the reference's
literal formulation and a cheaper plan differ, both are offered and give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weights import recode_expr, weight_expr
from .joins import DEFAULT_MAX_BROADCAST_BYTES, Dimension, join_dimension
from .latest import latest_candidates, latest_rows


def clean_events(events: DataFrame, drop=("timestamp", "transactionid")) -> DataFrame:
    """Drop the noise columns (the reference keeps visitorid, event, itemid)."""
    return events.drop(*drop)


def union_parts(*parts: DataFrame) -> DataFrame:
    """Bag union of same-schema parts, matched by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_property(props: DataFrame, name: str = "categoryid",
                    prop_col: str = "property") -> DataFrame:
    """Keep one property of an entity-attribute-value log (pushed into the scan)."""
    return props.filter(F.col(prop_col) == F.lit(name))


def latest_ts_per_key(df: DataFrame, key: str = "itemid", ts: str = "timestamp") -> DataFrame:
    """(key, max ts).  Partial aggregation runs map-side, so a hot key costs one row per task."""
    return df.groupBy(key).agg(F.max(ts).alias(ts))


def latest_per_key(df: DataFrame, key: str = "itemid", ts: str = "timestamp",
                   method: str = "join",
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows carrying their key's latest timestamp; ties are all kept.

    ``join``  : max per key (pre-aggregated map-side: a hot key costs one row per task),
                then a join back on (key, ts) as a checked-broadcast dimension join —
                the rows are not shuffled at all under the bound; over it the join
                hashes on (key, ts), spreading a hot key's rows over its timestamps.
    ``window``: ``rank() over (partition by key order by ts desc) = 1`` over what is left
                when each task has let go of the rows that a later one of its own beats
                (``latest_candidates``): of a hot key one group of tied rows per task
                meets in the window.  Use it when few rows tie.
    ``onepass``: the same candidates, stored and picked by a join (``latest_rows``); ties of
                a key may be any number.
    """
    if method == "join":
        return join_dimension(df, latest_ts_per_key(df, key, ts), [key, ts],
                              max_broadcast_bytes=max_broadcast_bytes).select(*df.columns)
    if method == "window":
        w = Window.partitionBy(key).orderBy(F.col(ts).desc())
        return (latest_candidates(df, key, ts).withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") == 1)
                  .drop("_rk"))
    if method == "onepass":
        return latest_rows(df, key, ts, max_broadcast_bytes=max_broadcast_bytes)
    raise ValueError(f"unknown method {method}")


def events_with_category(events: DataFrame, latest: DataFrame | Dimension, key: str = "itemid",
                         max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Inner equi-join of events with the latest-category rows; uncategorised items drop.

    The category side grows with the item count, so it is broadcast only behind a
    measured size check (``join_dimension``); otherwise a shuffle join AQE skew-splits.
    """
    return join_dimension(events, latest, key, max_broadcast_bytes=max_broadcast_bytes)


def events_per_visitor(events: DataFrame, key: str = "visitorid") -> DataFrame:
    return events.groupBy(key).count()


def active_visitors(events: DataFrame, min_events_exclusive: int = 1,
                    key: str = "visitorid") -> DataFrame:
    """Visitors with more than ``min_events_exclusive`` rows (HAVING count > k)."""
    return events_per_visitor(events, key).filter(F.col("count") > min_events_exclusive)


#: Rows of a key that may meet in one window task.
WINDOW_ROWS = 100_000


def events_of_active(events: DataFrame, min_events_exclusive: int = 1, key: str = "visitorid",
                     method: str = "join", max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Events of visitors with more than k events.

    ``join``  : events ⋈ (visitor, count) — the reference's form, ``count`` carried along
                (checked-broadcast dimension join).
    ``window``: ``count(*) over (partition by visitor)`` + filter; same rows and columns.
                Visitors with more than ``max_window_rows`` events (counted first; there are
                at most a ``max_window_rows``-th as many as events) get their count by the
                join instead, so that no task sorts more rows of one visitor.
    ``semi``  : left-semi join (checked broadcast of the visitor set), no ``count``
                column; the form the matrices use.
    """
    if method == "join":
        return join_dimension(events, active_visitors(events, min_events_exclusive, key), key)
    if method == "window":
        w = Window.partitionBy(key)
        cols = [key] + [c for c in events.columns if c != key]
        known = events.filter(F.col(key).isNotNull())
        hot = Dimension.of(active_visitors(known, max_window_rows, key))
        rest = hot.joined_to(known, key, "left_anti") if hot.rows else known
        out = rest.withColumn("count", F.count(F.lit(1)).over(w)).select(*cols, "count")
        if hot.rows:
            out = out.unionByName(hot.joined_to(known, key).select(*cols, "count"))
        return out.filter(F.col("count") > min_events_exclusive)
    if method == "semi":
        return join_dimension(events, active_visitors(events, min_events_exclusive, key)
                              .select(key), key, "left_semi")
    raise ValueError(f"unknown method {method}")


def weight_events(df: DataFrame, event_col: str = "event", out_col: str = "rating",
                  on_unknown: str = "error") -> DataFrame:
    """Add the implicit-feedback weight of each event label (view 1, cart 2, buy 3)."""
    out = df.withColumn(out_col, weight_expr(event_col, on_unknown))
    if on_unknown == "drop":
        out = out.filter(F.col(out_col).isNotNull())
    return out


def recode_events(df: DataFrame, event_col: str = "event") -> DataFrame:
    """The event column recoded in place to '1', '2', '3'; unknown labels are kept."""
    return df.withColumn(event_col, recode_expr(event_col))


def project_triple(df: DataFrame, user: str = "visitorid", item: str = "itemid",
                   rating: str = "rating") -> DataFrame:
    """(user, item, rating) projection; duplicates kept."""
    return df.select(user, item, rating)
