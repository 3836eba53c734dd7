"""The reference's inputs, derived from the driver's tables.

The reference reads a click log (timestamp, visitorid, event, itemid, transactionid), a
time-stamped item-property log split over two files, and writes/reads rating matrices
and factor tables.  These functions build the same shapes from the driver's parquet
tables, as plain projections and filters that Catalyst pushes into the scans:

* ``click_log``  <- events: view/click/purchase become view/addtocart/transaction, any
  other label (error, signup) stays as it is; the item is ``props.k``; purchases carry
  their event id as transaction id.
* ``basket_log`` <- lineitem: year-level timestamps, so full-row duplicates exist and
  the "more than k events" filter bites.
* ``item_props`` <- lineitem: ``categoryid`` rows where returnflag R and quantity <= 5;
  split into two parts by linestatus (O = part 1, F = part 2).
* factor tables <- embeddings: even vec_ids are users, odd ones products, both with
  id = vec_id div 2, so that either side grows with the table and starts at 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_millis, year_start_millis
from .tables import read_table

# Fixed values of the fixture mapping.
CLICK_EVENT_LABELS = {"view": "view", "click": "addtocart", "purchase": "transaction"}
BASKET_EVENT_LABELS = {"N": "view", "R": "addtocart"}   # any other flag -> transaction


def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    label = None
    for src, dst in CLICK_EVENT_LABELS.items():
        cond = F.col("event_type") == src
        label = F.when(cond, F.lit(dst)) if label is None else label.when(cond, F.lit(dst))
    label = label.otherwise(F.col("event_type"))
    return (ev.select(epoch_millis("ts").alias("timestamp"),
                      F.col("user_id").cast("int").alias("visitorid"),
                      label.alias("event"),
                      F.get_json_object("props", "$.k").cast("int").alias("itemid"),
                      F.when(F.col("event_type") == "purchase", F.col("event_id"))
                       .alias("transactionid")))


def basket_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    return li.select(
        F.year("l_shipdate").cast("bigint").alias("timestamp"),
        F.col("l_orderkey").alias("visitorid"),
        F.when(flag == "N", F.lit("view")).when(flag == "R", F.lit("addtocart"))
         .otherwise(F.lit("transaction")).alias("event"),
        F.col("l_suppkey").alias("itemid"),
        F.when(flag == "A", F.col("l_linenumber")).alias("transactionid"))


def item_props(spark: SparkSession, sf_dir: str, part: int | None = None,
               ts_grain: str = "ms") -> DataFrame:
    """Item-property log; ``part`` 1/2 selects one of the two files, None gives both.

    ``ts_grain='year'`` cuts the timestamp to January 1st, which makes latest-timestamp
    ties common (edge case: several categories at one latest timestamp).
    """
    li = read_table(spark, sf_dir, "lineitem")
    if part is not None:
        li = li.filter(F.col("l_linestatus") == ("O" if part == 1 else "F"))
    ts = year_start_millis("l_shipdate") if ts_grain == "year" else epoch_millis("l_shipdate")
    prop = (F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") <= 5),
                   F.lit("categoryid")).otherwise(F.col("l_returnflag")))
    return li.select(ts.alias("timestamp"), F.col("l_partkey").cast("int").alias("itemid"),
                     prop.alias("property"),
                     (F.col("l_suppkey") % 20).cast("string").alias("value"))


def item_props_parts(spark: SparkSession, sf_dir: str, ts_grain: str = "ms"):
    return (item_props(spark, sf_dir, 1, ts_grain), item_props(spark, sf_dir, 2, ts_grain))


def _factors(spark: SparkSession, sf_dir: str, users: bool) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return (emb.filter(F.pmod("vec_id", F.lit(2)) == (0 if users else 1))
               .select(F.expr("vec_id div 2").cast("int").alias("id"),
                       F.col("embedding").cast("array<double>").alias("features"),
                       F.col("label")))


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factors(spark, sf_dir, True)


def product_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factors(spark, sf_dir, False)
