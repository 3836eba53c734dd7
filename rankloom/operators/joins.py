"""Fact ⋈ dimension joins with a checked broadcast.

A dimension (one row per item, per category, per user factor, ...) grows with the data,
so it is broadcast only after its size is proven: it is first materialised into the
session's shared checkpoint folder (reliable, survives executor loss, computed once),
then one aggregate over it measures rows and widths (string lengths, array lengths) and
the estimated bytes are compared to a bound.  Under the bound the fact side streams
through a map-side hash join and is never shuffled for the join; over it, a shuffle
join is planned and AQE splits skewed (hot-key) partitions at runtime.  Both give the same
rows.  Planning such a join runs the dimension's jobs; ``Dimension`` keeps the outcome, so
a dimension that several joins use is computed and measured once.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root, remove_path, scratch_path

# Estimated in-memory bytes allowed in one broadcast.
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD = 16


def _fixed_width(dt: T.DataType) -> int | None:
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, (T.ShortType,)):
        return 2
    if isinstance(dt, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(dt, T.DecimalType):
        return 16
    return None


def estimate_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) from one aggregate: fixed widths by type, strings by
    average length, arrays by their longest length x element width."""
    aggs, fixed = [F.count(F.lit(1)).alias("_n")], 0
    for f in df.schema.fields:
        w = _fixed_width(f.dataType)
        if w is not None:
            fixed += w
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            aggs.append(F.avg(F.length(F.col(f.name))).alias(f"_s_{f.name}"))
        elif isinstance(f.dataType, T.ArrayType):
            elem = _fixed_width(f.dataType.elementType) or 16
            aggs.append((F.max(F.size(F.col(f.name))) * F.lit(elem)).alias(f"_a_{f.name}"))
        else:
            fixed += 64
    row = df.agg(*aggs).first()
    n = int(row["_n"])
    width = fixed + ROW_OVERHEAD + sum(int(v or 0) for k, v in row.asDict().items() if k != "_n")
    return n, n * width


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a (small) intermediate: cuts lineage, computed once."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Lets a command delete its shuffle files when it is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``materialize`` for a table as large as the input: parquet in the scratch folder takes a
    fraction of a checkpoint's bytes, and the shuffle files that made it go at once.
    ``discard`` deletes it."""
    spark = df.sparkSession
    path, before = scratch_path(spark, "stored"), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that no later step reads, and what nothing refers
    to any more."""
    remove_path(table.sparkSession, table._stored_at)
    collect_garbage(table.sparkSession)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark's cleaner have what nothing refers to any more: the shuffle files and
    persisted blocks of earlier fits otherwise stay until the driver happens to collect."""
    gc.collect()
    spark._jvm.System.gc()


@dataclass
class Dimension:
    """A materialised, measured dimension; join it as often as needed, it is computed and
    measured once.  ``size`` is its estimated bytes."""

    df: DataFrame
    rows: int
    size: int

    @classmethod
    def of(cls, df: DataFrame | Dimension) -> Dimension:
        """Materialise and measure ``df`` (three jobs); a Dimension is returned as it is."""
        if isinstance(df, cls):
            return df
        df = materialize(df)
        return cls(df, *estimate_bytes(df))

    def select(self, *cols) -> Dimension:
        """A projection; the size stays as an upper bound (casts to wider types aside)."""
        return Dimension(self.df.select(*cols), self.rows, self.size)

    def joined_to(self, fact: DataFrame, on, how: str = "inner",
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
        return fact.join(F.broadcast(self.df) if self.size <= max_broadcast_bytes else self.df, on, how)


def join_dimension(fact: DataFrame, dim: DataFrame | Dimension, on, how: str = "inner",
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    return Dimension.of(dim).joined_to(fact, on, how, max_broadcast_bytes)
