"""Train/test splits and fold columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, hash_bucket_of


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    """Seeded ``randomSplit`` (the reference's is unseeded)."""
    return df.randomSplit(list(weights), seed)


def hash_split(df: DataFrame, cols: list[str], train_buckets: int = 8, buckets: int = 10,
               col: str = "split") -> DataFrame:
    """Adds ``split`` = 'train' | 'test' from an md5 bucket of ``cols``.

    Row-local (no shuffle), reproducible across runs, partitionings and engines; all
    rows sharing ``cols`` land on the same side.
    """
    b = hash_bucket(cols, buckets)
    return df.withColumn(col, F.when(b < train_buckets, F.lit("train")).otherwise(F.lit("test")))


#: Equal rows that one task writes out at once.
RUN_ROWS = 100_000


def row_split(df: DataFrame, train_buckets: int = 8, buckets: int = 10, col: str = "split",
              run_rows: int = RUN_ROWS) -> DataFrame:
    """Adds ``split`` = 'train' | 'test' row by row, as ``randomSplit`` does: equal rows are
    told apart by their ordinal, and each goes by the md5 bucket of its content and ordinal.

    The split depends on the rows alone, not on their order or partitioning, and any engine
    can recompute it.  Equal rows are folded to a count (map-side first) and written out from
    it again in runs of ``run_rows``, so a row that makes up a third of the input is the work
    of many tasks.  A null is unlike every value."""
    names = df.columns
    n, first = fresh("rows", names), fresh("first", names)
    runs = (df.groupBy(*names).agg(F.count(F.lit(1)).alias(n))
            .withColumn(first, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(run_rows).cast("long"))))
            # By number: runs are small rows, which adaptive execution would put into one task.
            .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *names, first))
    last = F.least(F.col(first) + run_rows, F.col(n)) - 1
    ordinal = fresh("ordinal", names)
    rows = runs.withColumn(ordinal, F.explode(F.sequence(F.col(first), last)))
    b = hash_bucket_of([F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in names] + [F.col(ordinal).cast("string")], buckets)
    return rows.select(*names, F.when(b < train_buckets, F.lit("train")).otherwise(F.lit("test")).alias(col))


def fresh(base: str, taken: list[str]) -> str:
    while base in taken:
        base += "_"
    return base


def fold_column(df: DataFrame, cols: list[str], folds: int = 3, col: str = "fold") -> DataFrame:
    """Deterministic fold id in [0, folds) for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(col, hash_bucket(cols, folds))
