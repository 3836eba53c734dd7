"""Distinct counts that merge: one sketch per part of a log, kept beside it.

An exact distinct count of a grown log reads all of it again. Here each part (a day, a load) is
read once, when it is added, and leaves one row: its row count and a HyperLogLog sketch per id
column, of fixed size. Counts over any set of parts are a union of their sketches. Added data
costs only itself; a part that is added again replaces its row, so a load can be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Log2 of a sketch's buckets: 16,384 buckets, a relative standard error of about 0.8 %.
LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def part_sketches(df: DataFrame, part: str, columns: list[str], lg_k: int = LG_K) -> DataFrame:
    """(part, n_rows, one binary sketch per column); nulls are counted as rows, not as ids.
    Partial sketches are merged map-side, so a part or an id of a third of the rows costs one
    sketch per task."""
    return df.groupBy(F.col(part).cast("string").alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.hll_sketch_agg(_hashed(df, c), lg_k).alias(c) for c in columns])


def _hashed(df: DataFrame, column: str):
    """A type that the sketch takes, the same for INT and BIGINT ids."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("long")
    return F.col(column) if isinstance(kind, (T.StringType, T.BinaryType)) else F.col(column).cast("string")


def estimates(sketches: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Rows and distinct ids of all parts in ``sketches`` together, or of each group of them."""
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(f"n_{c}") for c in columns])


@dataclass
class SketchStore:
    """Part sketches under ``path``, a folder per part. A part's folder is replaced as a whole
    when the part is added again."""

    spark: SparkSession
    path: str
    columns: list[str]
    lg_k: int = LG_K

    @classmethod
    def open(cls, spark: SparkSession, columns: list[str], path: str | None = None, lg_k: int = LG_K) -> SketchStore:
        """The store at ``path``, or a fresh one in the shared scratch folder."""
        if {"part", "n_rows"} & set(columns):
            raise ValueError("part and n_rows are columns of the store itself")
        return cls(spark, path or scratch_path(spark, "sketches"), list(columns), lg_k)

    @property
    def _schema(self) -> str:
        return ", ".join(["n_rows bigint", *(f"`{c}` binary" for c in self.columns), "part string"])

    def add(self, df: DataFrame, part: str) -> None:
        """Sketch the parts that occur in ``df`` (whole parts); the others are not read."""
        # One row a part, so few files however many tasks counted.
        (part_sketches(df, part, self.columns, self.lg_k).repartition("part")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self.path))

    def sketches(self) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(self.path)

    def estimates(self, by: list[str] = ()) -> DataFrame:
        return estimates(self.sketches(), self.columns, by)
