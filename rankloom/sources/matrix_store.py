"""A rating matrix stored in buckets of its users.

Counts per user, their summary, the crosstab and the join of ratings with predictions all meet
on the user. Stored bucketed by user, the matrix is not shuffled for any of them: Spark takes
the buckets as the partitioning.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import materialize
from ..session import scratch_path

#: Rows of one bucket where the number of buckets is not given: some 50 MB as parquet.
BUCKET_ROWS = 4_000_000
#: Lets a join on (user, product) use a partitioning by user alone.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass
class BucketedMatrix:
    """A stored table with one file per bucket of ``key``.

    A user's rows are in one bucket: give the store a matrix without copies (models 1, 3 and 4),
    where a user has at most one row per product and weight. The rows lie in ``path/rows``;
    ``path/about`` holds their key, bucket count and schema, written last: a store that was
    not written to its end cannot be opened."""

    spark: SparkSession
    path: str
    key: str
    buckets: int
    schema: str

    @classmethod
    def write(cls, matrix: DataFrame, key: str = "visitorid", path: str | None = None,
              buckets: int | None = None) -> BucketedMatrix:
        """Store ``matrix``: one shuffle, by the key. Buckets come from the counted rows unless
        given; give two tables that will be joined the same number."""
        spark = matrix.sparkSession
        path = path or scratch_path(spark, "matrix")
        if not buckets:
            buckets = max(spark.sparkContext.defaultParallelism, -(-matrix.count() // BUCKET_ROWS))
        name = f"matrix_{uuid.uuid4().hex[:16]}"
        try:
            (matrix.repartition(buckets, key).sortWithinPartitions(key).write.format("parquet")
             .bucketBy(buckets, key).sortBy(key).option("path", f"{path}/rows").saveAsTable(name))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # the entry; the files stay
        schema = ", ".join(f"`{c}` {t}" for c, t in matrix.dtypes)
        spark.createDataFrame([(key, buckets, schema)], "key string, buckets int, schema string").coalesce(1).write.parquet(f"{path}/about")
        return cls(spark, path, key, buckets, schema)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BucketedMatrix:
        about = spark.read.parquet(f"{path}/about").first()
        return cls(spark, path, about["key"], about["buckets"], about["schema"])

    def rows(self) -> DataFrame:
        """The stored rows, bucketed; the catalog entry that tells Spark so goes at once."""
        name = f"matrix_{uuid.uuid4().hex[:16]}"
        self.spark.sql(f"""CREATE TABLE {name} ({self.schema}) USING parquet
                           CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'""")
        try:
            table = self.spark.table(name)
            table._jdf.queryExecution().analyzed()
            return table
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def joined_in_place(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """The join of two tables stored with the same key and number of buckets, without an
    exchange of either. ``on`` holds the key and any other columns. Computed and stored here,
    as the setting that allows it must hold when the join is planned."""
    spark = left.sparkSession
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        return materialize(left.join(right.hint("merge"), on, how))
    finally:
        spark.conf.set(CO_PARTITION, before)
