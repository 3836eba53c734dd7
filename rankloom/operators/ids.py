"""Dense ids for keys of any type, without a driver-side list.

MLlib's factor models take INT ids; shops have strings and longs.  ``numbered`` gives the rows
of a table the numbers 0, 1, 2, ... in key order: rows are ranged and sorted by key, each range
counts its rows, and a row's number is the total of the earlier ranges plus its place in its
own.  Only one count per range reaches the driver.

``IdDictionary`` holds raw key -> id.  It is stable: ``extend`` keeps every id already given
and numbers only keys it has not seen, behind the last one.  ``encode`` and ``decode`` are
checked-broadcast dimension joins (``operators/joins.py``): a small dictionary is shipped, a
large one is shuffled and hot keys are split by adaptive execution.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import DEFAULT_MAX_BROADCAST_BYTES, Dimension, materialize

#: monotonically_increasing_id() holds the partition above this many bits.
PART_BITS = 33


def numbered(rows: DataFrame, keys: list[str], name: str = "id", start: int = 0) -> DataFrame:
    """``rows`` with ``name``: start, start + 1, ... in the order of ``keys`` (nulls first;
    rows with equal keys in any order).  Checkpointed, so the numbers never change."""
    at = f"{name}_place"
    placed = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn(at, F.monotonically_increasing_id()))
    part = F.shiftright(at, PART_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size")).collect()
    first, offsets = start, []
    for row in sorted(sizes, key=lambda r: r["part"]):
        offsets.append((row["part"], first))
        first += row["size"]
    spark = rows.sparkSession
    table = spark.createDataFrame(offsets, f"{at}_part long, {at}_first long")
    return (placed.join(F.broadcast(table), part == F.col(f"{at}_part"))
            .withColumn(name, F.col(f"{at}_first") + F.col(at).bitwiseAND(F.lit((1 << PART_BITS) - 1)))
            .select(*rows.columns, name))


@dataclass
class IdDictionary:
    """``table``: (raw, id), one row per distinct non-null key; ids are 0 .. size - 1, INT."""

    table: DataFrame
    size: int

    @classmethod
    def of(cls, keys: DataFrame) -> IdDictionary:
        """The dictionary of the single column of ``keys``; null has no id."""
        return cls._empty(keys).extend(keys)

    @classmethod
    def _empty(cls, keys: DataFrame) -> IdDictionary:
        raw = keys.select(F.col(keys.columns[0]).alias("raw"))
        return cls(raw.limit(0).withColumn("id", F.lit(0)), 0)

    def extend(self, keys: DataFrame) -> IdDictionary:
        """A dictionary that also has the keys of ``keys``; ids already given stay."""
        seen = keys.select(F.col(keys.columns[0]).alias("raw")).filter("raw is not null").distinct()
        if self.size:
            seen = seen.join(self.table, "raw", "left_anti")
        fresh = numbered(seen, ["raw"], "id", self.size)
        size = self.size + fresh.count()
        if size > 1 << 31:
            raise ValueError(f"{size} ids do not fit the INT ids of the factor models")
        fresh = fresh.withColumn("id", F.col("id").cast("int"))
        return IdDictionary(self.table.unionByName(fresh) if self.size else fresh, size)

    @cached_property
    def dimension(self) -> Dimension:
        return Dimension.of(self.table)

    def _joined(self, df: DataFrame, column: str, have: str, want: str, how: str, bound: int) -> DataFrame:
        side = self.dimension.select(F.col(have).alias(column), F.col(want).alias(f"{column}__other"))
        if df.schema[column].dataType != side.df.schema[column].dataType:
            raise TypeError(f"{column}: {df.schema[column].dataType} where the dictionary has "
                            f"{side.df.schema[column].dataType}")
        joined = side.joined_to(df, column, how, bound)
        return joined.select(*[F.col(f"{column}__other").alias(column) if c == column else F.col(c) for c in df.columns])

    def encode(self, df: DataFrame, column: str, how: str = "inner",
               max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
        """``df`` with the keys in ``column`` replaced by ids; rows whose key is null or
        unknown go, or stay with a null id (``how='left'``)."""
        return self._joined(df, column, "raw", "id", how, max_broadcast_bytes)

    def decode(self, df: DataFrame, column: str, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
        """The inverse of ``encode``."""
        return self._joined(df, column, "id", "raw", "inner", max_broadcast_bytes)

    def save(self, path: str) -> None:
        self.table.write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IdDictionary:
        table = spark.read.parquet(path)
        return cls(table, table.count())


@dataclass
class RatingIds:
    """The user and product dictionaries of a rating matrix whose ids are of any type."""

    users: IdDictionary
    products: IdDictionary

    @classmethod
    def of(cls, matrix: DataFrame, user: str = "visitorid", item: str = "itemid") -> RatingIds:
        return cls(IdDictionary.of(matrix.select(user)), IdDictionary.of(matrix.select(item)))

    def extend(self, matrix: DataFrame, user: str = "visitorid", item: str = "itemid") -> RatingIds:
        """Ids for a later matrix too; those already given stay."""
        return RatingIds(self.users.extend(matrix.select(user)), self.products.extend(matrix.select(item)))

    def ratings(self, matrix: DataFrame, user: str = "visitorid", item: str = "itemid", rating: str = "rating") -> DataFrame:
        """(user INT, product INT, rating DOUBLE) for the factor models; rows with a null or
        unknown id go."""
        rows = matrix.select(F.col(user).alias("user"), F.col(item).alias("product"), F.col(rating).cast("double").alias("rating"))
        return self.products.encode(self.users.encode(rows, "user"), "product")

    def decode(self, df: DataFrame) -> DataFrame:
        """The raw ids in the columns ``user`` and ``product``, whichever are there."""
        for column, ids in (("user", self.users), ("product", self.products)):
            if column in df.columns:
                df = ids.decode(df, column)
        return df

    def decode_factors(self, factors: DataFrame) -> DataFrame:
        """Factor tables (side, id, ...) with raw ids, as strings where the sides differ in type."""
        parts = [ids.decode(factors.filter(F.col("side") == side), "id") for side, ids in (("user", self.users), ("product", self.products))]
        if parts[0].schema["id"].dataType != parts[1].schema["id"].dataType:
            parts = [p.withColumn("id", F.col("id").cast("string")) for p in parts]
        return parts[0].unionByName(parts[1])

    def save(self, path: str) -> None:
        self.users.save(f"{path}/user")
        self.products.save(f"{path}/product")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RatingIds:
        return cls(IdDictionary.load(spark, f"{path}/user"), IdDictionary.load(spark, f"{path}/product"))
