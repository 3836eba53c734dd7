"""Typed readers and writers for event logs and rating matrices.

The reference infers CSV schemas (an extra pass over the data) and re-parses the
saved matrix line by line; here every read declares its schema, and a bad field fails
the read (FAILFAST), as ``int()`` / ``float()`` would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("visitorid", T.IntegerType()),
    T.StructField("event", T.StringType()),
    T.StructField("itemid", T.IntegerType()),
    T.StructField("transactionid", T.LongType()),
])

ITEM_PROPS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("itemid", T.IntegerType()),
    T.StructField("property", T.StringType()),
    T.StructField("value", T.StringType()),
])

MATRIX_COLUMNS = ("visitorid", "itemid", "rating")


def matrix_schema(user_col="visitorid", item_col="itemid", rating_col="rating",
                  id_type: T.DataType = T.LongType()) -> T.StructType:
    return T.StructType([T.StructField(user_col, id_type), T.StructField(item_col, id_type),
                         T.StructField(rating_col, T.DoubleType())])


def read_events_csv(spark: SparkSession, path: str, schema: T.StructType = EVENTS_SCHEMA) -> DataFrame:
    """CSV event / property log with a header line and a declared schema."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .csv(path))


def write_rating_matrix(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a matrix as a directory of part files (no ``coalesce(1)`` funnel)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")
    return path


def load_rating_matrix(spark: SparkSession, path: str, fmt: str = "csv",
                       user_col="visitorid", item_col="itemid", rating_col="rating",
                       id_type: T.DataType = T.LongType(), header_lines: str = "first") -> DataFrame:
    """Read a saved matrix.

    CSV, ``header_lines='first'``: the CSV reader drops the header of every part file.
    ``'every'``: every line equal to the header is dropped wherever it appears (the
    reference's ``filter(line != header)``), then the lines are parsed natively with
    ``from_csv``; a malformed line still fails the read.
    """
    schema = matrix_schema(user_col, item_col, rating_col, id_type)
    if fmt == "csv" and header_lines == "every":
        header = ",".join(schema.fieldNames())
        lines = spark.read.text(path).filter(F.col("value") != F.lit(header))
        parsed = F.from_csv("value", schema.simpleString(), {"mode": "FAILFAST"})
        return lines.select(parsed.alias("r")).select("r.*")
    if fmt == "csv":
        return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
                .csv(path))
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unknown format {fmt}")
