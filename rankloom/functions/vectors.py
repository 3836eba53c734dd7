"""Vector expressions on ARRAY columns, kept inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def dot_expr(a: str | Column, b: str | Column) -> Column:
    """Inner product of two equal-length numeric arrays, summed left to right in DOUBLE."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda s, z: s + z)
