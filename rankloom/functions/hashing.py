"""Deterministic hash buckets (stable under repartitioning and re-execution)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(cols: list[str], buckets: int = 10, sep: str = "|") -> Column:
    """Bucket in [0, buckets) from the first 7 hex digits of md5(c1|c2|...).

    md5 is used (not Spark's murmur ``hash``) so any other engine can recompute the
    same split; 7 hex digits fit in a BIGINT without sign issues.
    """
    return hash_bucket_of([F.col(c).cast("string") for c in cols], buckets, sep)


def hash_bucket_of(parts: list[Column], buckets: int = 10, sep: str = "|") -> Column:
    """The same from string columns."""
    head = F.substring(F.md5(F.concat_ws(sep, *parts)), 1, 7)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
