"""Fitted models kept under a fingerprint of their data and parameters.

``fit_once`` fits a model the first time it is asked for and loads it ever after: prediction,
top-N, ranking and factor export share one fit.  The fingerprint is one aggregate over the
ratings (count, and two order-free sums of row hashes) with the parameters; any changed row,
added copy or other parameter gives another one.  A model is written aside and renamed into
place, so a torn write is never read, and of two writers one finds the other's model.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .factorize import DEFAULT_BLOCKS, fit

#: Bump when the meaning of a stored model changes.
FORMAT = 1


def data_fingerprint(ratings: DataFrame) -> dict[str, str]:
    row = F.xxhash64(*ratings.columns).cast("decimal(38,0)")
    other = F.hash(*ratings.columns).cast("decimal(38,0)")
    got = ratings.agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("a"), F.sum(other).alias("b"),
                      F.sum(row * other).alias("c")).first()
    return {"columns": ",".join(f"{c}:{t}" for c, t in ratings.dtypes)} | {k: str(got[k]) for k in ("n", "a", "b", "c")}


def fingerprint(ratings: DataFrame, implicit: bool, **params) -> str:
    told = {"format": FORMAT, "implicit": implicit, "blocks": DEFAULT_BLOCKS} | params
    text = json.dumps([told, data_fingerprint(ratings)], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


class ModelStore:
    """Models under ``root``; without one, under the session's shared checkpoint folder, where
    they last as long as the application's scratch files."""

    def __init__(self, spark, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{checkpoint_root(spark).rstrip('/')}/models").rstrip("/")

    def _path(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def has(self, name: str) -> bool:
        at, fs = self._path(f"{self.root}/{name}")
        return fs.exists(at)

    def load(self, name: str) -> ALSModel:
        return ALSModel.load(f"{self.root}/{name}")

    def save(self, model: ALSModel, name: str) -> None:
        aside = f"{self.root}/_{uuid.uuid4().hex}"
        model.write().save(aside)
        at, fs = self._path(aside)
        to, _ = self._path(f"{self.root}/{name}")
        # A rename onto a folder that is there would move this one into it.
        if fs.exists(to) or not fs.rename(at, to):
            fs.delete(at, True)

    def fit_once(self, ratings: DataFrame, implicit: bool, **params) -> ALSModel:
        """The stored model of these ratings and parameters, fitted if there is none."""
        name = fingerprint(ratings, implicit, **params)
        if not self.has(name):
            self.save(fit(ratings, implicit, **params), name)
        return self.load(name)
