"""Rows of each key's greatest time, found in one pass over the log, ties kept.

Spark's aggregates carry one row per key, not all rows that tie. So each task reduces its part
of the log itself, Arrow batch by Arrow batch: it holds the rows that are still latest of their
key and lets go of every row that a later one of the same task beats. Only what is left is
shuffled: of a hot key one group of tied rows per task, however many rows it has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_MAX_BROADCAST_BYTES, join_dimension, materialize

# Runs in workers that may not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that a task holds before it hands them on as they are.
HELD_ROWS = 200_000


def reduce_rows(rows: pa.Table, key: str, ts: str) -> pa.Table:
    """The rows of ``rows`` that no row of the same key beats. Null is a key like any other and
    the least of all times."""
    if not len(rows):
        return rows
    keys = pc.dictionary_encode(rows[key].combine_chunks(), null_encoding="encode")
    codes = keys.indices.to_numpy(zero_copy_only=False)
    order = pc.rank(rows[ts].combine_chunks(), sort_keys="ascending", null_placement="at_start",
                    tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)
    greatest = np.zeros(len(keys.dictionary), np.int64)
    np.maximum.at(greatest, codes, order)
    return rows.filter(pa.array(order == greatest[codes]))


def reduce_batches(batches: Iterator[pa.RecordBatch], key: str, ts: str,
                   held_rows: int = HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """One task's part. What is read is gathered to ``held_rows`` and reduced; where more than
    half of that still ties or is a key of its own, it is handed on and forgotten, which costs
    rows in the shuffle and no result: the rows given are always a superset of the latest."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= held_rows:
            rows = reduce_rows(pa.Table.from_batches(held), key, ts).combine_chunks()
            held, n = rows.to_batches(), len(rows)
            if n > held_rows // 2:
                yield from held
                held, n = [], 0
    if held:
        yield from reduce_rows(pa.Table.from_batches(held), key, ts).to_batches()


def latest_candidates(df: DataFrame, key: str = "itemid", ts: str = "timestamp",
                      held_rows: int = HELD_ROWS) -> DataFrame:
    """``df`` without rows that another row of the same task and key beats; no shuffle."""
    def run(batches):
        return reduce_batches(batches, key, ts, held_rows)
    return df.mapInArrow(run, df.schema)


def latest_rows(df: DataFrame, key: str = "itemid", ts: str = "timestamp", held_rows: int = HELD_ROWS,
                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows carrying their key's latest time; ties and copies are all kept, rows whose key or
    time is null go.

    The log is read once. The candidates are stored, their greatest times are one aggregate
    (partial first) and a checked-broadcast join on (key, time) picks the rows: no exchange of
    candidates under the bound, and a shuffle join, in which adaptive execution divides the
    rows of a hot key, beyond it."""
    kept = materialize(latest_candidates(df, key, ts, held_rows))
    greatest = kept.groupBy(key).agg(F.max(ts).alias(ts))
    return join_dimension(kept, greatest, [key, ts], max_broadcast_bytes=max_broadcast_bytes).select(*df.columns)
