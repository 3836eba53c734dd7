"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_table

__all__ = ["read_table", "scratch_path", "fresh_name", "stored", "measured_joins", "discard", "slices", "give_back", "map_batches", "map_tasks", "texts_of",
           "is_held_out", "ragged", "text_rows"]


def fresh_name(taken: Iterable[str], base: str) -> str:
    """``base``, with underscores appended until it clashes with no column of the input."""
    low = {c.lower() for c in taken}
    while base.lower() in low:
        base += "_"
    return base


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"
BROADCAST, MEASURED_BROADCAST = (f"spark.sql.{part}autoBroadcastJoinThreshold" for part in ("", "adaptive."))
FILE_BYTES = 16 << 20  # shuffled bytes behind one file of a stored table, at least
BATCH_BYTES = 8 << 20  # handed to Python at once, at most (a row at least)


def stored(df: DataFrame, name: str, few: bool = False, batch: int = BATCH_BYTES) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: computed once, lineage
    cut, readable by every executor after any loss.

    The write's own shuffle files go when it is done, so disk holds one step's shuffles and
    not those of all steps; it is not cut into many small files; and Python gets its input in
    small batches (of ``batch`` bytes).  ``few`` is for tables of narrow rows, far smaller than the input: two
    files a core at most."""
    spark = df.sparkSession
    if few:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, name)
    before = {k: spark.conf.get(k) for k in (CLEANUP, ADVISORY, ARROW)}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(ADVISORY, str(max(in_bytes(before[ADVISORY]), FILE_BYTES)))
    spark.conf.set(ARROW, str(min(in_bytes(before[ARROW]), batch)))
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark broadcasts on its own only what it has shuffled and measured, up to the
    session's limit, and nothing by the size it expects.  That is scaled from the files' bytes
    and takes an array for one element: a table of histograms is tens of times larger in memory,
    and the driver would hold it.  ``F.broadcast`` holds as ever."""
    before = {k: spark.conf.get(k, None) for k in (BROADCAST, MEASURED_BROADCAST)}
    spark.conf.set(MEASURED_BROADCAST, before[MEASURED_BROADCAST] or spark.conf.get(BROADCAST))
    spark.conf.set(BROADCAST, "-1")
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterable[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes (a row at least), so that what a task
    builds per slice stays small however long the texts of a batch are."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, n * size // max(batch.nbytes, 1))
        for start in range(0, n, step):
            yield batch.slice(start, step)


def give_back() -> None:
    """Return freed memory to the system.

    Spark reuses its Python workers from step to step; what a task frees would otherwise stay
    in the worker's C heap, and every later step would add its own on top."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: its heap shrinks by its own rules


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str, size: int = 4 << 20) -> DataFrame:
    """``fn`` over Arrow batches, a slice at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size):
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
        give_back()
    return df.mapInArrow(run, schema)


def map_tasks(df: DataFrame, start: Callable[[], object], fn: Callable[[object, pa.RecordBatch], pa.RecordBatch | None],
              schema: str, size: int = 4 << 20) -> DataFrame:
    """``map_batches`` with what ``start`` makes for each task; it goes when the task ends, so
    workers that Spark reuses for later steps hold nothing of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in slices(batches, size):
            out = fn(state, batch)
            if out is not None and out.num_rows:
                yield out
        del state
        give_back()
    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> Iterator[str]:
    """Python strings of a string column, one at a time; null is the empty text."""
    for v in column:
        yield v.as_py() or ""


def text_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts empty; every other column is left behind."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def is_held_out(doc_id: str | Column) -> Column:
    """crc32(doc_id as text) mod 5 = 0; a null id counts as held out (never learned from)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Flat indices of the ranges [starts[i], starts[i] + lens[i])."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def byte_words(texts: pa.Array, inside: np.ndarray, lower: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The maximal runs of bytes that ``inside`` (a table of 256) marks, within each text of a
    string column, with ``lower`` (another one) applied: (words, where each starts, the
    texts' offsets, all bytes)."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    b = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    rows = offsets - offsets[0]
    word = inside[b]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = rows[:-1][rows[:-1] < rows[1:]]
    start[first] = word[first]
    starts = np.flatnonzero(start)
    # The word bytes alone, end to end; a word ends where the next one starts.
    kept = np.append(0, np.cumsum(word))
    ends = np.append(kept[starts], kept[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(lower[b[word]])])
    return words, starts, rows, b


#: A-Z become a-z, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def name_hash(text: str) -> int:
    """A 64-bit name that is the same in every process."""
    b = text.encode("utf-8", "surrogatepass")
    return (zlib.crc32(b) << 32) | zlib.crc32(b, 0x9E3779B9)
