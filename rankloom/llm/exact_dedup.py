"""Exact deduplication against a persistent digest index.

The index holds one row per distinct normalised text ever ingested (``digest``, ``keep_id``).
It is kept in generations: each batch that brings new digests adds one, a table of its own,
bucketed and sorted by digest with one file a bucket.  A new batch is reduced to one row per
digest and goes through a sort-merge anti-join with every generation; their rows are read in
the order they were written in, neither shuffled nor sorted again, so a batch costs a scan of
the index and a shuffle of itself.  Beyond ``MAX_GENERATIONS`` they are merged into one.  A
generation is written aside and appears by a rename, so a torn write is never read.

Only 32-byte digests and ids are shuffled, never texts, and a hot text is folded to one row
per task before the shuffle.

Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` became one space.
Null counts as empty, and the empty text is a text like any other.  Of equal texts the row
with the smallest id stays; rows without an id come last; of rows that repeat id and text,
exactly one stays.  Extra columns are kept or never read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fresh_name, scratch_path, stored

#: Rows (id and digest, 48 bytes each) broadcast at most; beyond, a shuffle join.
MAX_SHIPPED = 500_000
#: Digests of a bucket (40 bytes each) when a generation is written.
BUCKET_ROWS = 500_000
MAX_GENERATIONS = 8
INDEX_SCHEMA = "digest binary, keep_id long, batch long"
#: A bucketed scan is in bucket order only with this set (and one file a bucket).
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
WHITE_SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE_RUN, " ")


def text_digest(text: Column) -> Column:
    """sha256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


@dataclass
class DigestIndex:
    """A digest index: the generations under ``path``, folders ``<number>-<buckets>``.

    ``buckets`` of a generation come from its counted rows unless they are given."""

    spark: SparkSession
    path: str
    buckets: int | None = None

    @classmethod
    def open(cls, spark: SparkSession, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """The index at ``path``, empty if nothing is there; a fresh one under the shared
        scratch folder when no path is given."""
        return cls(spark, path or scratch_path(spark, "digest-index"), buckets)

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def generations(self) -> list[tuple[int, int]]:
        """(number, buckets) of every whole generation."""
        at, fs = self._files(self.path)
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(tuple(map(int, n.split("-"))) for n in names if n[0].isdigit())

    def _folder(self, generation: tuple[int, int]) -> str:
        return f"{self.path}/{generation[0]}-{generation[1]}"

    def rows(self) -> DataFrame:
        found = [self._folder(g) for g in self.generations()]
        reader = self.spark.read.schema(INDEX_SCHEMA)
        return reader.parquet(*found) if found else self.spark.createDataFrame([], INDEX_SCHEMA)

    @contextmanager
    def tables(self) -> Iterator[list[DataFrame]]:
        """The generations as bucketed tables, whose catalog entries go afterwards."""
        names, before = [], self.spark.conf.get(ORDERED)
        self.spark.conf.set(ORDERED, "true")
        try:
            for generation in self.generations():
                names.append("digest_index_" + uuid.uuid4().hex[:16])
                self._create(names[-1], self._folder(generation), generation[1])
            yield [self.spark.table(name) for name in names]
        finally:
            self.spark.conf.set(ORDERED, before)
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _create(self, name: str, path: str, buckets: int) -> None:
        self.spark.sql(f"""CREATE TABLE {name} ({INDEX_SCHEMA}) USING parquet
                           CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'""")

    def missing(self, digests: DataFrame, tables: list[DataFrame]) -> DataFrame:
        """The rows of ``digests`` whose digest no generation has."""
        for table in tables:
            digests = digests.join(table.select("digest").hint("merge"), "digest", "left_anti")
        return digests

    def add(self, digests: DataFrame, batch: int = 0) -> None:
        """Append the digests of one batch that the index does not have.

        ``digests``: (digest, keep_id), one row per digest.  An append that is run again
        after a failure finds its rows in the index and adds none twice."""
        # Stored first: otherwise the joins would move below the aggregation, and all copies of
        # a hot text would be shuffled into one bucket.
        digests = stored(digests, "batch-digests")
        with self.tables() as tables:
            new = stored(self.missing(digests, tables).select(
                "digest", F.col("keep_id").cast("long"), F.lit(batch).cast("long").alias("batch")), "new-digests")
        self._write(new)
        discard(digests, new)
        if len(self.generations()) > MAX_GENERATIONS:
            self.merge()

    def merge(self) -> None:
        """All generations as one."""
        old = self.generations()
        self._write(self.rows())
        for generation in old:
            at, fs = self._files(self._folder(generation))
            fs.delete(at, True)

    def _write(self, rows: DataFrame) -> None:
        n = rows.count()
        if not n:
            return
        buckets = self.buckets or max(self.spark.sparkContext.defaultParallelism, -(-n // BUCKET_ROWS))
        name = "digest_index_" + uuid.uuid4().hex[:16]
        aside = f"{self.path}/_{name}"
        try:
            (rows.repartition(buckets, "digest").sortWithinPartitions("digest")
                 .write.format("parquet").bucketBy(buckets, "digest").sortBy("digest").option("path", aside).saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        number = max((g for g, _ in self.generations()), default=-1) + 1
        at, fs = self._files(aside)
        to = self._files(self._folder((number, buckets)))[0]
        if not fs.rename(at, to):
            raise OSError(f"{to.toString()} is there already: two writers of one index")


def _first_rows(digests: DataFrame) -> DataFrame:
    """One row per digest: the id that stays, and how many rows carry the text."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_no"))
    return (digests.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("best.doc_id").alias("keep_id"),
                    F.col("best.row_no").alias("keep_row"), "group_size"))


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, row_no) of every row, computed once and stored."""
    return stored(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              text_digest(F.col(text_col)).alias("digest"),
                              F.monotonically_increasing_id().alias("row_no")), "digests")


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 index: DigestIndex | None = None, batches: int = 2) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The rows go into the index in ``batches`` slices of ascending id, as new data would
    arrive; each slice is anti-joined with what the earlier ones left.  With an index that
    already holds texts, their ``keep_id`` stands and no row of the batch is kept for them.
    """
    rows = digest_rows(docs, id_col, text_col)
    had_rows = index is not None and bool(index.generations())
    index = index or DigestIndex.open(docs.sparkSession)
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    cuts = [] if low is None else [low + (high - low + 1) * k // batches for k in range(1, batches)]
    edges = [None, *cuts, None]
    for k, (start, end) in enumerate(zip(edges[:-1], edges[1:])):
        part = rows
        if start is not None:
            part = part.filter((F.col("doc_id") >= start) | F.col("doc_id").isNull()
                               if end is None else F.col("doc_id") >= start)
        if end is not None:
            part = part.filter(F.col("doc_id") < end)
        index.add(_first_rows(part).select("digest", "keep_id"), batch=k)
    groups = _first_rows(rows).select("digest", "keep_row", "group_size")
    # Read by path: both sides are then shuffled by digest and adaptive execution can split
    # the partition of a hot text, which a bucketed scan would not allow.
    known = index.rows().select("digest", "keep_id")
    marked = rows.join(groups.join(known, "digest"), "digest")
    kept = F.col("row_no") == F.col("keep_row")
    if had_rows:
        kept = kept & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return marked.select("doc_id", "keep_id", "group_size", kept.alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept (see ``dedup_report``).

    Which id stays is read from the index, after the digests of ``docs`` went into it; with an
    index that already holds texts, their rows go unless they are the ones it names.  The ids
    and digests of the rows that go are joined against the rows; rows that repeat id and text
    are told apart only if there are any."""
    taken = docs.columns
    own_id, own_digest = fresh_name(taken, "digest_id"), fresh_name(taken, "digest")
    rows = digest_rows(docs, id_col, text_col)
    index = index or DigestIndex.open(docs.sparkSession)
    first = _first_rows(rows)
    index.add(first.select("digest", "keep_id"))
    known = index.rows().select("digest", "keep_id")
    # Of a text's rows only those that go, or repeat the id that stays, are of interest.
    named = first.select("digest", "keep_row", "group_size").join(known, "digest")
    shared = stored(rows.join(named, "digest").filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")) | (F.col("group_size") > 1))
                    .select("doc_id", "digest", "keep_id", "row_no", "keep_row"), "shared")
    losers = (shared.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct())
    repeats = (shared.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row_no") != F.col("keep_row"))))
    digested = docs.withColumn(own_id, F.col(id_col).cast("long")).withColumn(own_digest, text_digest(F.col(text_col)))
    on = digested[own_id].eqNullSafe(losers["gone_id"]) & (digested[own_digest] == losers["gone_digest"])
    small = losers.count() <= MAX_SHIPPED
    kept = digested.join(F.broadcast(losers) if small else losers, on, "left_anti")
    if not repeats.isEmpty():
        # Only the rows that repeat an id and a text are told apart, the others pass by.
        again = stored(repeats.select(F.col("doc_id").alias("again_id"), F.col("digest").alias("again_digest")).distinct(), "repeats")
        again = F.broadcast(again) if again.count() <= MAX_SHIPPED else again
        same = kept[own_id].eqNullSafe(again["again_id"]) & (kept[own_digest] == again["again_digest"])
        one = kept.join(again, same, "left_semi").dropDuplicates([own_id, own_digest])
        kept = kept.join(again, same, "left_anti").unionByName(one)
    return kept.select(*docs.columns)
