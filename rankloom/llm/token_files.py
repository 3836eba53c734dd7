"""Token ids as ORC files, ordered by document.

Integer columns are run-length encoded by the format; every stripe carries row indexes
(min/max of each ``ROWS_PER_INDEX`` rows) and Bloom filters on ``doc_id``, so a reader
splits files by stripe and skips stripes and row groups that cannot hold an id.  A row has

* ``doc_id``, ``ids`` (with the end id) and ``n_tokens``;
* ``part`` and ``part_start``: the writing task and the ids that it wrote before.  ``part``
  ascends with ``doc_id``, so the position in the whole stream is ``part_start`` plus the
  totals of the earlier parts; no task sees more than its own part.

Texts are ranged by (doc_id, hash of the text), so even many rows of one id are spread.
Null text counts as empty and gets the end id alone; a null doc_id comes first, and rows that
repeat an id each have their own.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_batches, ragged, scratch_path, slices, text_rows
from .pieces import TextIds

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
ROWS_PER_INDEX = 1000
STRIPE_BYTES = 64 << 20
#: Pieces a worker remembers between batches.
MEMORY = 300_000
ASKED = 10_000  # pieces handed to the library at once


class _Encoder:
    """The tokenizers library, asked once per distinct piece.

    A byte-level tokenizer without a normalizer never merges across its pre-tokens, so the
    ids of a text are those of its pieces in order.  Any other tokenizer, and texts that
    hold one of its special strings, are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                         and not pre.get("add_prefix_space") and not spec.get("normalizer"))
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.n_bytes[number] = len(token)  # byte-level: a character stands for a byte
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.texts = TextIds(self._asked, MEMORY)

    def _asked(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces.  Those that open with a space are asked for as one text, since the
        pre-tokenizer parts them there again; the bytes of the tokens tell them apart."""
        opens = np.array([len(p) > 1 and p[0] == 32 and p[1] > 32 for p in new])
        lens, flat = np.zeros(len(new), np.int64), []
        at, rest = np.flatnonzero(opens), np.flatnonzero(~opens)
        for start in range(0, len(at), ASKED):
            part = at[start:start + ASKED]
            pieces = [new[k] for k in part.tolist()]
            ids = self._whole(b"".join(pieces).decode("utf-8", "surrogatepass"))
            cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(list(map(len, pieces)))) + 1
            lens[part] = np.diff(np.append(0, cuts))
            flat.append(ids)
        for start in range(0, len(rest), ASKED):
            part = rest[start:start + ASKED]
            texts = [new[k].decode("utf-8", "surrogatepass") for k in part.tolist()]
            for k, e in zip(part.tolist(), self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, np.int32)
                lens[k] = len(ids)
                flat.append(ids)
        order = np.append(at, rest)
        ids = np.zeros(int(lens.sum()), np.int32)
        ids[ragged((np.cumsum(lens) - lens)[order], lens[order])] = np.concatenate(flat)
        return ids, lens

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """int32 ids of each text of a string column without nulls."""
        whole = np.full(len(texts), not self.by_piece)
        for mark in self.special:
            whole |= np.asarray(pc.match_substring(texts, mark))
        rest = iter(self.texts.of(texts.filter(pa.array(~whole))))
        return [self._whole(texts[k].as_py()) if w else next(rest) for k, w in enumerate(whole.tolist())]


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def tokenised(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of the file schema, in ascending id order over ascending parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(public_tokenizers.path(tokenizer))
        part, done = TaskContext.get().partitionId(), 0
        for batch in slices(batches, 8 << 20):
            found = enc.encode(batch.column(1))
            lens = np.fromiter(map(len, found), np.int64, len(found)) + 1
            ends = np.cumsum(lens)
            flat = np.full(int(lens.sum()), end_id, np.int32)
            keep = np.ones(len(flat), bool)
            keep[ends - 1] = False
            if found:
                flat[keep] = np.concatenate(found)
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(lens), part, np.int32)),
                 pa.array(done + ends - lens), pa.array(lens),
                 pa.ListArray.from_arrays(offsets, pa.array(flat))],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"])
            done += int(lens.sum())

    spread = F.xxhash64("text")
    rows = (text_rows(docs, id_col, text_col).repartitionByRange(F.col("doc_id"), spread)
            .sortWithinPartitions(F.col("doc_id"), spread))
    return rows.mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, **how) -> None:
    """Encode ``docs`` into ORC files under ``path``."""
    (tokenised(docs, **how).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(ROWS_PER_INDEX)).option("orc.create.index", "true")
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``: all ids of the documents before (by id order)."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # a row per task
    before = F.coalesce(F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)),
                        F.lit(0))
    return (rows.join(totals.select("part", before.alias("base")), "part")
            .withColumn("start", F.col("base") + F.col("part_start")).drop("base"))


def lookup(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """The rows of a few ids; row indexes and Bloom filters skip the other stripes."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(list(doc_ids)))


def stream_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(3)
        values = np.asarray(lists.values).astype("<u4", copy=False)
        at = np.asarray(lists.offsets)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(at).astype(np.int64)),
             pa.array(crc, pa.int64())], names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    rows = map_batches(spark.read.schema(SCHEMA).orc(path).select("doc_id", "part", "part_start", "ids"),
                       run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    totals = (spark.read.schema(SCHEMA).orc(path).groupBy("part")
              .agg(F.sum("n_tokens").alias("total")))
    before = F.coalesce(F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)),
                        F.lit(0))
    return (rows.join(totals.select("part", before.alias("base")), "part")
            .select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_stream(docs: DataFrame, **how) -> DataFrame:
    """Write ``docs`` to a fresh folder of the shared scratch space and read the digests back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **how)
    return stream_digests(docs.sparkSession, path)
