"""Byte-level BPE by corpus-level merge replay.

All distinct pieces of a chunk of the corpus are laid out as one symbol sequence.  An
inverted index maps every token pair, named by the rank it merges into, to the positions
where it stands.  Ranks are taken in ascending order; each merge is applied at all its
positions at once and only the neighbours it touches get new index entries.  A piece thus
sees its merges in the order a piece-by-piece encoder would apply them.

Spark partitions the documents; a chunk is ``CHUNK`` bytes of one partition, so
memory is bounded by the chunk and nothing is shuffled.  Pieces already replayed by the task are
remembered up to ``MEMORY`` pieces.

Every row is encoded by itself, rows that repeat or have no id too; a null or empty text has
no ids and decodes to no bytes.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import heapq
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_tasks, ragged, stored
from .pieces import TextIds

NO_RANK = np.int64(1) << 40
#: Pieces a task remembers between chunks.
MEMORY = 100_000
#: Bytes of text whose new pieces are replayed together.
CHUNK = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """The merge table of a rank file, as arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.width = max(self.tokens) + 1
        keys, into = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    into.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.into = np.append(np.array(into, np.int64)[order], NO_RANK)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.into[at], NO_RANK)

    def encode_piece(self, piece: bytes) -> list[int]:
        """One piece, lowest rank first, leftmost of equals."""
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            best = min(range(len(parts) - 1),
                       key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], NO_RANK), i))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]


def replay(merges: Merges, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of every piece: (flat ids, number of ids of each piece)."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.int64), sizes
    sym = merges.byte_rank[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), sizes)
    n = len(sym)
    # Position n stands for "no neighbour".
    nxt = np.arange(1, n + 2)
    prv = np.arange(-1, n)
    ends = np.cumsum(sizes)
    ends = ends[sizes > 0]
    nxt[ends - 1] = n
    prv[ends[:-1]] = n
    prv[0] = prv[n] = n
    sym = np.append(sym, 0)
    alive = np.ones(n + 1, bool)
    here = np.full(n + 1, NO_RANK)
    inner = np.flatnonzero(nxt[:n] < n)
    here[inner] = merges.pair_rank(sym[inner], sym[inner + 1])
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def enter(positions: np.ndarray) -> None:
        found = here[positions]
        if len(positions) == 1:
            groups = ((int(found[0]), positions),)
        else:
            order = np.argsort(found, kind="stable")
            found, positions = found[order], positions[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            groups = zip(found[np.append(0, cuts)].tolist(), np.split(positions, cuts))
        for rank, at in groups:
            if rank in index:
                index[rank].append(at)
            else:
                index[rank] = [at]
                heapq.heappush(waiting, rank)

    first = inner[here[inner] < NO_RANK]
    if len(first):
        enter(first)
    odd: set[int] = set()
    while waiting:
        rank = heapq.heappop(waiting)
        entries = index.pop(rank)
        at = entries[0] if len(entries) == 1 else np.unique(np.concatenate(entries))
        at = at[alive[at] & (here[at] == rank)]
        if not len(at):
            continue
        if len(at) > 1:
            # Where a pair starts on the end of the one before, take every other one.
            chained = np.zeros(len(at), bool)
            chained[1:] = nxt[at[:-1]] == at[1:]
            if chained.any():
                start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        sym[at] = rank
        alive[gone] = False
        here[gone] = NO_RANK
        nxt[at] = after
        prv[after] = at
        prv[n] = n
        before = prv[at]
        inside = after < n
        here[at] = NO_RANK
        right = at[inside]
        here[right] = merges.pair_rank(sym[right], sym[after[inside]])
        left = before[before < n]
        here[left] = merges.pair_rank(sym[left], sym[nxt[left]])
        touched = np.concatenate((right, left))
        touched = touched[here[touched] < NO_RANK]
        if len(touched):
            early = touched[here[touched] <= rank]
            if len(early):  # a rank file whose merges are not in order: settle these apart
                odd.update(owner[early].tolist())
            enter(touched)
    left_over = np.flatnonzero(alive[:n])
    ids = sym[left_over]
    counts = np.bincount(owner[left_over], minlength=len(pieces))
    if odd:
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k in odd:
            parts[k] = np.array(merges.encode_piece(pieces[k]), np.int64)
            counts[k] = len(parts[k])
        ids = np.concatenate(parts)
    return ids, counts


class CorpusEncoder:
    """Encodes texts chunk by chunk; the pieces that are new in a chunk are replayed together."""

    def __init__(self, path: str):
        self.merges = Merges(load_ranks(path))
        self.texts = TextIds(self._replayed, MEMORY)

    def _replayed(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = [self.merges.ranks.get(p) for p in raw]  # a piece that is a token is that token
        rest = [k for k, w in enumerate(whole) if w is None]
        known = [k for k, w in enumerate(whole) if w is not None]
        ids, lens = replay(self.merges, [raw[k] for k in rest])
        counts = np.ones(len(raw), np.int64)
        counts[rest] = lens
        starts = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        flat[starts[known]] = [whole[k] for k in known]
        flat[ragged(starts[rest], lens)] = ids
        return flat, counts

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """int32 ids of each text of a string column; null is the empty text."""
        return self.texts.of(texts)


def _encoder(rank_file: str):
    return lambda: CorpusEncoder(public_tokenizers.path(rank_file))


def encode(docs: DataFrame, rank_file: str = "byte_bpe_multi_50k.tiktoken",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids.  ``rank_file`` is a file of the public vocabularies,
    found on each executor."""
    def run(enc: CorpusEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [x.astype("<u4").tobytes() for x in enc.encode(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())],
                                          names=["doc_id", "ids"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_tasks(rows, _encoder(rank_file), run, "doc_id long, ids binary", CHUNK)


def _decoded(merges: Merges, ids: np.ndarray) -> bytes:
    return b"".join(map(merges.tokens.__getitem__, ids.tolist()))


def decode(tokens: DataFrame, rank_file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """The input's (doc_id, ids) with ``decoded``: the bytes that the ids stand for."""
    def run(enc: CorpusEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [_decoded(enc.merges, np.frombuffer(v.as_py(), "<u4")) for v in batch.column(1)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                          names=["doc_id", "ids", "decoded"])
    return map_tasks(tokens.select("doc_id", "ids"), _encoder(rank_file), run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, rank_file: str = "byte_bpe_multi_50k.tiktoken",
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass: one Python worker a task holds the tables."""
    def run(enc: CorpusEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, out = [], []
        for x in enc.encode(batch.column(1)):
            ids.append(x.astype("<u4").tobytes())
            out.append(_decoded(enc.merges, np.frombuffer(ids[-1], "<u4")))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.binary()), pa.array(out, pa.binary())],
            names=["doc_id", "ids", "decoded"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_tasks(rows, _encoder(rank_file), run, "doc_id long, ids binary, decoded binary", CHUNK)


def token_digests(docs: DataFrame, rank_file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (after a round trip), stored."""
    return stored(round_trip(docs, rank_file).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")), "token-digests", batch=2 * CHUNK)
