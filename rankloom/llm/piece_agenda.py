"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is escaped (spaces become the meta symbol, one is put in front), cut into segments
that no piece reaches across (a run of meta symbols and what follows up to the next one), and
every distinct segment is encoded once: its adjacent symbol pairs that join into a piece wait
in an agenda ordered by the piece's score, equal scores by position; the best pair is joined,
its two neighbours make new pairs, until none is left.  Symbols that are no piece become their
bytes.

Short segments take their steps together: a row of an array holds the pair priorities of one
segment, and one step pops the best pair of every row.  Long ones have a heap of their own.

In every Arrow batch the ids of new segments and the decoded texts are compared with the
sentencepiece library; a difference is an error.  Spark partitions the documents, nothing is
shuffled, and memory is bounded by a slice of texts and ``MEMORY`` remembered segments.

Null and empty texts have no ids and decode to the empty text.  Rows that repeat an id or a
text, and rows without an id, each give their own row; other columns are left behind, whatever
their names.
"""

from __future__ import annotations

import heapq
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_tasks, ragged, stored
from .pieces import TextIds

META = "▁"
#: Kinds of pieces and of models in a model file (fixed values of its format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2
NEVER = np.int32(np.iinfo(np.int32).max)
#: Segments of up to so many symbols take their steps together, so many at a time.
SHORT, TOGETHER = 32, 16_384
#: Segments a task remembers between slices.
MEMORY = 250_000
#: Segments that the library is asked for as one text.
ASKED = 32
SLICE = 4 << 20


class PieceModel:
    """The tables of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        trainer, normalizer = proto.trainer_spec, proto.normalizer_spec
        kinds = [p.type for p in proto.pieces]
        if (trainer.model_type != MERGE_TYPE or not trainer.byte_fallback or normalizer.precompiled_charsmap
                or normalizer.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix
                or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only merge-type models with byte fallback, without text rules and own symbols")
        self.prefix = bool(normalizer.add_dummy_prefix)
        names = [p.piece for p in proto.pieces]
        self.size = len(names)
        self.byte_ids = np.zeros(256, np.int32)
        self.surface: list[bytes] = []
        self.is_byte = np.array([k == BYTE for k in kinds])
        for number, (name, kind) in enumerate(zip(names, kinds)):
            if kind == BYTE:
                self.byte_ids[int(name[3:5], 16)] = number
                self.surface.append(bytes([int(name[3:5], 16)]))
            elif kind == NORMAL:
                self.surface.append(name.replace(META, " ").encode())
            else:
                self.surface.append(b"" if kind == CONTROL else trainer.unk_surface.encode())
        self.surfaces = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_at = np.append(0, np.cumsum(list(map(len, self.surface))))
        self._tables({n: k for k, (n, kind) in enumerate(zip(names, kinds)) if kind == NORMAL},
                     [p.score for p in proto.pieces])

    def _tables(self, pieces: dict[str, int], scores: list[float]) -> None:
        #: No piece has a meta symbol after another sign: segments are encoded apart.
        self.apart = not any(META in p.lstrip(META) for p in pieces)
        symbols = dict(pieces)  # and the single characters that only longer pieces hold
        for p in pieces:
            for c in p:
                symbols.setdefault(c, len(symbols) + self.size)
        self.nothing = max(symbols.values()) + 1  # a character that no piece holds
        self.of_char = np.full(0x110000, self.nothing, np.int32)
        for s, number in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = number
        self.of_char[0x20] = self.of_char[ord(META)]
        rank = {s: k for k, s in enumerate(sorted({scores[k] for k in pieces.values()}, reverse=True))}
        self.priority = np.full(self.size, NEVER, np.int32)
        for number in pieces.values():
            self.priority[number] = rank[scores[number]]
        left, right, into = [], [], []
        for p, number in pieces.items():
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    into.append(number)
        self.width = self.nothing + 1
        keys = np.array(left, np.int64) * self.width + np.array(right, np.int64)
        # A table of open slots: a pair is at the slot its key names or in one of the next.
        self.bits = max(4, len(keys).bit_length() + 2)
        self.keys = np.full((1 << self.bits) + len(keys) + 1, -1, np.int64)
        self.into = np.zeros(len(self.keys), np.int32)
        self.ranks = np.full(len(self.keys), NEVER, np.int32)
        for k, (slot, key) in enumerate(zip(self._slots(keys).tolist(), keys.tolist())):
            while self.keys[slot] not in (-1, key):
                slot += 1
            self.keys[slot], self.into[slot], self.ranks[slot] = key, into[k], self.priority[into[k]]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(priority, joined piece) of symbol pairs; NEVER where they join into none."""
        key = left.astype(np.int64) * self.width + right
        at = self._slots(key)
        seen = self.keys[at]
        while True:
            other = np.flatnonzero((seen != key) & (seen >= 0))
            if not len(other):
                return self.ranks[at], self.into[at]  # an open slot has NEVER
            at[other] += 1
            seen[other] = self.keys[at[other]]

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def decoded_all(self, flat: np.ndarray, lens: np.ndarray) -> pa.Array:
        """``decoded`` of many lists of ids, laid end to end."""
        at = self.surface_at[flat]
        n = self.surface_at[flat + 1] - at
        raw = self.surfaces[ragged(at, n)]
        ends = np.append(0, np.cumsum(lens))
        edges = np.append(0, np.cumsum(n))[ends]
        firsts = ends[:-1][lens > 0]
        # Lists that open with a space lose it; those that open with ids of no text, or whose
        # bytes make no text, are decoded one by one.
        plain = bool((n[firsts] > 0).all())
        if plain and self.prefix:
            drop = firsts[(self.priority[flat[firsts]] < NEVER) & (raw[edges[:-1][lens > 0]] == 0x20)]
            keep = np.ones(len(raw), bool)
            keep[np.append(0, np.cumsum(n))[drop]] = False
            edges = edges - np.append(0, np.cumsum(~keep))[edges]
            raw = raw[keep]
        out = pa.Array.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw)])
        try:
            out.cast(pa.large_string())
        except pa.ArrowInvalid:
            plain = False
        if plain:
            return out.cast(pa.binary())
        return pa.array([self.decoded(x) for x in np.split(flat, ends[1:-1])] if len(lens) else [], pa.binary())

    def decoded(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that ids stand for; a byte that fits nowhere is U+FFFD."""
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        try:
            raw.decode()
        except UnicodeDecodeError:
            parts, run = [], b""
            for number in ids.tolist():
                if self.is_byte[number]:
                    run += self.surface[number]
                    continue
                parts += [_mended(run), self.surface[number]]
                run = b""
            raw = b"".join([*parts, _mended(run)])
        shown = next((k for k in ids.tolist() if self.surface[k] or self.is_byte[k]), None)
        return raw[1:] if self.prefix and shown is not None and self.priority[shown] < NEVER and raw[:1] == b" " else raw


def _mended(run: bytes) -> bytes:
    """Bytes as UTF-8, each that begins no whole character replaced."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                run[at:at + n].decode()
            except UnicodeDecodeError:
                continue
            out.append(run[at:at + n])
            at += n
            break
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


def heap_agenda(model: PieceModel, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One segment: (symbols left, where each starts), best pair first, leftmost of equals."""
    n = len(symbols)
    ranks, joined = model.pairs(symbols[:-1], symbols[1:])
    sym = symbols.tolist()
    nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    agenda = [(r, k, sym[k], sym[k + 1], j) for k, (r, j) in enumerate(zip(ranks.tolist(), joined.tolist())) if r < NEVER]
    heapq.heapify(agenda)
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def enter(a: int, b: int) -> None:
        pair = (sym[a], sym[b])
        if pair not in known:
            r, j = model.pairs(np.array(pair[:1]), np.array(pair[1:]))
            known[pair] = int(r[0]), int(j[0])
        r, j = known[pair]
        if r < NEVER:
            heapq.heappush(agenda, (r, a, *pair, j))

    while agenda:
        _, a, left, right, j = heapq.heappop(agenda)
        b = nxt[a]
        if not alive[a] or sym[a] != left or b >= n or sym[b] != right:
            continue  # one of the two has been joined since
        sym[a], alive[b], nxt[a] = j, False, nxt[b]
        if nxt[a] < n:
            prv[nxt[a]] = a
            enter(a, nxt[a])
        if prv[a] >= 0:
            enter(prv[a], a)
    at = np.flatnonzero(alive)
    return np.array(sym, np.int32)[at], at


def row_agendas(model: PieceModel, symbols: np.ndarray, chars: np.ndarray, lens: np.ndarray) -> tuple:
    """Segments in lockstep: rows of ``symbols`` and ``chars`` (the first character of each
    symbol) with ``lens`` used cells; returns the three when no pair is left."""
    width = symbols.shape[1]
    ranks = np.full(symbols.shape, NEVER, np.int32)
    joined = np.zeros(symbols.shape, np.int32)
    cell = np.arange(width)
    r, c = np.nonzero(cell[None, :] < lens[:, None] - 1)
    ranks[r, c], joined[r, c] = model.pairs(symbols[r, c], symbols[r, c + 1])
    rows = np.arange(len(lens))
    tables = (symbols, ranks, joined)
    if (symbols >= model.size).any():
        tables += (chars,)  # else no symbol needs its character again
    while True:
        best = ranks[rows].argmin(axis=1)  # the leftmost of equals
        found = ranks[rows, best] < NEVER
        rows, best = rows[found], best[found]
        if not len(rows):
            return symbols, chars, lens
        into = joined[rows, best]
        # The right symbol of the pair goes, the cells behind it move up.
        take = np.minimum(cell[None, :] + (cell[None, :] > best[:, None]), width - 1) + rows[:, None] * width
        for table in tables:
            table[rows] = table.ravel()[take]
        lens[rows] -= 1
        symbols[rows, best] = into
        last = best == lens[rows] - 1
        ranks[rows[last], best[last]] = NEVER
        ranks[rows, np.minimum(lens[rows] - 1, width - 1)] = NEVER
        a, k = rows[~last], best[~last]
        ranks[a, k], joined[a, k] = model.pairs(symbols[a, k], symbols[a, k + 1])
        a, k = rows[best > 0], best[best > 0]
        ranks[a, k - 1], joined[a, k - 1] = model.pairs(symbols[a, k - 1], symbols[a, k])


def encode_segments(model: PieceModel, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, number of ids of each segment)."""
    raw = b"".join(segments)
    chars = np.frombuffer(raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    heads = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    ends = np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))
    starts = heads[np.append(0, ends[:-1])] if len(segments) else ends
    lens = (heads[ends] - starts) if len(segments) else ends
    symbols = model.of_char[chars]
    counts, found = np.zeros(len(segments), np.int64), {}
    order = np.argsort(lens, kind="stable")
    short = order[lens[order] <= SHORT]
    for first in range(0, len(short), TOGETHER):
        part = short[first:first + TOGETHER]
        width = max(int(lens[part].max()), 1)
        used = np.arange(width)[None, :] < lens[part][:, None]
        table, signs = np.zeros(used.shape, np.int32), np.zeros(used.shape, np.int64)
        at = ragged(starts[part], lens[part])
        table[used], signs[used] = symbols[at], chars[at]
        table, signs, left = row_agendas(model, table, signs, lens[part].copy())
        used = np.arange(width)[None, :] < left[:, None]
        found[first] = (part, left, table[used], signs[used])
    for k in order[len(short):].tolist():
        own, at = heap_agenda(model, symbols[starts[k]:starts[k] + lens[k]])
        found[-1 - k] = (np.array([k]), np.array([len(own)]), own, chars[starts[k] + at])
    done = []
    for part, left, own, signs in found.values():
        ids, n = _with_bytes(model, own, signs)
        counts[part] = np.add.reduceat(np.append(n, 0), np.cumsum(left) - left) * (left > 0) if len(left) else 0
        done.append((part, ids))
    flat = np.zeros(int(counts.sum()), np.int32)
    to = np.cumsum(counts) - counts
    for part, ids in done:
        flat[ragged(to[part], counts[part])] = ids
    return flat, counts


def _with_bytes(model: PieceModel, symbols: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each symbol): symbols that are no piece become their bytes."""
    n = np.ones(len(symbols), np.int64)
    odd = np.flatnonzero(symbols >= model.size)
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars[odd].tolist()]
    n[odd] = list(map(len, raw))
    out = np.repeat(symbols, n)
    at = np.cumsum(n) - n
    out[ragged(at[odd], n[odd])] = model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, n


class PieceEncoder(TextIds):
    """Whole texts by their segments; each is encoded, and compared with the library, once
    while it is remembered."""

    def __init__(self, path: str, checked: bool = True):
        self.model, self.checked = PieceModel(path), checked
        super().__init__(self._new, MEMORY)

    def _new(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = encode_segments(self.model, segments)
        if self.checked:
            self._check(segments, flat, counts)
        return flat, counts

    def _check(self, segments: list[bytes], flat: np.ndarray, counts: np.ndarray) -> None:
        """Compare with the library's ids.  Segments that each open with a space and hold
        another sign are the same segments when they are asked for as one text."""
        own = int(self.model.prefix)  # the library puts that space in front itself
        joined = np.array([self.model.prefix and self.model.apart and s[:1] == b" " and not s.isspace() for s in segments], bool)
        rest = [s for s, j in zip(segments, joined.tolist()) if j]
        texts = [b"".join(rest[k:k + ASKED])[own:].decode("utf-8", "surrogatepass") for k in range(0, len(rest), ASKED)]
        theirs = np.array(list(chain.from_iterable(self.model.library.encode(texts, num_threads=1))), np.int32)
        same = np.array_equal(theirs, flat[np.repeat(joined, counts)])
        to = np.cumsum(counts) - counts
        for k in np.flatnonzero(~joined).tolist():
            if segments[k] == b" " and own:
                continue  # a space at a text's end; alone the library would see no text
            ids = self.model.library.encode(segments[k][own:].decode("utf-8", "surrogatepass"))
            same = same and ids == flat[to[k]:to[k] + counts[k]].tolist()
        if not same:
            raise ValueError("segments whose ids differ from the sentencepiece library's")

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all segments, number of segments of each text)."""
        texts = texts.cast(pa.large_string())
        if pc.any(pc.match_substring(texts, META)).as_py():
            texts = pc.replace_substring(texts, META, " ")
        if self.model.prefix:
            blank, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), blank,
                               pc.binary_join_element_wise(space, texts, blank))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        b = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        rows = offsets - offsets[0]
        if not len(b):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        start = np.zeros(len(b), bool)
        if self.model.apart:
            space = b == 0x20
            start[1:] = space[1:] & ~space[:-1]
        start[rows[:-1][rows[:-1] < rows[1:]]] = True
        starts = np.flatnonzero(start)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(b))),
                                                                       pa.py_buffer(b)]).dictionary_encode()
        return (self._numbers(coded.dictionary.to_pylist())[np.asarray(coded.indices)],
                np.diff(np.searchsorted(starts, rows)))

    def decode(self, ids: list[np.ndarray]) -> pa.Array:
        """The texts (a binary column of UTF-8) that lists of ids stand for."""
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate([np.zeros(0, np.int32), *ids])
        out = self.model.decoded_all(flat, lens)
        if self.checked:
            edges, numbers = np.append(0, np.cumsum(lens)).tolist(), flat.tolist()
            theirs = self.model.library.decode([numbers[a:b] for a, b in zip(edges[:-1], edges[1:])]) if ids else []
            if not pa.array([t.encode("utf-8", "surrogatepass") for t in theirs], pa.binary()).equals(out):
                raise ValueError("a decoded text differs from the sentencepiece library's")
        return out


def _encoder(model_file: str, checked: bool):
    return lambda: PieceEncoder(public_tokenizers.path(model_file), checked)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def encode(docs: DataFrame, model_file: str = "piece_bpe_32k.model", checked: bool = True,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text.  ``model_file`` is a file of the public
    vocabularies, found on each executor; ``checked`` compares with the library."""
    def run(enc: PieceEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), _lists(enc.of(batch.column(1)))], names=["doc_id", "ids"])
    return map_tasks(_texts(docs, id_col, text_col), _encoder(model_file, checked), run, "doc_id long, ids array<int>", SLICE)


def decode(tokens: DataFrame, model_file: str = "piece_bpe_32k.model", checked: bool = True) -> DataFrame:
    """The input's (doc_id, ids) with ``decoded``; null ids decode to the empty text."""
    def run(enc: PieceEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.array(x.as_py() or [], np.int32) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([*batch.columns, enc.decode(ids).cast(pa.string())], names=["doc_id", "ids", "decoded"])
    return map_tasks(tokens.select("doc_id", "ids"), _encoder(model_file, checked), run,
                     "doc_id long, ids array<int>, decoded string", SLICE)


def round_trip(docs: DataFrame, model_file: str = "piece_bpe_32k.model", checked: bool = True,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass."""
    def run(enc: PieceEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = enc.of(batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0), _lists(ids), enc.decode(ids).cast(pa.string())],
                                          names=["doc_id", "ids", "decoded"])
    return map_tasks(_texts(docs, id_col, text_col), _encoder(model_file, checked), run,
                     "doc_id long, ids array<int>, decoded string", SLICE)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def piece_digests(docs: DataFrame, model_file: str = "piece_bpe_32k.model") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256, after a checked round trip; stored."""
    return stored(round_trip(docs, model_file).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")), "piece-digests")
