"""Splitting text into the pieces that byte-level merges stay inside, and remembering their ids.

``split(text)`` gives every match of the public pre-token pattern.  ``TextIds`` finds the
same pieces for a whole column at once: texts of ASCII, Latin letters and common quotes and
dashes are cut by their byte classes, and equal pieces are folded by Arrow before Python
sees them; other texts, and those with English contractions, take the pattern.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex

from .common import ragged

_PATTERN = regex.compile(public_tokenizers.PATTERN)
LETTER, DIGIT, OTHER, SPACE, BLANK, CONTINUED, UNKNOWN = range(7)


def _byte_classes() -> np.ndarray:
    table = np.full(256, UNKNOWN, np.uint8)
    for b in range(128):
        c = chr(b)
        table[b] = (SPACE if c == " " else BLANK if c in "\t\n\v\f\r" else UNKNOWN if 0x1c <= b <= 0x1f else
                    LETTER if c.isalpha() else DIGIT if c.isdigit() else OTHER)
    table[0x80:0xC0] = CONTINUED
    table[0xC3:0xCA] = LETTER  # lead bytes of U+00C0 to U+024F
    return table


_CLASSES = _byte_classes()
_CONTRACTED = np.zeros(256, bool)
_CONTRACTED[list(b"stmdrvl")] = True


def split(text: str) -> list[str]:
    return _PATTERN.findall(text)


def byte_classes(b: np.ndarray) -> np.ndarray:
    """The class of every byte of UTF-8 text; UNKNOWN where only the pattern can tell."""
    cls = _CLASSES[b]
    nxt = np.append(b[1:], 0).astype(np.uint8)
    lead = np.flatnonzero((b >= 0xC3) & (b < 0xCA))
    after = nxt[lead]
    # × and ÷ are no letters; the last lead byte reaches beyond the range
    sure = ~((b[lead] == 0xC3) & ((after == 0x97) | (after == 0xB7))) & ~((b[lead] == 0xC9) & (after > 0x8F))
    cls[lead[~sure]] = UNKNOWN
    cls[np.minimum(lead + 1, len(b) - 1)] = cls[lead]
    lead = np.flatnonzero(b == 0xE2)
    lead = lead[lead + 2 < len(b)]
    third = b[lead + 2]
    mark = (b[lead + 1] == 0x80) & ((third == 0x93) | (third == 0x94) | (third == 0xA6) | ((third >= 0x98) & (third <= 0x9F)))
    for k in range(3):
        cls[lead[mark] + k] = OTHER
    cls[cls == CONTINUED] = UNKNOWN
    quote = np.flatnonzero(b == 0x27)
    cls[quote[_CONTRACTED[nxt[quote]]]] = UNKNOWN
    return cls


def piece_starts(b: np.ndarray, cls: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where pieces start in texts of known classes; ``rows`` are the offsets of the texts.

    A run of letters, digits or other signs is a piece, with one space before it; a run of
    white space is one up to its last character before such a run."""
    n = len(b)
    blank = cls >= SPACE
    start = np.zeros(n + 1, bool)
    start[1:n] = np.where(blank[1:], ~blank[:-1], (cls[1:] != cls[:-1]) & (cls[:-1] != SPACE))
    before_run = np.zeros(n, bool)
    before_run[:-1] = blank[:-1] & ~blank[1:]
    ends = rows[1:][rows[1:] > 0] - 1
    before_run[ends] = False  # white space at the end of a text stays one piece
    start[:n] |= before_run
    # A text's first character starts a piece whatever stands before it in the column; the
    # rules above looked across texts there, and nowhere else.
    start[rows[:-1]] = True
    return np.flatnonzero(start[:n])


class _Numbers(dict):
    """Pieces numbered as they are first asked for."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class TextIds:
    """Ids of whole texts from the ids of their pieces, which ``encode`` gives once for each
    piece (as UTF-8) while it is remembered.

    When more than ``limit`` pieces are held, the half that were used most often stays."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.encode, self.limit = encode, limit
        self._start(_Numbers(), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _start(self, number, ids, lens, used) -> None:
        self.number, self.ids, self.lens, self.used = number, ids, lens, used
        self.starts = np.cumsum(lens) - lens

    def _thin_out(self) -> None:
        pieces = list(self.number)
        keep = np.sort(np.argsort(-self.used, kind="stable")[:self.limit // 2])
        number = _Numbers()
        for k in keep.tolist():
            dict.__setitem__(number, pieces[k], len(number))
        self._start(number, self.ids[ragged(self.starts[keep], self.lens[keep])], self.lens[keep], self.used[keep] // 2)

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, pieces), np.int32, len(pieces))

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all pieces, number of pieces of each text)."""
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        b = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        rows = offsets - offsets[0]
        if not len(b):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        cls = byte_classes(b)
        odd = np.unique(np.searchsorted(rows, np.flatnonzero(cls == UNKNOWN), side="right") - 1)
        starts = piece_starts(b, cls, rows)
        edges = np.searchsorted(starts, rows)  # first piece of each text
        plain = np.ones(len(starts), bool)
        plain[ragged(edges[odd], edges[odd + 1] - edges[odd])] = False
        binary = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(b))),
                                                                        pa.py_buffer(b)])
        counts = np.diff(edges)
        if not len(odd):
            coded = binary.dictionary_encode()
            return self._numbers(coded.dictionary.to_pylist())[np.asarray(coded.indices)], counts
        coded = binary.filter(pa.array(plain)).dictionary_encode()
        found = self._numbers(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        slow = [[p.encode("utf-8", "surrogatepass") for p in split(b[rows[k]:rows[k + 1]].tobytes().decode("utf-8", "surrogatepass"))]
                for k in odd.tolist()]
        plain_counts, counts = counts.copy(), counts.copy()
        plain_counts[odd] = 0
        counts[odd] = [len(s) for s in slow]
        out = np.zeros(int(counts.sum()), np.int32)
        to = np.cumsum(counts) - counts
        out[ragged(to, plain_counts)] = found
        for k, s in zip(odd.tolist(), slow):
            out[to[k]:to[k] + len(s)] = self._numbers(s)
        return out, counts

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """int32 ids of each text of a string column; null is the empty text."""
        if len(self.number) > self.limit:
            self._thin_out()
        at, counts = self._pieces(texts.fill_null(""))
        new, self.number.new = self.number.new, []
        if new:
            ids, lens = self.encode(new)
            self.starts = np.append(self.starts, np.cumsum(lens) - lens + len(self.ids))
            self.lens = np.append(self.lens, lens)
            self.ids = np.append(self.ids, ids.astype(np.int32))
            self.used = np.append(self.used, np.zeros(len(new), np.int64))
        self.used += np.bincount(at, minlength=len(self.used))
        lens = self.lens[at]
        reach = np.append(0, np.cumsum(lens))
        flat = self.ids[ragged(self.starts[at], lens)]
        edges = reach[np.append(0, np.cumsum(counts))].tolist()
        return [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]
