"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import collections
import hashlib
import os

import duckdb

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(sf_dir: str, name: str):
    return duckdb.sql(f"SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")


def docs_frame(spark, rows, extra: bool = False):
    """Documents from (doc_id, text) pairs; ``extra`` adds columns whose names the operators
    use inside."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        for name in ("id", "digest", "token", "size", "row_no", "doc", "raw", "accepted", "window", "block", "root"):
            df = df.withColumn(name, F.lit("x"))
    return df


def edge_rows():
    """Nulls, empty, blank, short and long texts, ties and repeated rows."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from the big bad wolf tonight"
    long = " ".join(f"word{k}" for k in range(30_000))
    return [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, "   \n\t "), (6, "one"), (7, long), (8, long),
            (9, base + " again"), (10, "été 日本 😀 a\u0085b"), (11, ""), (12, "x" * 120), (13, "x" * 49)]


def null_id_rows():
    return [(None, "null id text that is long enough to have several words in it"), (None, None), (1, "a"), (1, "b")]


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 4:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + 4]) for k in range(len(w) - 3))


def brute_components(rows, percent=85):
    """doc_id -> (n_shingles, smallest doc_id reachable); candidates share any shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    seen = set()
    for ids in holders.values():
        for k, u in enumerate(ids):
            for v in ids[k + 1:]:
                if (u, v) in seen:
                    continue
                seen.add((u, v))
                common = len(sets[u] & sets[v])
                if 100 * common >= percent * (len(sets[u]) + len(sets[v]) - common):
                    a, b = find(u), find(v)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def brute_removal(rows, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        mark = bytearray(len(b))
        windows = [b[k:k + length] for k in range(max(0, len(b) - length + 1))]
        for k, w in enumerate(windows):
            if w in first and first[w] < i:
                mark[k:k + length] = b"\1" * length
        for w in windows:
            first.setdefault(w, i)
        spans = sum(1 for k in range(len(b)) if mark[k] and not (k and mark[k - 1]))
        kept = bytes(x for x, gone in zip(b, mark) if not gone)
        out[i] = (len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest())
    return out


def sf_docs(sf_dir: str = SF):
    return table(sf_dir, "documents").project("doc_id, text").fetchall()


def exists(sf_dir: str) -> bool:
    return os.path.isdir(sf_dir)
