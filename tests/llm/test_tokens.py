"""Merge replay and token files against the public tokenizer libraries."""

import base64
import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.orc as orc
import pytest
import tiktoken
from helpers import SF, docs_frame, edge_rows, null_id_rows, sf_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rankloom.llm import merge_replay, pieces, queries, token_files

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
TRICKY = ["", "  a  b\n\n c ", "日本語 ½ ² x", "\u0085x y\x1c z", "it's we'LL don't 's", "_a_b__ 12 345",
          "aaaaaaaa bbbbbbb ababab", "foo \nbar \t x", "😀👍🏽 é", "a" * 3000, "\n" * 50 + " x"]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_piece_by_piece(reference):
    enc = merge_replay.CorpusEncoder(RANKS)
    texts = TRICKY + [t for _, t in sf_docs()]
    for _ in range(2):  # new and remembered pieces
        assert [x.tolist() for x in enc.encode(pa.array(texts))] == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeinst xé\n'.1 "), max_size=40), max_size=6))
def test_replay_on_random_texts(texts):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    global _REF
    try:
        ref = _REF
    except NameError:
        ref = _REF = (tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}),
                      merge_replay.CorpusEncoder(RANKS))
    assert [x.tolist() for x in ref[1].encode(pa.array(texts, pa.string()))] == [ref[0].encode_ordinary(t) for t in texts]


def test_merges_out_of_order():
    """A rank file in which a merge makes a pair of a lower rank."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 400, b"ab": 500, b"abcd": 299, b"cd": 600}
    merges = merge_replay.Merges(ranks)
    words = [b"abcd", b"abab", b"bcd", b"aabbccdd", b"abcabcabcd", b""]
    ids, lens = merge_replay.replay(merges, words)
    got = [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])]
    assert got == [merges.encode_piece(w) for w in words]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2100), max_size=60))
def test_byte_classes_give_the_patterns_pieces(text):
    check_pieces([text, text + " a", "", text * 2])


def check_pieces(texts):
    ids = pieces.TextIds(lambda new: (np.arange(len(new)), np.ones(len(new), np.int64)), 10 ** 9)
    at, counts = ids._pieces(pa.array(texts, pa.string()))
    known = list(ids.number)
    got = [[known[k].decode() for k in part] for part in np.split(at, np.cumsum(counts)[:-1])]
    assert got == [pieces.split(t) for t in texts]


def test_pieces_of_awkward_columns():
    rng = random.Random(0)
    signs = list("ab é.!'\n\t 12 _-sédÿ×÷–’… \x85日🙂\x1c\x0b")
    for _ in range(1500):
        use = signs[:rng.choice([8, 14, len(signs)])]
        check_pieces(["".join(rng.choice(use) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 6))])
    assert pieces.TextIds(None, 5).of(pa.array([], pa.string())) == []
    assert [x.tolist() for x in pieces.TextIds(None, 5).of(pa.array([None, ""], pa.string()))] == [[], []]


def test_pieces_thin_out(reference, monkeypatch):
    monkeypatch.setattr(merge_replay, "MEMORY", 50)
    enc = merge_replay.CorpusEncoder(RANKS)
    texts = [t for _, t in sf_docs()[:40]]
    for t in texts + texts:
        assert enc.encode(pa.array([t]))[0].tolist() == reference.encode_ordinary(t)


def test_token_digests(spark, reference):
    rows = edge_rows() + [(20 + k, t) for k, t in enumerate(TRICKY)]
    got = {r["doc_id"]: tuple(r)[1:] for r in merge_replay.token_digests(docs_frame(spark, rows, extra=True)).collect()}
    for i, t in rows:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4")
        assert got[i] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                          hashlib.sha256((t or "").encode()).hexdigest())
    assert merge_replay.token_digests(docs_frame(spark, [])).count() == 0
    both = merge_replay.decode(merge_replay.encode(docs_frame(spark, rows)))
    assert {(r["doc_id"], bytes(r["decoded"]).decode()) for r in both.collect()} == {(i, t or "") for i, t in rows}


def crc_rows(rows):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start, out = 0, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_token_stream_matches_library(spark):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in queries.QUERIES["op1_token_orc"](spark, SF).collect()}
    assert got == crc_rows(sf_docs())


def test_token_stream_edges(spark):
    rows = [r for k, r in enumerate(edge_rows()) if k != 2] + [(30, "a <|endoftext|> b")]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in token_files.token_stream(docs_frame(spark, rows, extra=True)).collect()}
    assert got == crc_rows(rows)
    assert token_files.token_stream(docs_frame(spark, [])).count() == 0
    out = token_files.token_stream(docs_frame(spark, null_id_rows())).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [None, None, 1, 1] and out[0]["start"] == 0


def test_file_format(spark, tmp_path):
    path = str(tmp_path / "tokens")
    rows = [(k, f"text number {k} with a few words") for k in range(3000)]
    token_files.write_tokens(docs_frame(spark, rows).repartition(3), path)
    files = [f"{path}/{f}" for f in os.listdir(path) if f.endswith(".orc")]
    assert sum(orc.ORCFile(f).nrows for f in files) == 3000
    assert all(orc.ORCFile(f).row_index_stride == token_files.ROWS_PER_INDEX for f in files if orc.ORCFile(f).nrows)
    with open(max(files, key=os.path.getsize), "rb") as f:
        raw = f.read()
    assert raw[:3] == b"ORC"
    found = token_files.lookup(spark, path, [5, 2500])
    assert sorted(r["doc_id"] for r in found.collect()) == [5, 2500]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    both = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in both] == list(range(3000))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(both, both[1:]))
    assert all(r["ids"][-1] == 0 and len(r["ids"]) == r["n_tokens"] for r in both[:50])
