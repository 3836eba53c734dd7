"""Digest index, byte-string removal and Jaccard join against brute force."""

import collections
import os
import random
import re

import duckdb
import numpy as np
import pytest
from helpers import SF, brute_components, brute_removal, docs_frame, edge_rows, null_id_rows, sf_docs
from pyspark.sql import functions as F

from rankloom.llm import exact_dedup, graph, jaccard_join, oracle_sql, prefix_doubling, queries, suffix_dedup


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dedup_matches_sql(spark):
    documents = duckdb.read_parquet(f"{SF}/documents.parquet")  # noqa: F841
    want = duckdb.sql(oracle_sql.SQL["op8_exact_dedup"]).fetchall()
    assert rows_of(queries.QUERIES["op8_exact_dedup"](spark, SF)) == sorted(map(tuple, want), key=repr)


def test_dedup_edges(spark):
    got = {}
    for r in exact_dedup.dedup_report(docs_frame(spark, edge_rows(), extra=True)).collect():
        got.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    assert got[1] == [(1, 3, True)] and got[2] == [(1, 3, False)] * 2
    assert got[3] == [(3, 3, True)] and got[4] == [(3, 3, False)] and got[11] == [(3, 3, False)]
    assert got[5] == [(5, 1, True)]  # one space is not the empty text
    assert got[7] == [(7, 2, True)] and got[8] == [(7, 2, False)]
    empty = exact_dedup.dedup_report(docs_frame(spark, []))
    assert empty.count() == 0


def test_dedup_null_ids_and_repeats(spark):
    got = rows_of(exact_dedup.dedup_report(docs_frame(spark, [*null_id_rows(), (None, "a"), (1, "a")]))
                  .select("doc_id", "keep_id", "group_size", "kept"))
    assert got.count((1, 1, 3, True)) == 1 and got.count((1, 1, 3, False)) == 1
    assert (None, 1, 3, False) in got and (None, None, 1, True) in got


def test_drop_copies_keeps_columns(spark):
    df = docs_frame(spark, [*edge_rows(), (None, "x y"), (None, "x y")], extra=True)
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    ids = sorted((r["doc_id"] for r in out.select("doc_id").collect()), key=repr)
    assert ids == sorted([1, 3, 5, 6, 7, 9, 10, 12, 13, None], key=repr)


def test_rows_that_repeat_id_and_text_are_told_apart_alone(spark, monkeypatch):
    df = docs_frame(spark, [(1, "a b"), (1, "a b"), (2, "a  b"), (3, "c"), (3, "d"), (None, None), (None, None)])
    for shipped in (500_000, 0):
        monkeypatch.setattr(exact_dedup, "MAX_SHIPPED", shipped)
        assert sorted((r["doc_id"], r["text"]) for r in exact_dedup.drop_copies(df).filter("doc_id is not null").collect()) == [
            (1, "a b"), (3, "c"), (3, "d")]
        assert exact_dedup.drop_copies(df).filter("doc_id is null").count() == 1


def test_index_persists(spark, tmp_path):
    path = str(tmp_path / "index")
    index = exact_dedup.DigestIndex.open(spark, path, buckets=4)
    first = exact_dedup.dedup_report(docs_frame(spark, [(5, "a b"), (6, "c")]), index=index)
    assert {(r["doc_id"], r["kept"]) for r in first.collect()} == {(5, True), (6, True)}
    again = exact_dedup.DigestIndex.open(spark, path)  # a new session knows the path alone
    second = exact_dedup.dedup_report(docs_frame(spark, [(1, "a  b"), (7, "d")]), index=again)
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in second.collect()} == {(1, 5, False), (7, 7, True)}
    assert again.rows().count() == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index")]
    os.makedirs(f"{path}/_torn")  # a write that was cut off
    assert exact_dedup.DigestIndex.open(spark, path).rows().count() == 3


def digests_of(spark, texts):
    return exact_dedup._first_rows(exact_dedup.digest_rows(docs_frame(spark, list(enumerate(texts))))).select("digest", "keep_id")


def test_index_side_is_neither_shuffled_nor_sorted(spark):
    index = exact_dedup.DigestIndex.open(spark, buckets=4)
    for k in range(3):  # three appends
        index.add(digests_of(spark, [f"text {k} {n}" for n in range(50)]))
    assert len(index.generations()) == 3 and index.rows().count() == 150
    new = digests_of(spark, [f"text {k} {n}" for k in range(4) for n in range(30)])
    with index.tables() as tables:
        missing = index.missing(exact_dedup.stored(new, "batch"), tables)
        plan = missing._jdf.queryExecution().executedPlan().toString()
        assert missing.count() == 30
    # Every scan of the index has a filter and then its merge join above it: the line before
    # the filter is the end of the join's other side.
    lines = plan.split("\n")
    scans = [k for k, line in enumerate(lines) if "FileScan parquet" in line and "digest_index" in line]
    assert plan.count("SortMergeJoin") == 3 and len(scans) == 3
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1, plan
    for k in scans:
        assert "Bucketed: true" in lines[k] and "Filter" in lines[k - 1] and "Scan" in lines[k - 2], plan


def test_generations_are_merged(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_GENERATIONS", 2)
    index = exact_dedup.DigestIndex.open(spark)
    for k in range(5):
        index.add(digests_of(spark, ["always", f"text {k}"]), batch=k)
        index.add(digests_of(spark, ["always"]), batch=k)  # run again after a failure
    assert len(index.generations()) <= 2 and index.rows().count() == 6


# ---- removal of repeated byte strings

def removal(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in suffix_dedup.removal_report(df).collect()}


def test_removal_matches_brute_force(spark):
    rows = sf_docs()
    assert removal(docs_frame(spark, rows)) == brute_removal(rows)


def test_removal_on_overlaps(spark):
    rng = random.Random(5)
    alphabet = "ab cd"
    pool = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (50, 51, 64, 90, 130, 300)]
    rows = []
    for i in range(60):
        parts = [rng.choice(pool)[rng.randrange(20):] if rng.random() < .7 else
                 "".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(rng.randrange(6))]
        rows.append((i, "".join(parts)))
    rows += [(100, "x" * 200), (101, "x" * 60), (102, "x" * 50 + "y" + "x" * 50), (103, "é" * 40), (104, "é" * 40 + "z")]
    assert removal(docs_frame(spark, rows)) == brute_removal(rows)


def overlapping_rows(seed=5):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab cd") for _ in range(n)) for n in (50, 51, 64, 90, 130, 300)]
    rows = [(i, "".join(rng.choice(pool)[rng.randrange(20):] for _ in range(rng.randrange(5)))) for i in range(30)]
    return rows + [(100, "x" * 200), (101, "x" * 60), (102, "x" * 50 + "y" + "x" * 50), (103, "é" * 40), (104, "é" * 40 + "z")]


@pytest.mark.parametrize("rows", [sf_docs()[:150], overlapping_rows(),
                                  [r for r in edge_rows() if r != (2, edge_rows()[1][1])]], ids=["given", "overlaps", "edges"])
def test_prefix_doubling_matches_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(prefix_doubling, "PART", 4096)
    df = suffix_dedup.removal_report(docs_frame(spark, rows, extra=True), find=prefix_doubling.repeated_spans)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()} == brute_removal(rows)


def test_prefix_doubling_ranks_are_those_of_sorted_strings(spark):
    rows = [(i, t.encode()) for i, t in overlapping_rows(seed=8)]
    holders = collections.defaultdict(set)
    for i, raw in rows:
        for p in range(len(raw) - 39):
            holders[raw[p:p + 40]].add(i)
    order = {s: k for k, s in enumerate(sorted(s for s, d in holders.items() if len(d) > 1))}
    want = {(i, p, order[raw[p:p + 40]], min(holders[raw[p:p + 40]])) for i, raw in rows
            for p in range(len(raw) - 39) if raw[p:p + 40] in order}
    texts = spark.createDataFrame(rows, "doc long, raw binary")
    assert {tuple(r) for r in prefix_doubling.ranked_positions(texts, 40).collect()} == want
    nothing = spark.createDataFrame([(1, None), (2, b""), (3, b"z" * 39)], "doc long, raw binary")
    assert prefix_doubling.repeated_spans(nothing, 40).collect() == []
    with pytest.raises(ValueError):
        prefix_doubling.offsets(15)


def test_removal_in_blocks_and_hot_names(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)
    rows = sf_docs()[:60]
    texts = docs_frame(spark, rows).select("doc_id", F.col("text").cast("binary").alias("raw")).withColumn("doc", F.col("doc_id"))
    spans = {r["doc"]: r["at"] for r in suffix_dedup.repeated_spans(texts).collect()}
    want = brute_removal(rows)
    for i, t in rows:
        raw = t.encode()
        import numpy as np
        at = spans.get(i, [])
        left = suffix_dedup.remove_spans(raw, np.array([a[0] for a in at]), np.array([a[1] for a in at])) if at else (raw, 0, 0)
        assert (len(raw), left[1], left[2]) == want[i][:3]


def test_removal_edges(spark):
    rows = [r for r in edge_rows() if r != (2, edge_rows()[1][1])]
    assert removal(docs_frame(spark, rows, extra=True)) == brute_removal(rows)
    assert removal(docs_frame(spark, [])) == {}
    text = "a text of more than fifty bytes that two rows of one id share in full"
    out = sorted(map(tuple, suffix_dedup.removal_report(docs_frame(spark, [(1, text), (1, text), (None, text)]))
                     .select("doc_id", "n_removed").collect()), key=repr)
    assert out == sorted([(1, 0), (1, len(text)), (None, len(text))], key=repr)


def test_removal_holds_one_steps_shuffles(spark, monkeypatch):
    """All anchors are shuffled in a step of their own, and what follows goes in passes by name."""
    rng = random.Random(5)
    shared = ["".join(rng.choices("abcdefgh ", k=90)) for _ in range(12)]
    rows = [(i, "".join(rng.choices("ijklmnop ", k=40)) + rng.choice(shared)[rng.randrange(20):] + str(i) * 9 + rng.choice(shared))
            for i in range(40)]
    rows.append((50, rows[0][1]))
    plans, there, most = [], set(), []

    def stored(df, name, *a, write=suffix_dedup.stored, **kw):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        out = write(df, name, *a, **kw)
        there.add(name)
        most.append(("digests" in there) + 0)
        return out

    def discard(*tables, drop=suffix_dedup.discard):
        for df in tables:
            there.discard(os.path.basename(df._stored_at).rsplit("-", 1)[0])
        drop(*tables)

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    monkeypatch.setattr(suffix_dedup, "discard", discard)
    monkeypatch.setattr(suffix_dedup, "PASS_ROWS", 1)
    monkeypatch.setattr(suffix_dedup, "MAX_PASSES", 3)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.removal_report(docs_frame(spark, rows)).collect()}
    want = brute_removal(rows)
    assert got == {i: v[1] for i, v in want.items()} and sum(got.values()) > 0
    names = [name for name, _ in plans]
    assert names.count("firsts") == names.count("placed") == names.count("windows") == 3
    assert not any("MapInArrow" in plan for name, plan in plans if name == "contexts")
    assert sum(most) == 2  # the digests are there until the copies are known


# ---- Jaccard join

def linked(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link_components(df).collect()}


def near_group(seed=3, n=120, words=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        t = list(base)
        for _ in range(rng.randrange(1, 4)):
            t[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    return rows


def test_join_matches_brute_force(spark):
    rows = sf_docs()
    assert linked(docs_frame(spark, rows)) == brute_components(rows)


def test_a_shingle_few_slices_report_is_split_all_the_same(spark, monkeypatch):
    """Every document of its own slice: no slice sees a shingle often enough to report it."""
    monkeypatch.setattr(jaccard_join, "SLICE", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    rows = near_group()
    prefixes = jaccard_join._prefixes(docs_frame(spark, rows).selectExpr("doc_id id", "text"), np.zeros(1, np.int64), np.zeros(1, np.int64), 85, 4)
    buckets = jaccard_join._buckets(jaccard_join.stored(prefixes, "p")).collect()
    assert max(r["parts"] for r in buckets) > 1
    held = collections.Counter((r["token"], r["block"]) for r in buckets)
    rows_of = collections.Counter(r["token"] for r in buckets)
    assert all(r["parts"] == rows_of[r["token"]] // 8 + 1 for r in buckets if rows_of[r["token"]] > 8)
    assert max(held.values()) < max(rows_of.values())
    assert linked(docs_frame(spark, rows)) == brute_components(rows)


@pytest.mark.parametrize("block, small, reported", [(1024, 32, 4), (16, 4, 2)])
def test_join_of_a_near_group(spark, monkeypatch, block, small, reported):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "REPORTED", reported)
    rows = near_group() + [(1000 + i, t) for i, t in near_group(4, 40, 30)]
    assert linked(docs_frame(spark, rows)) == brute_components(rows)


def test_join_edges(spark):
    rows = [r for r in edge_rows()]
    got = linked(docs_frame(spark, rows, extra=True))
    assert got == {i: v for i, v in brute_components(rows).items()}
    assert got[3] == (0, 3) and got[4] == (0, 4) and got[2] == got[1] and got[8] == got[7]
    assert linked(docs_frame(spark, [])) == {}
    out = rows_of(jaccard_join.link_components(docs_frame(spark, null_id_rows())))
    assert (1, 1, 1) in out and (None, 0, None) in out


def test_one_per_group(spark):
    rows = near_group(6, 30)
    df = docs_frame(spark, [*rows, (None, rows[0][1])], extra=True)
    out = jaccard_join.one_per_group(df)
    assert out.columns == df.columns
    want = {c for _, c in brute_components(rows).values()}
    assert {r["doc_id"] for r in out.collect()} == want | {None}


def test_histograms_are_not_broadcast_by_their_files_size(spark, monkeypatch):
    """Packed, they are a small part of what the driver would hold: 1,080 bytes a document."""
    plans, limits = {}, []
    limit = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"

    def stored(df, name, *a, write=jaccard_join.stored, **kw):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        limits.append([spark.conf.get(k, None) for k in limit])
        return write(df, name, *a, **kw)

    before, held = [spark.conf.get(k, None) for k in limit], spark.conf.get(limit[0])
    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = near_group(8, 60)
    assert linked(docs_frame(spark, rows)) == brute_components(rows)
    assert "SortMergeJoin" in plans["near"] and "BroadcastHashJoin" not in plans["near"]
    assert all(x == ["-1", held] for x in limits)  # what is measured has the session's limit
    assert [spark.conf.get(k, None) for k in limit] == before


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 101)], "u long, v long")
    got = {r["u"]: r["root"] for r in graph.components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100}
    assert graph.components(edges.limit(0)).count() == 0


def test_drop_copies_goes_by_the_index(spark):
    index = exact_dedup.DigestIndex.open(spark)
    exact_dedup.drop_copies(spark.createDataFrame([(1, "old text"), (2, "gone")], "doc_id long, text string"), index=index)
    later = spark.createDataFrame([(5, "old  text"), (6, "new"), (7, "new"), (1, "old text")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(later, index=index).collect()) == [1, 6]
