"""Decontamination, chat rendering, the three classifiers and the pipeline."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from helpers import SF, docs_frame, edge_rows, null_id_rows, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.llm import chat_render, co_training, deobfuscate, language_id, queries, template_leaks

SF01 = "/root/testdata/sf0.01"

# ---- decontamination

ITEM = ("Yesterday morning Alice bought 12 apples and 3 kg of flour because Alice wanted to bake pies, "
        "and then she paid 40 dollars to the old baker near the bridge.")


def leaks(spark, rows, bench=((1, ITEM),), **how):
    b = spark.createDataFrame(list(bench), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in
            template_leaks.find_leaks(docs_frame(spark, rows, extra=True), b, **how).collect()}


def test_reparameterised_question(spark):
    other = (ITEM.replace("Alice", "Robert").replace("12", "71").replace("3 kg", "8 lb").replace("40", "95"))
    mixed = ITEM.replace("Alice bought", "Robert bought").replace("12", "7")  # Alice stays elsewhere: no consistent map
    got = leaks(spark, [(1, "Some words before. " + ITEM + " And after."), (2, "Intro. " + other), (3, mixed),
                        (4, "A clean text about apples and flour and the old baker by the bridge."), (5, None), (6, "")], strict=True)
    assert (1, 1) in got and (2, 1) in got and (4, 1) not in got
    assert not got[1, 1]["reworded"] and got[2, 1]["reworded"]
    assert (3, 1) not in got


def test_conflicting_slots_cost_their_windows_alone(spark):
    one = ITEM.replace("Alice bought", "Robert bought")  # one of two, the rest word for word
    equal = ITEM.replace("12 apples", "7 apples").replace("3 kg", "7 kg").replace("40", "95")  # 12 and 3 both become 7
    scattered = " ".join(f"{w} " + "zebra yonder" * (k % 3 == 2) for k, w in enumerate(ITEM.split()))
    rows = [(1, one), (2, equal), (3, scattered), (4, ITEM)]
    assert set(leaks(spark, rows, strict=True)) == {(4, 1)}
    got = leaks(spark, rows)
    assert set(got) == {(1, 1), (2, 1), (4, 1)}
    assert got[1, 1]["matched"] == got[4, 1]["matched"] - 3 and got[1, 1]["reworded"]  # three windows hold Robert
    assert got[2, 1]["matched"] == got[4, 1]["matched"] == got[4, 1]["n_windows"] and not got[4, 1]["reworded"]
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert {r["doc_id"] for r in template_leaks.without_leaks(docs_frame(spark, rows), b).collect()} == {3}


def test_shuffle_path_gives_the_same(spark):
    rows = table(SF, "documents").project("doc_id, text").fetchall()
    bench = table(SF, "benchmark").project("item_id, text").fetchall()
    a, b = leaks(spark, rows, bench), leaks(spark, rows, bench, max_shipped=0)
    assert a.keys() == b.keys() and {k: a[k]["matched"] for k in a} == {k: b[k]["matched"] for k in b}


@pytest.mark.parametrize("sf_dir", [SF, SF01])
def test_planted_passages_are_found_and_no_other(spark, sf_dir):
    rows = table(sf_dir, "documents").project("doc_id, text").fetchall()
    bench = table(sf_dir, "benchmark").project("item_id, text").fetchall()
    got = leaks(spark, rows, bench)
    whole = {(i, k) for i, t in rows for k, item in bench if item in t}
    assert whole <= set(got)
    lower = {i: " ".join(t.lower().split()) for i, t in rows}
    for i, k in set(got) - whole:  # anything else shares a long run of the item's words
        words = dict(bench)[k].lower().split()
        assert any(" ".join(words[a:a + 8]) in lower[i] for a in range(len(words) - 7))


def test_leak_edges(spark):
    assert leaks(spark, edge_rows()) == {}
    assert leaks(spark, []) == {} and leaks(spark, edge_rows(), bench=[(1, None), (2, "")]) == {}
    short = leaks(spark, [(1, "just three words"), (2, "nothing alike")], bench=[(9, "Just three words.")])
    assert set(short) == {(1, 9)}
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    df = docs_frame(spark, [(1, ITEM), (2, "clean"), (None, "clean too")], extra=True)
    out = template_leaks.without_leaks(df, b)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == {2, None}


def test_items_of_numbers_and_names(spark):
    """Too few literal words for a template: found where copied, and nowhere else."""
    bench = [(1, "12 34 56 78"), (2, "What is 12 + 34 - 5 * 7?"), (3, "Anna met Bob Carl Dora Emil today.")]
    rows = [(1, "before it 12 34 56 78 and after"), (2, "He asked: What is 12 + 34 - 5 * 7? Nobody knew."),
            (3, "so I asked what is 2010 2011 in roman letters"), (4, "numbers 99 88 77 66 in a row"),
            (5, "What is 99 + 88 - 7 * 6?"), (6, "It says that Anna met Bob Carl Dora Emil today.")]
    assert set(leaks(spark, rows, bench)) == {(1, 1), (2, 2), (6, 3)}


def test_rows_without_own_ids_stay_apart(spark):
    words = ITEM.split()
    half = [" ".join(words[:11]), " ".join(words[20:])]  # each well under 40 % of the item
    assert leaks(spark, [(None, half[0]), (None, half[1]), (7, half[0]), (7, half[1])]) == {}
    got = leaks(spark, [(None, ITEM), (7, ITEM), (7, half[0])])
    assert set(got) == {(None, 1), (7, 1)}


def brute_templates(text):
    """Words of a text: (lower case, as written, placeholder or None)."""
    out, before, opens = [], None, True
    for word in text.split():
        core = template_leaks._EDGES.sub("", word)
        if not core:
            continue
        low, what = core.lower(), None
        glued = template_leaks._GLUED.match(core)
        number = bool(template_leaks._NUMBER.match(core) or (glued and glued[2].lower() in template_leaks.UNITS))
        if number:
            what = "number"
        elif low in template_leaks.UNITS:
            what = "unit" if before == "number" else None
        elif len(core) > 1 and core[0].isupper() and not core.isupper() and not opens:
            what = "name"
        out.append((low, core, what))
        before, opens = what, word.rstrip("\"')]}”’»")[-1:] in (".", "!", "?", ":")
    return out


def brute_windows(words, size):
    least = template_leaks.MIN_LITERALS if size >= 5 else (size + 1) // 2
    for k in range(len(words) - size + 1):
        own = words[k:k + size]
        raw = sum(w[2] is None for w in own) < least
        key = ("raw", *[w[0] for w in own]) if raw else tuple((w[2], "") if w[2] else (None, w[0]) for w in own)
        yield k, raw, key, () if raw else tuple(w[1] for w in own if w[2])


def brute_leaks(rows, bench):
    """All alignments and all slots of every document and item."""
    out = {}
    for item_id, text in bench:
        item = brute_templates(text or "")
        size = min(5, len(item))
        own = list(brute_windows(item, size)) if size else []
        templates = sum(not w[1] for w in own)
        if templates >= min(2, len(own)):
            own = [w for w in own if not w[1]]
        for doc_id, doc in rows:
            lines = {}
            for pos, _, key, slots in brute_windows(brute_templates(doc or ""), size) if size else ():
                for at, _, item_key, item_slots in own:
                    if key == item_key:
                        lines.setdefault(pos - at, []).append((at, tuple(dict.fromkeys(zip(item_slots, slots)))))
            matched, reworded = set(), False
            for found in lines.values():
                every = [q for _, pairs in set(found) for q in pairs]
                vote = {q: (every.count(q), q[0] == q[1], q[1].encode()) for q in every}
                lost = {q for q in vote if any(o[0] == q[0] and vote[o] > vote[q] for o in vote)}
                stay = [(at, pairs) for at, pairs in found if all(a == b for a, b in pairs) or not lost & set(pairs)]
                at = {a for a, _ in stay}
                if not at or (any(a != b for _, pairs in stay for a, b in pairs) and len(at) < 2):
                    continue
                matched |= at
                reworded |= any(a != b for a, b in vote)
            if own and len(matched) / len(own) >= template_leaks.MIN_SHARE:
                out[doc_id, item_id] = (len(matched), len(own), reworded)
    return out


def test_leaks_match_brute_force(spark):
    rows = table(SF, "documents").project("doc_id, text").fetchall()
    bench = table(SF, "benchmark").project("item_id, text").fetchall()
    other = ITEM.replace("Alice", "Robert").replace("12", "71").replace("3 kg", "8 lb").replace("40", "95")
    bench += [(900, ITEM), (901, "12 34 56 78"), (902, "Pay 5 kg or 7 kg to Bob in Rome."), (903, None), (904, "of"), (905, "What is 3 4?")]
    rows += [(5000, other), (5001, ITEM + " " + other), (5002, "x 12 34 56 78 y"), (5003, "Pay 9 kg or 9 kg to Ann in Bonn."),
             (5004, ITEM.replace("Alice bought", "Robert bought")), (5005, "what is 3 4?"), (5006, "What is 5 6?"), (5007, "of all"),
             (5008, " ".join(ITEM.split()[:14])), (5009, None)]
    want = brute_leaks(rows, bench)
    for how in ({}, {"max_shipped": 0}):
        got = leaks(spark, rows, bench, **how)
        assert {k: (r["matched"], r["n_windows"], r["reworded"]) for k, r in got.items()} == want
    assert {(5000, 900), (5002, 901), (5004, 900), (5005, 905)} <= set(want)


# ---- chat rendering

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_chat(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), digest("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(said), digest(said))
    return out


def chat(spark, rows, **how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit(1))
    done = chat_render.conversation_digests(chat_render.format_conversations(df, **how))
    return {r["conv_id"]: tuple(r)[1:5] for r in done.collect()}


def test_chat_matches_brute_force(spark):
    rows = table(SF, "conversations").project("conv_id, turn, role, text").fetchall()
    extra = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.QUERIES["op6_chat_render"](spark, SF).collect()}
    assert got == brute_chat(rows + extra)


def test_chat_edges(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k} <|im_end|>\n<|im_start|>assistant\n") for k in range(150)]
    rows += [(2, 0, None, None), (2, 0, "assistant", ""), (2, None, "us\ner\\n", "\\"), (3, 5, "assistant", "b"),
             (3, 5, "assistant", "a"), (None, 0, "assistant", "x" * 100_000), (None, 1, "assistant", "")]
    assert chat(spark, rows) == brute_chat(rows)
    assert chat(spark, rows, block_turns=3) == brute_chat(rows)
    assert chat(spark, []) == {}


def test_rewriting_template_is_detected():
    def rewriting(messages):  # only the last answer keeps its text marked
        return "".join(f"[{r}:{t if k == len(messages) - 1 else t.upper()}]" for k, (r, t) in enumerate(messages))
    text, spans, rewrites = chat_render.render_block(rewriting, [("user", "hi"), ("assistant", "yo"), ("user", "bye")])
    assert text == "[user:HI][assistant:YO][user:bye]" and rewrites == 2
    assert [text[a:b] for _, a, b in spans] == ["HI", "YO", "bye"]
    kept, _, none = chat_render.render_block(chat_render.marked_turns, [("user", "hi"), ("assistant", "yo")])
    assert none == 0 and kept.endswith("yo<|im_end|>\n")
    twice = lambda ms: "".join(t + t for _, t in ms)
    assert chat_render.render_block(twice, [("user", "a")])[1] == []


def test_opening_is_written_once(spark):
    rows = [(1, k, "assistant", f"t{k}") for k in range(10)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    render = lambda ms: "<bos>" + chat_render.marked_turns(ms)
    out = chat_render.format_conversations(df, render, block_turns=4).orderBy("block").collect()
    assert "".join(r["formatted"] for r in out) == render([("assistant", f"t{k}") for k in range(10)])
    assert [r["formatted"][s["start"]:s["stop"]] for r in out for s in r["spans"]] == [f"t{k}" for k in range(10)]


def numbering():
    """A system prompt in the first turn, turn numbers, reasoning in the last answer alone."""
    def render(messages):
        return "".join(("[sys]" if k == 0 else "") + f"{k}:{r}:{t}" + ("(why)" if k == len(messages) - 1 else "") + ";"
                       for k, (r, t) in enumerate(messages))
    return render


def test_long_conversations_are_rendered_whole(spark):
    rows = [(c, k, "assistant", f"t{c}-{k}") for c in (1, 2) for k in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat_render.format_conversations(df, numbering()).collect()}
    assert chat_render.format_conversations(df, numbering()).count() == 2
    for c in (1, 2):
        said = [t for i, _, _, t in rows if i == c]
        assert out[c]["formatted"] == numbering()([("assistant", t) for t in said])
        assert out[c]["n_turns"] == 150 and out[c]["n_rewrites"] == 149
        assert [out[c]["formatted"][s["start"]:s["stop"]] for s in out[c]["spans"]] == said


def test_rewrites_across_block_borders_are_counted(spark):
    # turn numbers 0-7 and, after a gap, 20-23: blocks of four, and turn 7 has two rows
    rows = [(1, k, "assistant", f"t{k}") for k in [*range(8), *range(20, 24)]] + [(1, 7, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_render.format_conversations(df, numbering(), block_turns=4).collect()
    assert sum(r["n_rewrites"] for r in out) == len(rows) - 1
    marked = chat_render.format_conversations(df, block_turns=4).collect()
    assert sum(r["n_turns"] for r in marked) == len(rows) and not any(r["n_rewrites"] for r in marked)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "a\nb", "\\n", "</s>", ""]),
                          st.text(alphabet=st.sampled_from("<>[]/\\s|im_endSYINT \n"), max_size=30)), max_size=5))
def test_escape_round_trip(messages):
    text = chat_render.marked_turns(messages)
    assert chat_render.parse_turns(text) == messages
    for _, t in messages:
        assert chat_render.unescape(chat_render.escape(t)) == t
        for mark in ("<|im_start|>", "<|im_end|>", "</s>", "[INST]", "[/INST]"):
            assert mark not in chat_render.escape(t)


# ---- classifiers

def test_language_held_out_accuracy(spark):
    truth = dict(table(SF01, "documents").project("doc_id, lang").fetchall())
    rows = queries.QUERIES["op7_language_id"](spark, SF01).collect()
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert len(rows) == len(truth) and len(held) > 100
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    df = docs_frame(spark, [*edge_rows(), *null_id_rows(), (50, "123 !!"), (51, "été")], extra=True)
    got = {r["doc_id"]: r for r in language_id.languages(df).collect()}
    for i in (3, 4, 5, 50):
        assert got[i]["lang_pred"] == "und" and got[i]["score"] == 0
    assert got[51]["lang_pred"] == "en"  # the one language learned
    assert language_id.languages(docs_frame(spark, [])).count() == 0
    unlabelled = docs_frame(spark, edge_rows()).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.languages(unlabelled).collect()} == {"und"}


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    model = co_training.fit(docs, labels, learn=~held)
    got = co_training.score(docs, model).join(labels.filter(held), "doc_id").collect()
    right = np.mean([r["accepted"] == (r["quality"] == 1) for r in got])
    assert len(got) > 60 and right >= 0.95
    assert np.mean([r["accepted"] for r in got if r["quality"] == 1]) >= 0.97


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (7, 0), (3, 1), (None, 0), (99, 1), (9, None)], "doc_id long, quality int")
    df = docs_frame(spark, [*edge_rows(), *null_id_rows()], extra=True)
    got = co_training.quality(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (3, 4, 11))
    assert co_training.quality(docs_frame(spark, []), labels).count() == 0
    none = co_training.quality(df, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0, 1.0}
    kept = co_training.accepted(df, labels.limit(0))
    assert kept.columns == df.columns


def toxic_fixture(spark):
    rng = np.random.default_rng(1)
    vocab = ["river", "stone", "garden", "window", "summer", "market", "letter", "bridge", "candle", "forest"]
    bad = ["worthless", "stupid", "pathetic"]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(vocab, 30))
        toxic = i % 4 == 0
        if toxic:
            for w in rng.choice(bad, 2, replace=False):
                words[int(rng.integers(30))] = w
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_restores_obfuscated_words(spark):
    rows, labels = toxic_fixture(spark)
    clean = "river stone garden window summer market letter"
    probes = ["you w0rthless and st*pid market", "p a t h e t i c river and w o r t h l e s s stone",
              "worrrthlesss garden stuuupid", "p@th3t!c window wor.thl.ess", clean, "room 101 and 555 stones", "a a a a a",
              "river 5tone gard3n"]
    df = docs_frame(spark, rows + [(1000 + k, p) for k, p in enumerate(probes)])
    got = {r["doc_id"]: r for r in deobfuscate.toxicity(df, labels).collect()}
    assert [got[1000 + k]["predicted"] for k in range(len(probes))] == [1, 1, 1, 1, 0, 0, 0, 0]
    held = [i for i in range(400) if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == (i % 4 == 0) for i in held]) >= 0.97


def test_toxicity_edges(spark):
    rows, labels = toxic_fixture(spark)
    df = docs_frame(spark, [*edge_rows(), *null_id_rows()], extra=True)
    got = deobfuscate.toxicity(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    assert deobfuscate.toxicity(docs_frame(spark, []), labels).count() == 0
    assert all(r["predicted"] == 0 for r in deobfuscate.toxicity(df, labels.limit(0)).collect())


def test_lattice_reads():
    counts = np.ones((deobfuscate.LETTERS,) * 3)
    for w in ["idiot", "loser"] * 50:
        c = np.concatenate(([0, 0], deobfuscate.codes(w), [0]))
        np.add.at(counts, (c[:-2], c[1:-1], c[2:]), 1)
    model = deobfuscate.letter_model(counts)
    assert deobfuscate.restore("1d10t", model)[0] == "idiot"
    assert deobfuscate.restore("l.0.s.e.r", model)[0] == "loser"
    assert deobfuscate.restore("loooserrr", model)[0] == "loser"
    assert "idiot" in deobfuscate.restore("id*ot", model)


def trained(*texts):
    counts = np.ones((deobfuscate.LETTERS,) * 3) * 0.01
    for t in texts * 50:
        c = np.concatenate(([0, 0], deobfuscate.codes(t), [0]))
        np.add.at(counts, (c[:-2], c[1:-1], c[2:]), 1)
    return deobfuscate.letter_model(counts)


@pytest.mark.parametrize("written, word", [
    ("stu" + "u" * 60 + "pid", "stupid"), ("s" + "t" * 50 + "u" * 50 + "pid", "stupid"),  # longer than any limit
    ("sh111t", "shit"), ("b1111tch", "bitch"), ("f***ing", "fing"), ("i...d...i...o...t", "idiot"),
    ("1d1075", "idiots"), ("5h17", "shit"), ("sh1t!!!", "shit"), ("(un7", "cunt"), ("@$$", "ass"), ("id10**", "idio"),
    ("off...sh1t", "shit"), ("off.5h17.now", "shit"),  # separators between words
    ("y o u a r e a n i d i o t", "idiot"), ("y.o.u.a.r.e.a.n.1.d.i.0.t", "idiot"),
    (" ".join("youareanidiot" * 8), "idiot"), ("y o u a r e  a n i d i o t", "idiot"),
    ("y o u s t u u u u p i d", "stupid")])
def test_hidden_words_are_read(written, word):
    model = trained("you are an idiot", "idiots", "stupid you", "shit", "bitch", "fing", "cunt", "ass", "off now", "idio")
    assert word in deobfuscate.features("well " + written + " then", model, {})


def brute_readings(span, model):
    """The best readings from all paths through the lattice."""
    best = {}
    for path in itertools.product(*deobfuscate.lattice(span)):
        text, cost = "".join(out for out, _ in path), sum(cost for _, cost in path)
        c = [0, 0, *(int(k) for k in deobfuscate.codes(text)), 0]
        score = sum(float(model[x, y, z]) for x, y, z in zip(c, c[1:], c[2:])) - cost
        best[text] = max(score, best.get(text, -1e9))
    return [t for t, _ in sorted(best.items(), key=lambda kv: -kv[1])[:deobfuscate.BEST] if t]


def test_best_readings_are_exact():
    rng = np.random.default_rng(4)
    model = deobfuscate.letter_model(rng.integers(0, 60, (deobfuscate.LETTERS,) * 3) ** 3 / 1e3)
    for span in ["".join(rng.choice(list("a1*!e5#|"), 7)) for _ in range(20)] + [" a1*e!b", "a*1*#!*"]:
        assert deobfuscate.restore(span, model) == brute_readings(span, model), span
    flat = deobfuscate.letter_model(np.random.default_rng(4).integers(0, 60, (deobfuscate.LETTERS,) * 3))
    hard = "|#75*7o7t||!1a"  # its best reading is not among the 16 best paths of every step
    assert deobfuscate.restore(hard, flat) == brute_readings(hard, flat)


def test_long_spans_are_decoded_in_linear_time():
    assert len(deobfuscate.restore("ab1" * 20_000, trained("abi"))[0]) >= 40_000


def test_numbers_and_plain_words_are_not_spans():
    assert set(deobfuscate.suspicious("In 2010, 1,000 people. Paid $100 (all) +44 1.5 -- yes! ok... a - b")) == {"(all", "yes!"}


def test_co_training_learns_from_every_unlabelled_document(spark):
    """A source that no label names, one in a hundred of the unlabelled rows: its content is
    junk, and the metadata view learns that from the content view."""
    rng = np.random.default_rng(4)
    prose = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(400)]

    def good():
        return " ".join(rng.choice(prose, 60)) + "."

    def junk():
        return "click here now " * 20

    rows = [(k, good() if k % 2 else junk(), "en", "web" if k % 2 else "spam", None) for k in range(200)]
    rows += [(1000 + k, junk() if k % 100 == 0 else good(), "en", "rare" if k % 100 == 0 else "web", None) for k in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    view = lambda m, source: float(m.views[1].logit(co_training.metadata_view(source, "en", None, good())[None, :])[0])
    alone, taught = co_training.fit(docs, labels, rounds=0), co_training.fit(docs, labels)
    assert view(taught, "web") - view(taught, "rare") > 1 + abs(view(alone, "web") - view(alone, "rare"))
    # the same without the broadcast of the labelled ids
    import rankloom.llm.co_training as module
    was, module.MAX_SHIPPED = module.MAX_SHIPPED, -1
    try:
        again = co_training.fit(docs, labels)
    finally:
        module.MAX_SHIPPED = was
    assert np.allclose(again.views[0].w, taught.views[0].w)


# ---- pipeline

def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from rankloom.llm.common import read_table
    docs = read_table(spark, SF01, "documents")
    judged = {r["doc_id"] for r in co_training.quality(docs, read_table(spark, SF01, "labels")).filter("accepted").collect()}
    rows = [(i, t) for i, t in table(SF01, "documents").project("doc_id, text").fetchall() if i in judged]
    seen, kept = set(), []
    for i, t in sorted(rows):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        if key not in seen:
            seen.add(key)
            kept.append((i, t))
    near = five_word_groups(kept)
    kept = [(i, t) for i, t in kept if near[i] == i]
    bad = {i for i, _ in brute_leaks(kept, table(SF01, "benchmark").project("item_id, text").fetchall())}
    kept = {i: t for i, t in kept if i not in bad}
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF01).collect()}
    assert set(out) == set(kept) and bad
    assert all(out[i]["decoded_sha256"] == digest(t) for i, t in kept.items())


def five_word_groups(rows, words=5, percent=80):
    """doc_id -> smallest doc_id reached over links of five-word shingles; all pairs that share
    a shingle are compared."""
    sets, holders = {}, {}
    for i, t in rows:
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
        for x in sets[i]:
            holders.setdefault(x, []).append(i)
    root = {i: i for i in sets}
    pairs = {p for ids in holders.values() for p in itertools.combinations(sorted(ids), 2)}
    for u, v in sorted(pairs):
        common = len(sets[u] & sets[v])
        if root[u] != root[v] and 100 * common >= percent * (len(sets[u]) + len(sets[v]) - common):
            a, b = sorted((root[u], root[v]))
            root = {i: a if x == b else x for i, x in root.items()}
    return root


def test_near_dedup_stage_takes_five_words_and_eighty_percent(spark):
    import corpus_pipeline
    rng = np.random.default_rng(9)
    rows = []
    for g in range(12):
        base = [f"w{int(k)}" for k in rng.integers(0, 10**6, 200)]
        rows.append((10 * g, " ".join(base)))
        for c in range(1, 5):  # appended text, or single words changed
            other = base + [f"x{int(k)}" for k in rng.integers(0, 10**6, int(rng.integers(20, 70)))] if c % 2 else [
                f"y{int(rng.integers(10**6))}" if k in set(rng.integers(0, 200, 5).tolist()) else w for k, w in enumerate(base)]
            rows.append((10 * g + c, " ".join(other)))
    page = [f"p{k}" for k in range(1200)]
    rows += [(500, " ".join(page[:1000])), (501, " ".join(page)), (502, "a b c d"), (503, "a b c d"), (504, "a b c")]
    root = five_word_groups(rows)
    assert root[501] == 500 and len(set(root.values())) < len(rows)
    out = corpus_pipeline.near_copies(spark, docs_frame(spark, rows), SF)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(root.values()))


def test_stages_keep_columns(spark):
    import corpus_pipeline
    docs = docs_frame(spark, [*edge_rows(), *null_id_rows()], extra=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    empty = docs_frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
