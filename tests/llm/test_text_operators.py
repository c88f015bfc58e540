"""Chat, decontamination, line dedup and the n-gram join against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from cliploom.llm import chat, decontam, linededup, ngramjoin
from cliploom.llm.common import Workspace
from cliploom.llm.components import connected
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


def docs(spark, rows, extra=()):
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], ", ".join([DOCS, *[f"`{c}` string" for c in extra]]))


# Chat


ODD = ["", "</s>", "a\\-b", "\\</s>\\\\", "<s>[INST] x [/INST]</s>", "<<SYS>>\n<</SYS>>", "<\\-/s>", "[INST", "\\", "ü<s>\n\n"]


def test_examples_read_back(spark):
    rows = [(1, i, ["user", "assistant", "system"][i % 3], t) for i, t in enumerate(ODD)] + [(2, 0, "a\nb\\</s>", ODD[4]), (2, 1, "assistant", None), (3, 0, None, "x")]
    examples = chat.prefix_target_examples(spark.createDataFrame(rows, TURNS))
    whole = examples.groupBy("conv_id").agg(F.max_by("formatted", "example").alias("w"))
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in whole.select("conv_id", chat.read_turns(F.col("w")).alias("t")).collect()}
    want = {}
    for c, _, role, t in rows:
        want.setdefault(c, []).append((role or "", t or ""))
    assert got == want
    for r in examples.collect():
        replies = [t for role, t in want[r["conv_id"]] if role == "assistant"]
        reply = r["formatted"][r["loss_start"] : r["loss_end"]]
        assert reply == "" or spark.range(1).select(chat.unescape(F.lit(reply))).first()[0] == replies[r["example"]]
        assert all(reply.count(c) == 0 for c in chat.CONTROLS)


def test_ties_nulls_and_empty_tables(spark):
    rows = [(None, None, "user", "b"), (None, None, "user", "a"), (1, 1, "assistant", "x"), (1, 1, "assistant", "x")]
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit(1)).withColumn("parts", F.lit(2))
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.digest(chat.prefix_target_examples(df)).collect()}
    assert got == {None: (2, 0), 1: (2, 2)}
    assert chat.digest(chat.prefix_target_examples(df.limit(0))).isEmpty()
    long = chat.digest(chat.prefix_target_examples(spark.createDataFrame([(1, 0, "user", "u" * 10), (1, 1, "assistant", "</s>y" * 100_000)], TURNS))).first()
    assert long["loss_chars"] == 500_000 and long["loss_sha256"] == hashlib.sha256(b"</s>y" * 100_000).hexdigest()


def test_conversation_of_thousands_of_turns(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(2_000)]
    examples = chat.prefix_target_examples(spark.createDataFrame(rows, TURNS))
    pieces = [f"<s>assistant\n{t}</s>" if role == "assistant" else f"<s>[INST] {role}\n{t} [/INST]</s>" for _, _, role, t in rows]
    upto = [0]
    for p in pieces:
        upto.append(upto[-1] + len(p))
    for r in examples.select("example", "loss_start", "loss_end", F.length("formatted").alias("n"), F.expr("substring(formatted, loss_start + 1, loss_end - loss_start)").alias("reply")).collect():
        assert r["n"] == upto[2 * r["example"] + 2] and r["reply"] == rows[2 * r["example"] + 1][3]
    assert examples.count() == 1_000 and examples.where("example = 999").first()["formatted"] == "".join(pieces)
    got = chat.digest(examples).first()
    assert got["n_turns"] == 2_000 and got["loss_sha256"] == hashlib.sha256("".join(t for _, _, role, t in rows if role == "assistant").encode()).hexdigest()


# Decontamination


def test_overlaps_survive_substitutions(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(500)]
    item = rng.choices(vocab, k=30)
    changed = [w if i not in (4, 13, 22) else "other" for i, w in enumerate(item)]
    noise = rng.choices(vocab, k=200)
    rows = [(1, " ".join([*noise[:50], *item, *noise[50:]])), (2, " ".join([*noise[:20], *changed, *noise[20:]])), (3, " ".join(noise)), (4, " ".join(item[:8])), (5, None), (6, ""), (None, " ".join(item).upper())]
    rows += [(10, "a b Who wrote this book? c"), (11, "who wrote that book"), (12, "tiny item words"), (13, "w " * 60000 + " ".join(item)), (1, rows[0][1])]
    items = [(7, " ".join(item)), (8, "tiny item words"), (9, None), (14, "Who wrote this book"), (14, "Who wrote this book"), (15, "q w e r t y u i o")]
    rows += [(16, "x q w e r t y u i o x"), (17, "x q w e r t y u i")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["doc_start"], r["n_words"], r["n_matches"]) for r in decontam.overlaps(docs(spark, rows, ("words", "item", "seed")), bench).collect()}
    assert got == {(1, 7): (50, 30, 30), (2, 7): (20, 30, 27), (None, 7): (0, 30, 30), (10, 14): (2, 4, 4), (13, 7): (60000, 30, 30), (16, 15): (1, 9, 9), (17, 15): (1, 8, 8)}
    kept = decontam.clean(docs(spark, rows, ("_hit",)), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 11, 12] and kept.columns == ["doc_id", "text", "_hit"]
    assert decontam.overlaps(docs(spark, rows).limit(0), bench).isEmpty()
    assert decontam.overlaps(docs(spark, rows), bench.limit(0)).isEmpty()


def needed(n):
    return n if n <= 4 else min(10, max(4, -(-3 * n // 4)))


def brute_overlap(doc, item, share=0.75):
    """n_matches, doc_start, n_words of the best stretch of any diagonal, by trying all."""
    best = None
    for diagonal in range(-len(item) + 1, len(doc)):
        at = [k for k, w in enumerate(item) if 0 <= diagonal + k < len(doc) and doc[diagonal + k] == w]
        found = [(b - a + 1, at[b] - at[a] + 1, at[a]) for a in range(len(at)) for b in range(a, len(at)) if b - a + 1 >= share * (at[b] - at[a] + 1)]
        if found:
            n, words, start = min(found, key=lambda x: (-x[0], x[1], x[2]))
            if n >= needed(len(item)) and (best is None or (-n, diagonal + start, words) < best):
                best = (-n, diagonal + start, words)
    return best and (-best[0], best[1], best[2])


def test_no_overlap_is_missed(spark):
    rng = random.Random(5)
    rows, items, want, made = [], [], {}, []
    # 0 to a quarter of the words substituted, and beyond
    for size, changes in ((4, 0), (4, 1), (5, 0), (5, 1), (6, 1), (6, 2), (7, 1), (8, 2), (9, 0), (9, 1), (9, 2), (9, 3), (11, 2), (10, 0), (10, 1), (12, 2), (12, 1), (13, 3), (15, 3), (17, 4), (20, 5), (25, 6), (30, 7), (30, 14)):
        item = [f"i{size}x{changes}x{k}" for k in range(size)]
        items.append((1000 * size + changes, " ".join(item)))
        for n in range(25):
            gone = {2} if (size, changes, n) == (12, 1, 0) else set(rng.sample(range(size), changes))
            doc = [f"n{k}" for k in range(rng.randint(0, 3))] + [f"c{k}" if k in gone else w for k, w in enumerate(item)] + ["n"] * rng.randint(0, 3)
            key = (len(rows), 1000 * size + changes)
            rows.append((key[0], " ".join(doc)))
            made.append(key)
            if found := brute_overlap(doc, item):
                want[key] = found
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_matches"], r["doc_start"], r["n_words"]) for r in decontam.overlaps(docs(spark, rows), bench).collect()}
    assert got == want and len(want) > 250
    # recall of passages with up to a quarter of their words substituted, of which enough match
    planted = {(doc, item) for doc, item in ((k, i) for k, i in made if i // 1000 > 4 and 4 * (i % 1000) <= i // 1000)}
    assert len(planted & set(got)) >= 0.9 * len(planted) > 100


def test_masks_hit_every_stretch():
    """Most of matches - 3 * mismatches over all patterns that no mask hits, by their last words."""
    best = {((), 0): 0}
    for _ in range(200):
        longer = {}
        for (tail, n), value in best.items():
            for match in (0, 1):
                t = (*tail, match)[-5:]
                if not any(len(t) > m[-1] and all(t[len(t) - m[-1] - 1 + p] for p in m) for m in decontam.MASKS):
                    key = (t, min(decontam.LEAST_MATCHES, n + match))
                    longer[key] = max(longer.get(key, -1000), value + (1 if match else -3))
        best = longer
        assert all(value < 0 for (_, n), value in best.items() if n == decontam.LEAST_MATCHES)


def test_masks_hit_every_short_item():
    """All patterns of matches in items that need fewer than LEAST_MATCHES."""
    masks = decontam.MASKS + decontam.SHORT_MASKS
    for n in range(5, 14):
        if needed(n) < decontam.LEAST_MATCHES:
            for at in itertools.combinations(range(n), n - needed(n)):
                assert any(all(i + p not in at for p in m) for m in masks for i in range(n - m[-1]))


def test_items_of_a_few_words(spark):
    bench = spark.createDataFrame([(1, "zeta"), (2, "alpha beta"), (3, "one two three"), (4, "one two three four")], "item_id long, text string")
    d = docs(spark, [(1, "Zeta."), (2, "x alpha beta"), (3, "alpha x beta"), (4, "so one two three"), (5, "one two three four"), (6, "")])
    got = {n: sorted((r["doc_id"], r["item_id"]) for r in decontam.overlaps(d, bench, shortest=n).collect()) for n in (1, 2, 3, 4)}
    assert got[4] == [(5, 4)] and got[3] == [(4, 3), (5, 3), (5, 4)] and got[2] == [(2, 2), *got[3]] and got[1] == [(1, 1), *got[2]]


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    bench = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(20)))], "item_id long, text string")
    d = docs(spark, [(k, " ".join(f"a{i}" for i in range(k))) for k in range(30)])
    want = sorted(map(tuple, decontam.overlaps(d, bench).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontam, "BROADCAST_WORDS", 0)
    assert sorted(map(tuple, decontam.overlaps(d, bench).collect())) == want and len(want) == 20
    assert sorted(r["doc_id"] for r in decontam.clean(d, bench).collect()) == list(range(10))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 25)  # of 34 seeds the first ones are frequent and few
    monkeypatch.setattr(decontam, "HOT", 18)
    frequent = decontam._met(d.select("doc_id", decontam._seeds(decontam.word_hashes(F.col("text")), decontam.MASKS)), bench.select("item_id", decontam._seeds(decontam.word_hashes(F.col("text")), decontam.MASKS)).withColumnRenamed("at", "item_at"))
    assert "Union" in frequent._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, decontam.overlaps(d, bench).collect())) == want


# Line dedup


def brute_lines(rows, least):
    """Later copies by comparing all runs."""
    seqs = []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        lines = [(n, x.strip(" \t\r\v\f")) for n, x in enumerate((t or "").split("\n"))]
        seqs.append((d, t, [(n, x) for n, x in lines if x]))
    first, gone = {}, {}
    for d, _, seq in seqs:
        for a in range(len(seq)):
            for b in range(a + 1, len(seq) + 1):
                run = tuple(x for _, x in seq[a:b])
                if sum(len(x.split()) for x in run) >= least:
                    if run in first:
                        kept, at = first[run]
                        begin = max(a, at + b - a) if kept == d else a
                        gone.setdefault(d, set()).update(n for n, _ in seq[begin:b])
                    else:
                        first[run] = d, a
    out = {}
    for d, t, seq in seqs:
        if t is None:
            out[d] = None
        elif d in gone and len(gone[d]) == len(seq):
            out[d] = ""
        else:
            out[d] = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(d, ()))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_runs_against_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    vocab = ["a b c", "d e", "f", "g h i j", "k", "", " l m "]
    rows = [(i, "\n".join(rng.choices(vocab, k=rng.randint(0, 9)))) for i in range(25)]
    rows += [(100, None), (101, ""), (None, rows[0][1]), (103, rows[3][1]), (104, "\n".join(["a b c"] * 7)), (105, "\n".join(["d e", "f g"] * 6))]
    monkeypatch.setattr(linededup, "HOT", (2000, 4, 0)[seed - 1])
    monkeypatch.setattr(linededup, "BROADCAST_LINES", (10, 10**6, 0)[seed - 1])
    out = linededup.remove_repeats(docs(spark, rows, ("_gone", "gone", "t")), 6)
    assert out.columns == ["doc_id", "text", "_gone", "gone", "t", "_lines", "_gone_"]
    assert {r["doc_id"]: r["text"] for r in out.collect()} == brute_lines(rows, 6)


def test_the_first_copy_stays_whole(spark):
    line = " ".join(f"w{i}" for i in range(20))
    got = linededup.remove_repeats(docs(spark, [(1, "\n".join([line] * 6))])).first()
    assert got["text"] == "\n".join([line] * 3) and got["_gone"] == 3


def test_line_dedup_edges(spark):
    same = docs(spark, [(1, "a b c d\nx"), (1, "a b c d\nx"), (1, "a b c d")])
    got = sorted((r["text"], r["_gone"]) for r in linededup.remove_repeats(same, 3).collect())
    assert len(got) == 3
    assert linededup.remove_repeats(same.limit(0), 3).isEmpty()
    long = docs(spark, [(1, "w " * 30000 + "\nq"), (2, "w " * 30000 + "\nr")])
    assert {r["doc_id"]: r["text"] for r in linededup.remove_repeats(long).collect()}[2] == "r"


# N-gram join


def brute_join(rows):
    sets = []
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((d, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        r = find(i)
        least[r] = min(least.get(r, (d is not None, d)), (d is not None, d), key=lambda x: (x[0], x[1] or 0))
    return sorted(((d, len(s), least[find(i)][1]) for i, (d, s) in enumerate(sets)), key=str)


def near_copies(rng, n_families, sizes, edits):
    vocab = [f"v{i}" for i in range(4000)]
    rows = []
    for size in sizes:
        for _ in range(n_families):
            base = rng.choices(vocab, k=size)
            rows.append(base)
            for e in edits:
                copy = list(base)
                for _ in range(int(e * size)):
                    copy[rng.randrange(len(copy))] = rng.choice(vocab)
                if rng.random() < 0.3:
                    copy = copy[: rng.randint(1, len(copy))]
                rows.append(copy)
    return [" ".join(r) for r in rows]


@pytest.mark.parametrize("sharing", [2, 100])
def test_links_against_brute_force(spark, monkeypatch, sharing):
    monkeypatch.setattr(ngramjoin, "MOST_SHARING", sharing)
    monkeypatch.setattr(ngramjoin, "SIDE", 3)
    rng = random.Random(9)
    texts = near_copies(rng, 4, (3, 6, 9, 14, 25, 60, 130, 300), (0.0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"u{k}x{i}" for i in range(60)) for k in range(40)]
    rows = [*enumerate(texts), (5000, None), (5001, ""), (5002, " \n "), (5003, texts[3]), (5004, texts[3].upper()), (None, texts[40]), (7, texts[7])]
    if sharing == 2:
        monkeypatch.setattr(ngramjoin, "BROADCAST_IDS", 0)
    rows.append((6000, " ".join(f"long{i % 9000}" for i in range(30000))))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngramjoin.components(docs(spark, rows, ("cls", "n"))).collect()), key=str)
    assert got == brute_join(rows)


def test_one_large_family(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "MOST_SHARING", 10)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for k in range(60):
        copy = list(base)
        copy[rng.randrange(80)] = f"z{k}"
        rows.append((k, " ".join(copy)))
    assert {r["component_id"] for r in ngramjoin.components(docs(spark, rows)).collect()} == {0}


def test_hot_shingles_that_are_no_component(spark, monkeypatch):
    """Short sets that share most of their few shingles, in several components, in groups that are split."""
    monkeypatch.setattr(ngramjoin, "MOST_SHARING", 3)
    monkeypatch.setattr(ngramjoin, "SIDE", 4)
    head = [f"h{i}" for i in range(9)]
    rows = [(k, " ".join([*head, *(f"t{k % 6}x{i}" for i in range(k % 4 + 2))])) for k in range(48)]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngramjoin.components(docs(spark, rows)).collect()), key=str)
    assert got == brute_join(rows)


def test_components_of_a_graph(spark, tmp_path):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7), (1, None), (None, None)]
    work = Workspace(spark, "graph")
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long"), work).collect()}
    root = {n: n for e in edges for n in e if None not in e and e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert connected(spark.createDataFrame([], "a long, b long"), work).isEmpty()
    work.close()


def test_join_of_nothing(spark):
    assert ngramjoin.components(docs(spark, [(1, "a")]).limit(0)).isEmpty()
    assert [tuple(r) for r in ngramjoin.components(docs(spark, [(1, "a b")])).collect()] == [(1, 1, 1)]
