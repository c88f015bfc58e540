"""The whole pipeline against a second, plain implementation of its five stages on a small corpus."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from cliploom.llm import toxicity
from cliploom.llm.common import label_table
from pyspark.sql import functions as F
from test_text_operators import brute_join, brute_lines, brute_overlap

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_toxicity(text, model):
    """The document score by forward and backward sums, word after word."""
    words = [w.lower() for w in re.findall(r"\w{1,40}", text or "")]
    trans, init = np.exp(model.chain.trans), np.exp(model.chain.init)
    emit = [np.exp(model.chain.scores([w])[0].astype(float)) for w in words]
    forward, backward = [], [np.ones(2)]
    for e in emit:
        a = (forward[-1] @ trans if forward else init) * e
        forward.append(a / a.sum())
    for e in emit[:0:-1]:
        b = trans @ (e * backward[-1])
        backward.append(b / b.sum())
    p = [(a * b)[1] / (a * b).sum() for a, b in zip(forward, backward[::-1])]
    total = sum(p)
    x = [1, math.log1p(total), math.log1p(1000 * total / max(1, len(p))), max(p, default=0)]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.weights))))


def plain_mix(rows, order):
    """rows: id, text, source; order: id to place. What a mix takes: whole copies of a source, then documents in their
    order until one does not fit, then the largest that fits and again in their order, until none fits; then so a second time."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    of = {}
    for i, _, s in rows:
        of.setdefault(s, []).append(i)
    sources = sorted(of, key=lambda s: (s is None, s or ""))
    held = {s: sum(size[i] for i in of[s]) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    full = set()
    while True:
        free = [s for s in sources if s not in full]
        left = sum(held.values()) - sum(3 * held[s] for s in full)
        unit = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if unit * weight[s] > 3 * held[s]}
        if not over:
            break
        full |= over
    out = {}
    for s in sources:
        target = 3 * held[s] if s in full else unit * weight[s]
        copies, left = divmod(round(target), held[s]) if held[s] else (0, 0)
        again, more = 1, set()

        def fits():
            return [i for i in of[s] if 0 < size[i] <= left and (i, again) not in more and copies + again <= 3]

        def in_order():
            nonlocal left
            for i in sorted(fits(), key=order.get):
                if size[i] > left:
                    return
                more.add((i, again))
                left -= size[i]

        for again in (1, 2, 3):
            in_order()
            while found := fits():
                largest = max(found, key=lambda i: (size[i], order[i][1]))
                more.add((largest, again))
                left -= size[largest]
                in_order()
        for i in of[s]:
            out[i] = (size[i], held[s], target, size[i] * (copies + sum(j == i for j, _ in more)))
    return out


def corpus(rng):
    """Documents of several lines with toxic words, copies, near copies, shared passages and benchmark items; the toxic
    ids; the items."""
    vocab = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(500)]

    def lines(n):
        return [rng.choices(vocab, k=rng.randint(6, 14)) for _ in range(n)]

    docs = {i: lines(rng.randint(3, 10)) for i in range(150)}
    toxic = set(range(3, 150, 5))
    for i in toxic:
        for _ in range(5):
            line = rng.choice(docs[i])
            line.insert(rng.randrange(len(line)), rng.choice(["vileword", "nasty", "rotten"]))
    passage = [rng.choices(vocab, k=10) for _ in range(6)]
    for i in (10, 11, 52, 90, 121):
        at = rng.randint(0, len(docs[i]))
        docs[i][at:at] = passage
    items = [rng.choices(vocab, k=n) for n in (3, 6, 12, 25, 40)]
    for k, i in enumerate((20, 31, 42, 54, 66, 75, 87, 99)):
        item = list(items[k % 5])
        if k >= 5 and len(item) > 10:
            item[len(item) // 2] = "substitute"
        docs[i].append(item)
    for i in (1, 2, 12, 24, 36):
        docs[200 + i] = [list(x) for x in docs[i]]  # exact copies
        # near copies: one long line, so that no run of lines repeats
        near = [w for x in docs[i] for w in x]
        near[rng.randrange(len(near))] = "changed"
        docs[300 + i] = [near]
    texts = {i: "\n".join(" ".join(x) for x in d) for i, d in docs.items()} | {400: None, 401: "", 402: " \n ", 403: "two words"}
    rows = [(i, t, "en", None if i % 11 == 7 else f"s{i % 4 if i % 3 else 0}", len(t or "")) for i, t in texts.items()]
    return rows, toxic, [(k, " ".join(x)) for k, x in enumerate(items)] + [(9, None)]


@pytest.mark.parametrize("seed", [1])
def test_pipeline_against_plain_code(spark, tmp_path, seed):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows, toxic, items = corpus(random.Random(seed))
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(150)], "doc_id long, quality int, toxic int")
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents = spark.read.parquet(str(tmp_path / "documents.parquet"))

    left = [len(rows)]
    model = toxicity.fit(documents.select("doc_id", "text"), label_table(labels, "toxic"))
    kept = [(i, t, s) for i, t, _, s, _ in rows if plain_toxicity(t, model) < pipeline.TOXIC]
    assert not toxic & {i for i, *_ in kept}
    left.append(len(kept))
    rest = brute_lines([(i, t) for i, t, _ in kept], 50)
    kept = [(i, rest[i], s) for i, t, s in kept if rest[i] != "" or t == ""]
    left.append(len(kept))
    least = {i: c for i, _, c in brute_join([(i, t) for i, t, _ in kept])}
    kept = [(i, t, s) for i, t, s in kept if least[i] == i]
    left.append(len(kept))
    tests = [re.findall("[a-z0-9]+", (x or "").lower()) for _, x in items]
    kept = [(i, t, s) for i, t, s in kept if not any(len(x) >= 4 and brute_overlap(re.findall("[a-z0-9]+", (t or "").lower()), x) for x in tests)]
    left.append(len(kept))
    assert all(a > b for a, b in zip(left, left[1:]))

    rank = F.xxhash64(F.lit(17), "doc_id")
    order = {r[0]: (r[1], r[2]) for r in documents.select("doc_id", F.pmod(F.shiftrightunsigned(rank, 20), F.lit(4096)), rank).collect()}
    want = plain_mix(kept, order)
    got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"]) for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i: (*x[:2], pytest.approx(x[2]), x[3]) for i, x in want.items()}
