"""Fill-in-the-middle, license scans and whitening against plain code on small fixtures."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from cliploom.llm import fim, licenses, queries, whitening
from pyspark.sql import functions as F

DOCS = "doc_id long, text string"
VECTORS = "vec_id long, embedding array<double>"


@pytest.mark.parametrize("name", ["op1_chat_examples", "op2_decontamination", "op5_line_dedup", "op12_licenses", "op13_fill_in_middle"])
def test_queries_against_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.queries()[name](spark, sf_dir)
    got = sorted(map(repr, (tuple(r) for r in df.collect())))
    assert got == sorted(map(repr, con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()))


# Fill-in-the-middle


def plain_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = re.findall(fim.UNIT, text)
    n = len(units)
    if not text or any(s in text for s in fim.SENTINELS) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if h4 % 100 < 80:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_fim_against_plain_code(spark):
    rng = random.Random(3)
    letters = " \t\n\r\x0b\x0cabé́\U0001f600 　\x85\xa0\x1c<>PSM"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    rows += [(None, "a b c"), (7, None), (8, ""), (9, "x <P> y"), (9, "x <P> y"), (10, " "), (11, "word " * 200_000), (12, "<" * 50 + "P>")]
    df = spark.createDataFrame(rows, DOCS).withColumns({"_ends": F.lit("e"), "fim_form": F.lit("f"), "_said": F.lit("s")})
    out = fim.transformed(df)
    assert out.columns[:5] == ["doc_id", "text", "_ends", "fim_form", "_said"]
    out = out.toDF("doc_id", "text", "e", "f", "s", "n", "form", "prefix", "middle", "output").withColumn("again", fim.restored(F.col("output"), F.col("form")))
    got = Counter(tuple(r[c] for c in ("doc_id", "n", "form", "prefix", "middle", "output", "again", "e", "f", "s")) for r in out.collect())
    assert got == Counter((i, *plain_fim(i, t), t or "", "e", "f", "s") for i, t in rows)
    assert {f for _, _, f, *_ in got} == {"plain", "psm", "spm"}
    assert fim.transformed(df.limit(0)).isEmpty()


def test_fim_parameters(spark):
    df = spark.createDataFrame([(1, "a-b-c")], DOCS)
    own = ("<|prefix|>", "<|suffix|>", "<|middle|>")
    row = fim.transformed(df, percent=100, spm_percent=0, pattern="[a-z]", sentinels=own).first()
    assert row["fim_units"] == 5 and row["fim_form"] == "psm" and all(row["fim_text"].count(s) == 1 for s in own)
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aa", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.transformed(df, sentinels=bad)


# Licenses


def plain_licenses(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    every, known = licenses.BASE + licenses.TEMPLATES, licenses.phrases(licenses.BASE + licenses.TEMPLATES)
    out = []
    for t, (label, _) in enumerate(every):
        own = [p for p in known if p.template == t]
        at = [[i - p.start for i in range(len(words)) if tuple(words[i : i + len(p.words)]) == p.words] for p in own]
        out += [(i + own[0].start, label, sum(len(p.words) for p in own)) for i in at[0] if all(any(abs(i - j) <= licenses.SLACK for j in other) for other in at[1:])]
    return len(words), sorted(out)


def test_licenses_against_plain_code(spark):
    rng = random.Random(5)
    whole = [text.replace("[", "").replace("]", "") for _, text in licenses.BASE + licenses.TEMPLATES]
    vocab = sorted({w for t in whole for w in t.split()}) + ["other", "Ünder", "ſ"]

    def drifted(t):
        words = t.split()
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            words.insert(rng.randrange(len(words) + 1), rng.choice(vocab))
        return " ".join(words)

    rows = []
    for i in range(120):
        parts = [rng.choice([str.upper, str, str.title])(drifted(rng.choice(whole))) if rng.random() < 0.5 else " ".join(rng.choices(vocab, k=9)) for _ in range(rng.randint(0, 5))]
        rows.append((i, rng.choice(["\n", ", ", "-"]).join(parts)))
    text_of = dict(zip([x for x, _ in licenses.BASE + licenses.TEMPLATES], whole, strict=True))
    rows += [(500, f"{text_of['bsd']}. " * 40), (501, None), (501, None), (None, "MIT License"), (502, ""), (503, "Known MIT License"), (504, "mit license " * 50_000)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"licenses": F.lit("l"), "_keys": F.lit("k")})
    out = licenses.scan(df)
    assert out.columns == ["doc_id", "text", "licenses", "_keys", "license_words", "licenses_"]
    got = [(r[0], r[1], r[2], r[3], r[4], [tuple(x) for x in r[5]]) for r in out.collect()]
    plain = {t: plain_licenses(t) for t in {t for _, t in rows}}
    assert sorted(got, key=repr) == sorted(((i, t, "l", "k", *plain[t]) for i, t in rows), key=repr)
    assert {label for _, found in plain.values() for _, label, _ in found} == {x for x, _ in licenses.BASE + licenses.TEMPLATES}
    assert licenses.scan(df.limit(0)).isEmpty()


def test_license_scan_needs_no_python_and_no_shuffle_of_texts(spark):
    plan = licenses.scan(spark.createDataFrame([(1, "MIT License")], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# Whitening


def plain_moments(rows):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in rows]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    z = [[n * a - b for a, b in zip(r, s, strict=True)] for r in x]
    return n, s, z


def test_limbs_are_exact():
    rng = random.Random(1)
    for bits in (3, 19, 20, 40, 61, 90, 200):
        rows = [[rng.randint(-(2**bits), 2**bits) for _ in range(5)] for _ in range(40)]
        z = np.array(rows, np.int64 if bits < 62 else object)
        parts = whitening.limbs(z)
        assert [[sum(int(p[i, j]) << whitening.LIMB * k for k, p in enumerate(parts)) for j in range(5)] for i in range(40)] == rows
        assert max(float(np.abs(p).max()) for p in parts) <= 2 ** (whitening.LIMB - 1)
        assert whitening.gram(z).tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(5)] for i in range(5)]
        assert whitening.squares(z) == [sum(c * c for c in r) for r in rows]


def test_blocks_of_rows_stay_exact():
    z = np.full((2 * whitening.ROWS + 1, 2), 2**61 - 1, np.int64)
    assert whitening.gram(z)[0, 1] == (2 * whitening.ROWS + 1) * (2**61 - 1) ** 2


def vectors(spark, rows):
    return spark.createDataFrame(rows, VECTORS)


@pytest.mark.parametrize("offset", [0.0, 3e6, 1e12])
def test_whitening_against_exact_integers(spark, offset):
    rng = np.random.default_rng(2)
    data = (rng.normal(size=(300, 12)) * np.linspace(1, 9, 12) @ rng.normal(size=(12, 12)) + offset).tolist()
    df = vectors(spark, list(enumerate(data)))
    model = whitening.fit(df)
    n, s, z = plain_moments(data)
    assert (model.n, model.sums) == (n, s)
    exact = np.array([[sum(r[i] * r[j] for r in z) / n**3 for j in range(12)] for i in range(12)])
    values, basis = np.linalg.eigh(exact)
    assert np.allclose(model.values, values[::-1][:8], rtol=1e-12) and model.trace == pytest.approx(np.trace(exact), rel=1e-14)
    assert np.allclose(np.abs(np.sum(model.components * basis.T[::-1][:8], 1)), 1, atol=1e-9)
    got = {r["vec_id"]: r for r in whitening.apply(df, model).collect()}
    centred = np.array([[c / n for c in r] for r in z])
    want = centred @ model.components.T / np.sqrt(model.values)
    for i, r in got.items():
        assert np.allclose(r["whitened"], want[i], atol=1e-9) and int(r["deviation"]) == sum(c * c for c in z[i])
    assert whitening.identity_error(df, model) < 1e-9
    dealt = whitening.fit(df.repartition(7).orderBy(F.rand(1)))
    assert np.array_equal(dealt.components, model.components) and np.array_equal(dealt.values, model.values)


def test_whitening_drops_and_keeps(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -2.0]), (1, [0.5, -2.0]), (None, [3.25, 1.0]), (4, [-1.0, 7.5])]
    bad = [(5, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, []), (10, [1.0]), (11, [1.0, 2.0, 3.0])]
    df = vectors(spark, good + bad).withColumns({"whitened": F.lit("w"), "_vector": F.lit("v"), "deviation": F.lit(None).cast("date")})
    model = whitening.fit(df)
    n, s, z = plain_moments([v for _, v in good])
    assert (model.n, model.dims, model.sums) == (n, 2, s)
    out = whitening.apply(df, model)
    assert out.columns == ["vec_id", "embedding", "whitened", "_vector", "deviation", "whitened_", "deviation_"]
    assert sorted((repr(r["vec_id"]), int(r["deviation_"])) for r in out.collect()) == sorted((repr(i), sum(c * c for c in r)) for (i, _), r in zip(good, z, strict=True))
    tall = whitening.by_component(whitening.apply(vectors(spark, good), model), model, "vec_id").collect()
    assert len(tall) == 8 and sum({r["component"]: r["explained"] for r in tall}.values()) == pytest.approx(1.0)


def test_whitening_without_variance_or_vectors(spark):
    same = vectors(spark, [(i, [1.0, 2.0]) for i in range(3)])
    model = whitening.fit(same)
    assert [r["whitened"] for r in whitening.apply(same, model).collect()] == [[None, None]] * 3 and whitening.identity_error(same, model) is None
    line = vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])
    model = whitening.fit(line)
    assert all(r["whitened"][0] is not None and r["whitened"][1] is None for r in whitening.apply(line, model).collect())
    assert whitening.identity_error(line, model) < 1e-12
    none = vectors(spark, [(1, None)])
    assert whitening.fit(none) is None and whitening.apply(none, None).isEmpty() and whitening.identity_error(none, None) is None
    assert whitening.by_component(whitening.apply(none, None), None, "vec_id").isEmpty()
    huge = vectors(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])
    assert len(whitening.apply(huge, whitening.fit(huge)).collect()) == 3


def test_whitening_query(spark, sf_dir):
    assert Path(f"{sf_dir}/embeddings.parquet").exists()
    rows = queries.op11_whitening(spark, sf_dir).collect()
    assert len(rows) == 8 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert max(r["identity_error"] for r in rows) < 1e-9 and {r["component"] for r in rows} == set(range(1, 9))
