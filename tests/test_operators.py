"""The operators against small literal cases."""

from __future__ import annotations

import json
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from cliploom.functions import media, numbers, text
from cliploom.operators import buckets, dominance, manifests, models, ordering, records, review, spans, splits, tags, words
from cliploom.sources import jsonl, listing, sinks
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def clips(spark, *rows):
    return spark.createDataFrame([(a, b, list(t)) for a, b, t in rows], "clip_relpath string, source_id string, tags array<string>")


def picked(df):
    return [r["clip_relpath"] for r in df.orderBy("selection_rank").collect()]


def test_blocks_skip_labels_and_none(spark):
    said = "SCENE_OVERVIEW: Otter swims past\nVISUAL_DETAILS\ngreen hill\nDIALOGUE: None.\nOTHER_SOUNDS: rain falls"
    assert one(spark, text.blocks(F.lit(said))) == [["otter", "swims", "past"], ["green", "hill"], ["rain", "falls"]]


def test_bigrams_stay_within_blocks(spark):
    df = spark.createDataFrame([("red kite\nlow tide",), ("old mill",)], "caption string")
    assert {r[0] for r in words.bigram_counts(df).collect()} == {"red kite", "low tide", "old mill"}


def test_report_lines(spark):
    df = spark.createDataFrame([("otter swims\ngreen hill",), ("otter swims\ngreen hill\notter",)], "caption string")
    got = [r["line"] for r in words.report(df, 2).collect()]
    assert got == ["manifests=1 caption_rows=2 unique_words=4 unique_bigrams=2", "Top 2 words", "1. otter (3)", "2. green (2)", "Top 2 bigrams", "1. green hill (2)", "2. otter swims (2)"]
    empty = [r["line"] for r in words.report(df.limit(0), 2).collect()]
    assert empty.count("(none)") == 2


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ("VISUAL: A cat.\n- It `jumps`.\n```\nNone.", "A cat. It jumps. None."),
        ("SCENE_OVERVIEW:\n\nVISUAL:\n", None),
        ("1. one\n2. two", "one two"),
    ],
)
def test_normalize_caption(spark, said, want):
    assert one(spark, text.normalize_caption(F.lit(said))) == want


def test_slug_and_order(spark):
    df = spark.createDataFrame([("Épée & co",), ("!!",), ("-A  b-",), ("日本",), (None,)], "q string")
    assert [r[0] for r in df.select(text.slug(F.col("q"))).collect()] == ["epee-co", "search", "a-b", "search", "search"]
    assert one(spark, text.ordered_query(F.lit("cat order:score"))) == "cat order:score"
    assert one(spark, text.ordered_query(F.lit("cat"))) == "cat order:id_desc"


@pytest.mark.parametrize(("value", "want"), [("1.5", 1.5), ("-1", None), ("NaN", None), ("x", None), ("", None), ("0", 0.0)])
def test_safe_float(spark, value, want):
    assert one(spark, numbers.safe_float(F.lit(value))) == want


@pytest.mark.parametrize(("value", "want"), [("24/1", 24.0), ("0/0", None), ("N/A", None), ("30000/1001", 30000 / 1001), ("25", 25.0), (None, None)])
def test_fraction(spark, value, want):
    assert one(spark, numbers.fraction(F.lit(value).cast("string"))) == want


@pytest.mark.parametrize(("frames", "want"), [(1, 1), (12, 9), (16, 17), (25, 25), (5, 1), (6, 9)])
def test_quantized_frames(spark, frames, want):
    assert one(spark, numbers.quantized_frames(F.lit(frames))) == want


def test_times(spark):
    assert one(spark, numbers.frame_time(F.lit(2.0))) == 1.0
    assert one(spark, numbers.frame_time(F.lit(0.0005))) == 0.0
    assert (one(spark, numbers.preview_start(F.lit(4.0))), one(spark, numbers.preview_length(F.lit(4.0)))) == (1.0, 2.0)
    assert (one(spark, numbers.preview_start(F.lit(0.6))), one(spark, numbers.preview_length(F.lit(0.6)))) == (0.0, 0.6)


def test_plans(spark):
    assert [one(spark, media.supports_audio(F.lit(x).cast("array<string>"))) for x in (["text", " Audio "], ["video"], [], None)] == [True, False, False, False]
    assert one(spark, media.caption_probe(F.lit('{"format":{"duration":"3"},"streams":[{"codec_type":"audio"}]}')))["duration"] is None
    assert one(spark, media.caption_probe(F.lit('{"streams":[{"codec_type":"video","duration":"3","avg_frame_rate":"2","nb_frames":0}]}')))[:] == (3.0, False, 2.0, 0)
    assert [one(spark, media.default_relative(F.lit(p), F.lit("/in"))) for p in ("/in/a/b.mp4", "/into/b.mp4")] == ["a/b.mp4", "b.mp4"]
    assert one(spark, media.frame_plan(F.lit(96), F.lit(None).cast("double")))["frames"] == 48
    assert one(spark, media.audio_plan(F.lit(True), F.lit(True), F.lit(31.0))) == "clip audio exceeds 30s limit"
    assert one(spark, media.audio_plan(F.lit(True), F.lit(True), F.lit(30.0))) is None


def scores(spark, values, fps, duration):
    return spark.createDataFrame([("v", i, float(x), float(fps), float(duration)) for i, x in enumerate(values)], "video string, frame int, score double, fps double, duration double")


def pairs(df):
    return [(round(r["start"], 6), round(r["end"], 6)) for r in df.orderBy("start").collect()]


def test_unsafe_spans(spark):
    assert pairs(spans.unsafe_spans(scores(spark, [0, 0.4, 0, 0], 2, 2), 0.35, 0.0, 0.5)) == [(0.0, 1.5)]
    merged = spans.merged_spans(spans.unsafe_spans(scores(spark, [0, 0.4, 0.4, 0, 0.38, 0], 2, 4), 0.35, 0.5, 0.0))
    assert pairs(merged) == [(0.0, 3.0)]


def test_safe_spans(spark):
    s = scores(spark, [0, 0.5, 0, 0, 0.5, 0], 2, 3)
    videos = spark.createDataFrame([("v", 3.0), ("calm", 1.0)], "video string, duration double")
    got = spans.safe_spans(s, videos, 0.35, 0.25, 0.1, 0.0)
    assert pairs(got.where("video = 'v'")) == [(0.0, 0.25), (1.25, 1.75), (2.75, 3.0)]
    assert pairs(got.where("video = 'calm'")) == [(0.0, 1.0)]


def test_tiles(spark):
    safe = spark.createDataFrame([("v", 0.0, 0.5), ("v", 1.25, 2.0)], "video string, start double, end double")
    assert pairs(spans.tiled_fixed(safe, 0.5, 0.0)) == [(0.0, 0.5), (1.25, 1.75)]
    whole = spark.createDataFrame([("v", 0.0, 2.3)], "video string, start double, end double")
    assert [r["clip"] for r in spans.tiled_fixed(whole, 1.0, 0.25).orderBy("start").collect()] == ["v/clip_1_0_1000.mp4", "v/clip_2_1250_2250.mp4"]
    seeded = spans.tiled_seeded(whole, 3, 0.5, 1.0, 0.1)
    first, again = seeded.collect(), spans.tiled_seeded(whole, 3, 0.5, 1.0, 0.1).collect()
    assert first == again and all(0.5 <= r["end"] - r["start"] + 1e-9 <= 1.0 + 1e-8 for r in first)
    assert one(spark, spans.seed_column(7, F.lit("/a"))) == str(spans.video_seed(7, "/a"))


def test_balanced_subset(spark):
    got = splits.balanced_subset(clips(spark, ("a", "1", ["general", "fight"]), ("b", "2", ["general", "smile", "crowd"]), ("c", "3", ["general", "fight"])), 2)
    assert picked(got) == ["b", "a"]
    got = splits.balanced_subset(clips(spark, ("a", "1", ["general", "x", "y"]), ("b", "2", ["general", "x", "z"]), ("c", "3", ["general", "z"])), 2)
    assert picked(got) == ["a", "c"]
    assert got.where("selection_rank = 2").first()["balance_penalty"] == 7
    assert picked(splits.balanced_subset(clips(spark, ("b", "1", ["x"]), ("a", "2", ["x"])), 1)) == ["a"]
    with pytest.raises(ValueError):
        splits.balanced_subset(clips(spark, ("a", "1", ["x"])), 2)


def plain_greedy(rows, n):
    left, seen, out = list(rows), {}, []
    for _ in range(n):
        def key(r):
            t = set(r[2])
            return -sum(x not in seen for x in t), sum(2 * seen.get(x, 0) + 1 for x in t), sum(x in seen for x in t), r[0]

        best = min(left, key=key)
        left.remove(best)
        out.append(best[0])
        for x in set(best[2]):
            seen[x] = seen.get(x, 0) + 1
    return out


def test_balanced_subset_against_plain_greedy(spark, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [(f"c{i:03d}", f"s{i // 4}", rng.sample([f"t{k}" for k in range(15)], rng.randint(0, 5))) for i in range(60)]
    monkeypatch.setattr(splits, "BATCH", 7)
    assert picked(splits.balanced_subset(clips(spark, *rows), 30)) == plain_greedy(rows, 30)


def test_validation_subset(spark):
    rows = [("a", "s1", ["general", "x", "y"]), ("b", "s1", ["general", "z"]), ("c", "s2", ["general", "x"]), ("d", "s3", ["general", "y"])]
    got = splits.validation_subset(clips(spark, *rows), 2)
    assert [r["source_id"] for r in got.orderBy("selection_rank").collect()] == ["s1", "s1"]
    with pytest.raises(ValueError):
        splits.validation_subset(clips(spark, ("a", "s", ["x"]), ("b", "s", ["y"])), 1)


def plain_validation(rows, n, train_n=None):
    """By the definition, in fractions: every pick looks at every clip."""
    sizes, tags_of = {}, {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + 1
        for x in t:
            tags_of.setdefault(s, Counter())[x] += 1
    pool, left, seen, opened, out = Counter(x for _, _, t in rows for x in t), len(rows), Counter(), set(), []
    drafted = plain_greedy(rows, train_n) if train_n else []
    draft, hits = Counter(x for p, _, t in rows if p in drafted for x in t), Counter(s for p, s, _ in rows if p in drafted)
    todo = list(rows)
    for rank in range(1, n + 1):
        keys = {}
        for p, s, t in todo:
            fresh = s not in opened
            m = left - sizes[s] if fresh else left
            if m <= 0 or (fresh and train_n and m < train_n):
                continue
            target = {x: Fraction(c, train_n) for x, c in draft.items()} if train_n else {x: Fraction(pool[x] - (tags_of.get(s, {}).get(x, 0) if fresh else 0), m) for x in pool}
            mine = seen + Counter(t)
            far = sum((abs(Fraction(mine[x], rank) - target.get(x, 0)) for x in {*mine, *target}), Fraction(0))
            cost = (hits[s] if train_n else 0, sum((target.get(x, 0) for x in tags_of.get(s, {})), Fraction(0))) if fresh else (-1, 0)
            keys[p] = (far, *cost, s, -sum(x not in seen for x in t), sum(2 * seen[x] + 1 for x in t), int(fresh), sum(x in seen for x in t), p)
        best = min(keys, key=keys.get)
        p, s, t = next(r for r in todo if r[0] == best)
        todo.remove((p, s, t))
        out.append(p)
        if s not in opened:
            opened.add(s)
            left -= sizes[s]
            pool = pool - tags_of.get(s, Counter())
        seen.update(t)
    return out


@pytest.mark.parametrize(("train_n", "wide", "seed"), [(None, False, 1), (None, True, 2), (12, False, 3), (12, True, 4)])
def test_validation_subset_against_plain_greedy(spark, monkeypatch, train_n, wide, seed):
    rng = random.Random(seed)
    rows = [(f"c{i:03d}", f"s{min(i // 3, 9)}", rng.sample([f"t{k}" for k in range(12)], rng.randint(0, 5))) for i in range(48)]
    monkeypatch.setattr(splits, "BLOCK_CLIPS", 4)
    if wide:  # as with counts beyond 64 bits
        monkeypatch.setattr(splits, "WIDE", 0)
    assert picked(splits.validation_subset(clips(spark, *rows), 18, train_n)) == plain_validation(rows, 18, train_n)


def test_splits_of_odd_rows(spark):
    df = spark.createDataFrame([(None, None, ["x"]), ("a", None, None), ("a", "s", ["x", "y", "x"]), ("a", "s", ["x", "y"]), ("b", "r", [])], "clip_relpath string, source_id string, tags array<string>").withColumns({"row": F.lit(1), "clip_no": F.lit(2), "id": F.lit(3)})
    got = [(r["clip_relpath"], r["source_id"], r["new_tags_added"]) for r in splits.balanced_subset(df, 5).orderBy("selection_rank").collect()]
    assert sorted(got, key=repr) == sorted([("a", "s", 2), ("b", "r", 0), ("a", None, 0), (None, None, 0), ("a", "s", 0)], key=repr)
    assert splits.validation_subset(df, 4).count() == 4
    with pytest.raises(ValueError):
        splits.validation_subset(df, 5)
    assert splits.balanced_subset(df.limit(0), 0).isEmpty()


def test_split_is_source_disjoint(spark):
    rows = [(f"c{i}", f"s{i // 2}", [f"t{i % 3}", "general"]) for i in range(8)]
    train, val = splits.split(clips(spark, *rows), 2, 2)
    assert not {r["source_id"] for r in train.collect()} & {r["source_id"] for r in val.collect()}
    assert val.where("distribution_distance is null").isEmpty()
    with pytest.raises(ValueError):
        splits.split(clips(spark, *rows[:4]), 1, 3)


def test_prefix_distances_against_plain_sums(spark):
    import random

    rng = random.Random(3)
    names = [f"t{k}" for k in range(6)]
    ranked = [(i + 1, rng.sample(names, rng.randint(0, 4))) for i in range(12)]
    target = [(f"x{i}", "s", rng.sample(names, 2)) for i in range(5)]
    df = spark.createDataFrame(ranked, "rank long, tags array<string>")
    got = {r["rank"]: r["distribution_distance"] for r in tags.prefix_distances(df, clips(spark, *target)).collect()}
    for r, _ in ranked:
        f = {t: sum(t in x for _, x in ranked[:r]) / r for t in names}
        g = {t: sum(t in x[2] for x in target) / 5 for t in names}
        assert got[r] == pytest.approx(sum(abs(f[t] - g[t]) for t in names))


def test_tag_rules(spark):
    s = "array<string>"
    assert one(spark, tags.all_tags(F.array().cast(s), F.lit("general"), F.array(F.lit("a")), F.array(F.lit("b")))) == []
    assert one(spark, tags.all_tags(F.lit(None).cast(s), F.lit("general"), F.array(F.lit("a"), F.lit(" a ")), F.array(F.lit("b")))) == ["general", "a", "b"]
    got = one(spark, tags.hints(F.array(F.lit("general"), F.lit("x")), F.array().cast(s), F.array().cast(s)))
    assert (got["general"], got["character"]) == (["x"], [])


def test_buckets(spark):
    size = one(spark, buckets.projected_size(F.lit(1.0), 100))
    assert (size["width"], size["height"]) == (96, 96)
    f = spark.createDataFrame([(512, 288, 9, 10), (512, 512, 33, 10)], "width int, height int, frames int, weight long")
    assert buckets.listed(buckets.greedy(f, 512, 2)).first()[0] == "512x512x33;512x288x9"
    assert buckets.greedy(f.limit(0), 512, 2).isEmpty()


@pytest.mark.parametrize("seed", range(4))
def test_dominated_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = [0, 1, 37, 300][seed]
    p, q, asks, values = rng.integers(0, 9, n), rng.permutation(n), rng.random(n) < 0.5, rng.random((2, n))
    got = dominance.dominated(p, q, asks, values)
    for k in np.flatnonzero(asks):
        want = values[:, ~asks & (p < p[k]) & (q < q[k])].sum(axis=1)
        assert got[:, k] == pytest.approx(want)


def test_gains_by_sums_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", 50)
    rng = random.Random(8)
    # a third has one aspect, and many have equal frames
    sizes = {(1920, 1080, rng.randint(1, 40)) for _ in range(30)} | {(64 * rng.randint(4, 20), 64 * rng.randint(4, 20), rng.randint(1, 9)) for _ in range(60)}
    f = spark.createDataFrame([(*s, rng.randint(1, 9)) for s in sorted(sizes)], "width int, height int, frames int, weight long")
    points = buckets.projected(f, 512)
    near = buckets._with_distance(points, points.where("frames = 3").collect()[:2])
    got = {tuple(r[:3]): r["total"] for r in buckets._summed_gains(near, points).collect()}
    rows = near.collect()
    assert len(got) == len(rows) == len(sizes)
    for r in rows:
        far = [abs(math.log(r["width"] / r["height"] / (o["width"] / o["height"]))) + abs(math.log(r["frames"] / o["frames"])) for o in rows]
        want = sum(max(o["near"] - d, 0) * o["weight"] for o, d in zip(rows, far, strict=True))
        assert got[tuple(r[:3])] == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize(("held", "block", "pairwise"), [(256, 10_000, 10_000), (3, 7, 7), (3, 7, 100)])
def test_greedy_buckets_against_plain_greedy(spark, monkeypatch, held, block, pairwise):
    monkeypatch.setattr(buckets, "HELD", held)
    monkeypatch.setattr(buckets, "PAIRWISE", pairwise)
    monkeypatch.setattr(buckets, "BLOCK", block)
    rng = random.Random(4)
    rows = sorted({(64 * rng.randint(4, 20), 64 * rng.randint(4, 20), rng.randint(1, 90)) for _ in range(40)})
    rows = [(*r, rng.randint(1, 9)) for r in rows]
    f = spark.createDataFrame(rows, "width int, height int, frames int, weight long")
    bucket = {tuple(r[:3]): tuple(r[4:]) for r in buckets.projected(f, 512).select("width", "height", "frames", "weight", *buckets.BUCKET).collect()}

    def far(a, b):
        return abs(math.log(a[0] / a[1] / (b[0] / b[1]))) + abs(math.log(a[2] / b[2]))

    def ties(a):
        w, h, n = bucket[a[:3]]
        return w / h, n, w, h, a[0] / a[1], a[2], a[0], a[1]

    costs = {r: sum(far(r, o) * o[3] for o in rows) for r in rows}
    got = {tuple(r[:4]): r["cost"] for r in buckets.total_costs(f).collect()}
    assert all(got[r] == pytest.approx(c) for r, c in costs.items())
    picks = [min(rows, key=lambda r: (round(costs[r], 9), r[0] / r[1], r[2], r[0], r[1]))]
    while len(picks) < 12:
        near = {o: min(far(p, o) for p in picks) for o in rows}
        gain = {r: sum(max(near[o] - far(r, o), 0) * o[3] for o in rows) for r in rows if bucket[r[:3]] not in {bucket[p[:3]] for p in picks}}
        picks.append(min(gain, key=lambda r: (-round(gain[r], 9), *ties(r))))
    assert [tuple(r[:3]) for r in buckets.greedy(f, 512, 12).orderBy("pick").collect()] == [bucket[p[:3]] for p in picks]


def test_export_checks(spark, tmp_path):
    listing = spark.createDataFrame([("nested/a.mp4",), ("z.mp4",)], "media_path string")
    schema = "line_no long, clip_path string, caption string, status string"
    good = [(1, "z.mp4", "z", "captioned"), (2, "/in/train/nested/a.mp4", "a", "captioned")]
    rows, bad = manifests.export_rows(spark.createDataFrame(good, schema), listing, "train", "/in/train")
    assert bad.isEmpty() and [tuple(r) for r in rows.collect()] == [("a", "nested/a.mp4"), ("z", "z.mp4")]
    for row, rule in (((3, "z.mp4", "again", "captioned"), "duplicate"), ((3, "q.mp4", "q", "captioned"), "unknown clip"), ((3, "../../q.mp4", "q", "captioned"), "outside"), ((3, "z.mp4", " ", "captioned"), "empty caption"), ((3, "z.mp4", "z", "failed"), "status")):
        exported = manifests.export_rows(spark.createDataFrame([*good, row], schema), listing, "train", "/in/train")
        assert [r["rule"] for r in exported[1].collect()] == [rule]
        with pytest.raises(ValueError):
            sinks.write_export({"train": exported}, {"train": str(tmp_path / rule)})
        assert not (tmp_path / rule).exists()
    lost = manifests.export_rows(spark.createDataFrame(good[:1], schema), listing, "train", "/in/train")[1]
    assert [(r["rule"], r["detail"]) for r in lost.collect()] == [("missing caption", "nested/a.mp4")]


def log(spark, rows):
    return spark.createDataFrame(rows, "video_id string, status string, motion_score double, discovered_order long, seen_order long, line_no long")


def test_review(spark):
    states = review.latest_states(
        log(spark, [("a", "pending", 0.9, 1, None, 1), ("b", "pending", 0.2, 2, None, 2), ("c", "accepted", None, 3, None, 3), ("c", "pending", None, 0, None, 4), ("d", "pending", 0.1, 0, 7, 5)])
    )
    got = {r["video_id"]: (r["status"], r["discovered_order"], r["seen_order"]) for r in states.collect()}
    assert got == {"a": ("pending", 1, None), "b": ("pending", 2, None), "c": ("pending", 3, None), "d": ("pending", 4, 7)}
    queued = review.queue(states)
    assert [r["video_id"] for r in queued.orderBy("position").collect()] == ["d", "b", "a", "c"]
    assert review.start(states).first()[0] == "b"
    near = {r["video_id"]: (r["previous"], r["next"]) for r in review.neighbours(queued).collect()}
    assert near == {"d": ("d", "b"), "b": ("d", "a"), "a": ("b", "c"), "c": ("a", "c")}
    assert [r["video_id"] for r in review.preview_candidates(queued, 2, 3).collect()] == ["b", "a", "d"]


def test_motion(spark):
    df = spark.createDataFrame([("v", 0, [0.0, 0.0]), ("v", 1, [255.0, 0.0]), ("w", 0, [1.0])], "video_id string, frame int, luma array<double>")
    assert {r[0]: r[1] for r in review.motion_scores(df).collect()} == {"v": 0.5, "w": 0.0}


def test_manifest_reading(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('{"caption": "a"}\n\n[1]\nno json\n{"caption": "b"}\n')
    rows, bad = jsonl.read_strict(spark, str(path), "caption string")
    assert [tuple(r) for r in rows.orderBy("line_no").collect()] == [(1, "a"), (5, "b")]
    assert [(r["line_no"], r["rule"]) for r in bad.orderBy("line_no").collect()] == [(3, "not a JSON object"), (4, "invalid JSON")]
    assert jsonl.read_or_empty(spark, str(tmp_path / "none.jsonl"), "caption string").isEmpty()


def test_lines_are_numbered_across_splits(spark, tmp_path):
    said = {f"{k}.jsonl": ["" if i % 7 == 0 else f"{k} {i}" for i in range(400 * k)] for k in (1, 2)}
    for name, lines in said.items():
        (tmp_path / name).write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = jsonl.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [(name, i, x) for name, lines in said.items() for i, x in enumerate(lines, 1) if x]
    assert sorted((r["file"].rsplit("/", 1)[1], r["line_no"], r["line"]) for r in got) == sorted(want)


@pytest.mark.parametrize("wide", [64, 2])
def test_video_listing_against_a_walk(spark, tmp_path, monkeypatch, wide):
    monkeypatch.setattr(listing, "FOLDERS", wide)
    names = ["a.mp4", "sub/B.MKV", "sub/c.txt", "out/d.webm", "output/e.avi", "_hidden/f.mp4", "sub/.g.mov", "sub/_h.mp4", "sub/deep/er/and/er/i.mp4", ".mp4", "sub/none", "sub!/j.mp4", "s p/k%20.mp4"]
    for k, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * (k % 3))  # empty ones, too
    (tmp_path / "empty").mkdir()
    (tmp_path / "sub/round").symlink_to(tmp_path)
    out = tmp_path / "out"
    walked = [f for f in tmp_path.rglob("*") if f.is_file() and f.suffix.lower() in media.VIDEO_TYPES and out not in f.parents and "round" not in f.parts]
    want = [(str(f), str(f.relative_to(tmp_path)), f.stat().st_size) for f in sorted(walked)]
    assert len(want) == 9
    assert [tuple(r) for r in listing.ordered_videos(spark, str(tmp_path), (f"{out}/",)).collect()] == want
    assert listing.videos(spark, str(tmp_path / "empty")).isEmpty()
    assert listing.videos(spark, str(tmp_path), (str(tmp_path),)).isEmpty()


def test_feed(spark, tmp_path):
    page = '<posts><post id="{}" file_ext="{}" file_url="u" tags="t"/><post id="{}" file_ext="MP4" file_url="u" file_size="5"/><post id="9"/></posts>'
    (tmp_path / "page-1.xml").write_text(page.format(101, "jpg", 102))
    (tmp_path / "page-2.xml").write_text(page.format(201, "webm", 202))
    (tmp_path / "page-4.xml").write_text(page.format(401, "webm", 402))  # behind a missing page
    feed = jsonl.feed_pages(spark, str(tmp_path))
    got = jsonl.matching_posts(jsonl.posts(feed), 2)
    assert [(r["id"], r["file_ext"], r["file_size"]) for r in got.collect()] == [(202, "mp4", 5), (201, "webm", 0)]


def test_models_fall_back_row_by_row(spark):
    def load():
        def model(values):
            if "bad" in values:
                raise RuntimeError("no")
            return [{"rating": "general", "general_tags": [v], "character_tags": []} for v in values]

        return model

    got = {r["clip_path"]: r["status"] for r in models.tagged(spark.createDataFrame([("a",), ("bad",)], "clip_path string").coalesce(1), load).collect()}
    assert got == {"a": "tagged", "bad": "failed"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert sinks.json_lines(df).first()[0] == '{"a":1,"b":null}'
    odd = spark.createDataFrame([("é \u007f \U0001f600 é \\u00e9 \"",), (None,)], "c string")
    lines = [r[0] for r in sinks.json_lines(odd).collect()]
    assert lines == [json.dumps({"c": r["c"]}, separators=(",", ":")) for r in odd.collect()]
    assert sinks.summary_line(df).first()[0] == "a=1 b=null"
    (tmp_path / "x.mp4").write_bytes(b"x")
    jobs = spark.createDataFrame([(str(tmp_path / "x.mp4"), str(tmp_path / "o/y.mp4")), (str(tmp_path / "no"), str(tmp_path / "o/z.mp4"))], "source_file string, target_file string")
    assert sorted(r["status"] for r in sinks.copied_media(jobs).collect()) == ["copied", "failed"]


# Orders, pages, decisions, counts


def test_numbered_against_sorting(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(50), i) for i in range(300)]
    got = ordering.numbered(spark.createDataFrame(rows, "x int, i int"), [F.col("x"), F.col("i")], "n").collect()
    assert [(r["x"], r["i"]) for r in sorted(got, key=lambda r: r["n"])] == sorted(rows) and sorted(r["n"] for r in got) == list(range(1, 301))
    assert ordering.numbered(spark.createDataFrame([], "x int"), [F.col("x")], "n").isEmpty()


def test_feed_ends_with_a_short_or_missing_page(spark):
    def ids(rows, count=99):
        df = spark.createDataFrame(rows, "page int, position int, id int, file_ext string")
        return [r["id"] for r in jsonl.paged_posts(df, count, 2).collect()]

    full = [(p, k, 10 * p - k, "mp4") for p in (1, 2, 3) for k in (0, 1)]
    assert ids(full) == [10, 9, 20, 19, 30, 29] and ids(full, 3) == [10, 9, 20]
    assert ids([r for r in full if (r[0], r[1]) != (2, 1)]) == [10, 9, 20]
    assert ids([r for r in full if r[0] != 2]) == [10, 9] and ids([r for r in full if r[0] != 1]) == []
    assert ids([(1, 0, 1, "png"), (1, 1, 2, "webm"), (2, 0, 3, "mp4")]) == [2, 3]


def test_decisions_by_video(spark):
    cases = {
        "a": (["view", "leave"], "accepted", True), "b": (["leave", "view"], "pending", True), "c": (["accept", "reject"], "rejected", False),
        "d": (["view", "reject", "leave"], "rejected", True), "e": (["view", "leave", "reject", "view", "accept"], "accepted", True),
        "f": ([], "pending", False), "g": (["error", "accept"], "accepted", False), "h": (["dance", None], "pending", False),
    }
    states = spark.createDataFrame([(v, "pending") for v in cases], "video_id string, status string")
    actions = spark.createDataFrame([(v, a, k) for v, (done, *_) in cases.items() for k, a in enumerate(done)], "video_id string, action string, action_no int")
    assert {r["video_id"]: (r["status"], r["seen"]) for r in review.decided(states, actions).collect()} == {v: (s, n) for v, (_, s, n) in cases.items()}


class PlainSession:
    """A reviewer's session, one action after the other."""

    def __init__(self, rows):
        self.v = {r[0]: dict(zip(("status", "motion", "found", "seen"), r[1:], strict=True)) for r in rows}
        new = [k for k in self.order() if self.v[k]["status"] == "pending" and self.v[k]["seen"] is None]
        old = sorted((k for k in self.v if self.v[k]["status"] == "pending"), key=lambda k: (self.v[k]["seen"] or math.inf, self.v[k]["found"], k))
        self.at = (new or old or self.order()[-1:])[0]
        self.view(self.at)

    def order(self):
        seen = sorted((k for k in self.v if self.v[k]["seen"] is not None), key=lambda k: (self.v[k]["seen"], self.v[k]["found"], k))
        return seen + sorted((k for k in self.v if self.v[k]["seen"] is None), key=lambda k: (self.v[k]["motion"] is None, self.v[k]["motion"] or 0, self.v[k]["found"], k))

    def view(self, k):
        if self.v[k]["seen"] is None:
            self.v[k]["seen"] = max([0, *(x["seen"] or 0 for x in self.v.values())]) + 1

    def act(self, action):
        now = self.v[self.at]
        if action in review.DECISIONS:
            now["status"] = review.DECISIONS[action]
        ids = self.order()
        to = max(0, min(len(ids) - 1, ids.index(self.at) + review.STEPS.get(action, 0)))
        if ids[to] != self.at:
            if action in ("next", "previous") and now["status"] == "pending":
                now["status"] = "accepted"
            self.at = ids[to]
            self.view(self.at)
        return self.at


@pytest.mark.parametrize("seed", range(4))
def test_session_against_one_action_after_the_other(spark, seed):
    rng = random.Random(seed)
    rows = [(f"v{k:02d}", rng.choice(["pending", "pending", "accepted", "rejected"]), rng.choice([None, rng.random(), 0.5]), k + 1, rng.choice([None, None, 100 - k])) for k in range(9)]
    states = spark.createDataFrame(rows, "video_id string, status string, motion_score double, discovered_order long, seen_order long")
    actions = [(k, rng.choice(["accept", "reject", "next", "next", "previous", "previous", "error", "dance"])) for k in range(80)]
    session, want = PlainSession(rows), []
    for k, action in actions:
        want.append((k, action, session.at, session.act(action)))
    replay = review.replayed(states, spark.createDataFrame(actions, "action_no long, action string").repartition(5))
    assert sorted(map(tuple, replay.collect())) == want
    assert {r["video_id"]: r["status"] for r in review.session_states(states, replay).collect()} == {k: x["status"] for k, x in session.v.items()}
    assert review.replayed(states.limit(0), spark.createDataFrame(actions, "action_no long, action string")).isEmpty()


def test_walk_between_bounds(spark):
    rng = random.Random(8)
    steps = [rng.choice([-7, -2, -1, 1, 1, 2, 7]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(steps)), "k long, s int")
    x, want = 5, []
    for s in steps:
        want.append(x)
        x = min(max(x + s, 1), 9)
    assert [r["x"] for r in sorted(ordering.walked(df, [F.col("k")], F.col("s"), 5, 1, 9, "x").collect())] == want


def test_export_writes_all_or_nothing(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    fails = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("int").alias("n"))
    paths = {k: str(tmp_path / "out" / k) for k in ("train", "val")}
    with pytest.raises(Exception, match="no"):
        sinks.write_together({"train": good, "val": fails}, paths)
    assert list((tmp_path / "out").iterdir()) == [] if (tmp_path / "out").exists() else True
    sinks.write_together({"train": good, "val": good.limit(0)}, paths)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["train", "val"]
    assert sorted(r["value"] for r in spark.read.text(paths["train"]).collect()) == ['{"n":1,"s":"a"}', '{"n":2,"s":"b"}']
    with pytest.raises(FileExistsError):
        sinks.write_together({"new": good, "train": good}, paths | {"new": str(tmp_path / "out" / "new")})
    assert not (tmp_path / "out" / "new").exists()
    blocked = tmp_path / "file"
    blocked.write_text("x")  # no folder can be made below a file
    with pytest.raises(Exception):
        sinks.write_together({"first": good, "second": good}, {"first": str(tmp_path / "out" / "first"), "second": str(blocked / "second")})
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["train", "val"]


def test_export_target_is_checked(spark, tmp_path):
    sinks.check_target(spark, str(tmp_path / "none"))
    (tmp_path / "out" / "deep").mkdir(parents=True)
    sinks.check_target(spark, str(tmp_path / "out"))
    for name in ("deep/old.MP4", "tags.jsonl"):
        (tmp_path / "out" / name).write_text("x")
        with pytest.raises(ValueError, match=name.split("/")[-1]):
            sinks.check_target(spark, str(tmp_path / "out"))
        (tmp_path / "out" / name).unlink()


def test_boundary_model(spark):
    """Two heads' scores, the larger counts; spans as from literal scores."""
    heads = {"/a": ([0, 0.5, 0, 0, 0.1, 0], [[0], [0.2], [0], [0], [0.5], [0]]), "/b": ([0.0] * 4, [0.0] * 4), "/odd": ([0.1], [0.1, 0.2])}

    def load():
        return lambda paths: [heads[p] for p in paths]

    videos = spark.createDataFrame([("v", "/a", 2.0, 9.0), ("calm", "/b", 2.0, 1.5)], "video string, path string, fps double, duration double")
    found = models.boundary_scores(videos, load, 1)
    assert [r["score"] for r in found.where("video = 'v'").orderBy("frame").collect()] == [0, 0.5, 0, 0, 0.5, 0]
    assert {(r["video"], r["duration"]) for r in found.collect()} == {("v", 3.0), ("calm", 1.5)}
    lengths = found.select("video", "duration").distinct()
    got = spans.safe_spans(found, lengths, 0.35, 0.25, 0.1, 0.0)
    assert pairs(got.where("video = 'v'")) == [(0.0, 0.25), (1.25, 1.75), (2.75, 3.0)] and pairs(got.where("video = 'calm'")) == [(0.0, 1.5)]
    with pytest.raises(Exception, match="scores of the same frames"):
        models.boundary_scores(spark.createDataFrame([("o", "/odd", 2.0, 1.0)], videos.schema), load).collect()


@pytest.mark.parametrize("knows", [True, False])
def test_caption_batches_and_fallbacks(spark, tmp_path, knows):
    calls = tmp_path / "calls"

    def load():
        def prepare(path, prompt, **options):
            if options and not knows:
                raise TypeError("unexpected keyword argument 'thinking'")
            if path == "unreadable":
                raise OSError("no file")
            return f"{prompt} {path}"

        def generate(inputs):
            with calls.open("a") as f:
                f.write(f"{len(inputs)}\n")
            if any("bad" in x for x in inputs):
                raise RuntimeError("out of memory")
            return [x.upper() for x in inputs]

        return prepare, generate

    names = ["a", "b", "bad", "c", "unreadable", "d", "e"]
    clips = spark.createDataFrame([(n, "say") for n in names], "clip_path string, prompt string").coalesce(1)
    got = {r["clip_path"]: (r["caption"], r["status"], r["error"]) for r in models.captioned(clips, load, 3).collect()}
    assert got == {n: (f"SAY {n.upper()}", "captioned", "") for n in names if n not in ("bad", "unreadable")} | {"bad": (None, "failed", "out of memory"), "unreadable": (None, "failed", "no file")}
    assert calls.read_text().split() == ["3", "1", "1", "1", "2", "1"]


def test_unknown_status_counts_as_pending(spark):
    log = spark.createDataFrame([("a", "odd", None, 0, None, 1), ("b", "accepted", None, 4, None, 2)], "video_id string, status string, motion_score double, discovered_order long, seen_order long, line_no long")
    assert {r["video_id"]: (r["status"], r["discovered_order"]) for r in review.latest_states(log).collect()} == {"a": ("pending", 5), "b": ("accepted", 4)}


def test_validation_counts_that_cannot_be(spark):
    def clips(*sources):
        return spark.createDataFrame([(f"c{k}", s, ["t"]) for k, s in enumerate(sources)], "clip_relpath string, source_id string, tags array<string>")

    assert tags.resolved_count(clips("a", "a", "b"), count=2) == 2 and tags.resolved_count(clips(*"aaaaabbbbb"), fraction=0.25) == 2
    assert tags.resolved_count(clips(*"aab"), fraction=1.0) == 2
    for bad in (dict(clips=clips("a", "b").limit(0)), dict(clips=clips("a", "a"), count=1), dict(clips=clips("a", "a", "b"), count=3), dict(clips=clips("a", "b"), count=1, train_count=2)):
        with pytest.raises(ValueError):
            tags.resolved_count(**bad)


# Records


def test_records_of_odd_rows(spark):
    clips = spark.createDataFrame([("/a", None, 1.0, 0.5), ("/b", "b", None, None)], "clip_path string, clip_relpath string, duration double, frame_time double")
    schema = "clip_path string, rating string, rating_scores map<string,float>, general_tags array<string>, general_tag_scores map<string,float>, character_tags array<string>, character_tag_scores map<string,float>, all_tags array<string>, status string, error string"
    results = spark.createDataFrame([("/a", "general", {"general": 0.5}, ["x"], None, None, None, ["x", " x", ""], "tagged", None)], schema)
    got = {r["clip_path"]: r.asDict() for r in records.tag_records(clips, results, "m").collect()}
    assert got["/a"]["all_tags"] == ["x"] and got["/a"]["rating_scores"] == {"general": 0.5} and got["/a"]["character_tags"] == [] and got["/a"]["error"] == ""
    assert (got["/b"]["status"], got["/b"]["error"], got["/b"]["general_tags"], got["/b"]["rating"]) == ("failed", "no result", [], None)
    rows = spark.createDataFrame([(1, "a/../b.mp4", None, ["general", "x"], None, None, "tagged"), (2, "/out/c.mp4", " ", ["y"], None, None, "tagged"), (3, "d.mp4", None, ["general"], [], [], "tagged"), (4, "e.mp4", None, ["z"], None, None, "failed"), (5, None, "f.mp4", None, ["g"], None, "tagged")], "line_no int, clip_path string, clip_relpath string, all_tags array<string>, general_tags array<string>, character_tags array<string>, status string")
    found = {r["line_no"]: (r["clip_path"], r["clip_relpath"], r["hints"]["general"]) for r in records.hint_rows(rows, "/in/").collect()}
    assert found == {1: ("/in/b.mp4", "b.mp4", ["x"]), 2: ("/out/c.mp4", None, ["y"]), 5: (None, "f.mp4", ["g"])}
    asked = spark.createDataFrame([("/in/b.mp4", "b.mp4"), ("/in/f.mp4", "f.mp4"), ("/in/q.mp4", "q.mp4")], "clip_path string, clip_relpath string")
    hinted = {r["clip_relpath"]: r["hints"] and r["hints"]["general"] for r in manifests.with_hints(asked, records.hint_rows(rows, "/in")).collect()}
    assert hinted == {"b.mp4": ["x"], "f.mp4": ["g"], "q.mp4": None}


def test_sizes_of_one_position_are_one_candidate(spark):
    f = spark.createDataFrame([(128, 64, 9, 2), (64, 32, 9, 3), (64, 64, 9, 5), (64, 32, 17, 7)], "width int, height int, frames int, weight long")
    assert sorted(map(tuple, buckets.positions(f).collect())) == [(64, 32, 9, 5), (64, 32, 17, 7), (64, 64, 9, 5)]


def test_gains_of_points_in_reach(spark):
    rng = np.random.default_rng(3)
    shape = ["width", "height", "frames", "weight"]
    points = pd.DataFrame(rng.integers(1, 60, (300, 4)), columns=shape).assign(near=rng.random(300))
    candidates = pd.DataFrame(rng.integers(1, 60, (40, 4)), columns=shape)
    got = buckets._gains(candidates, points)
    for c, gain in zip(candidates.itertuples(), got, strict=True):
        d = np.abs(np.log(points.width / points.height) - np.log(c.width / c.height)) + np.abs(np.log(points.frames) - np.log(c.frames))
        assert gain == pytest.approx((np.maximum(points.near - d, 0) * points.weight).sum(), rel=1e-12, abs=1e-12)


def test_gains_by_frame_count(spark, monkeypatch):
    rng = np.random.default_rng(5)
    shape = ["width", "height", "frames", "weight"]
    points = pd.DataFrame(rng.integers(1, 60, (500, 4)), columns=shape).assign(near=rng.random(500))
    candidates = pd.DataFrame(rng.integers(1, 60, (400, 4)), columns=shape).assign(frames=rng.integers(1, 9, 400))
    want = buckets._gains(candidates, points)
    assert buckets._tents(candidates, points) == pytest.approx(want, rel=1e-9, abs=1e-9)
    # only the leaders are measured pair by pair
    pairs, gains = [], buckets._held_gains
    monkeypatch.setattr(buckets, "_measured", None)
    monkeypatch.setattr(buckets, "_held_gains", lambda near, held: (pairs.append(len(held)), gains(near, held))[1])
    monkeypatch.setattr(buckets, "HELD", 4)
    f = spark.createDataFrame(points[shape].drop_duplicates(shape[:3]).astype("int64"))
    assert buckets.greedy(f, 512, 5).count() == 5
    assert max(pairs) <= 8


def test_greedy_buckets_measure_positions_once(spark, monkeypatch):
    sizes = []
    leaders = buckets._leaders
    monkeypatch.setattr(buckets, "_leaders", lambda near, taken, size: (sizes.append(size), leaders(near, taken, size))[1])
    f = spark.createDataFrame([(64 * k, 32 * k, n, 1) for k in range(1, 9) for n in (9, 17, 33)], "width int, height int, frames int, weight long")
    buckets.greedy(f, 512, 3)
    assert set(sizes) == {3}  # eight sizes of each


def test_report_cuts_captions_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    captions = spark.createDataFrame([("a b a",), ("b a\nnone",), (None,)], "caption string").mapInPandas(count, "caption string")
    got = [r["line"] for r in words.report(captions, 2).collect()]
    assert got == ["manifests=1 caption_rows=3 unique_words=2 unique_bigrams=2", "Top 2 words", "1. a (3)", "2. b (2)", "Top 2 bigrams", "1. b a (2)", "2. a b (1)"]
    assert seen.value == 2 * 3  # once for tokens, once for the number of rows


def test_validation_picks_are_checked_many_at_once(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(f"c{i:02d}", f"s{i % 3}", sorted(rng.sample([f"t{k}" for k in range(25)], rng.randint(0, 9)))) for i in range(60)]
    passes, best = [], splits._best
    monkeypatch.setattr(splits, "_best", lambda *a: (passes.append(0), best(*a))[1])
    monkeypatch.setattr(splits, "HELD", 12)
    assert picked(splits.validation_subset(clips(spark, *rows), 30)) == plain_validation(rows, 30, None)
    assert len(passes) < 30  # one a pick


def test_balanced_subset_compares_keys_alone(spark, monkeypatch):
    kind, shapes = type(spark.range(1)), []
    arrow = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, shape, *a, **b: (shapes.append(shape), arrow(self, f, shape, *a, **b))[1])
    rows = [(f"c{i:02d}", f"s{i}", [f"t{i % 7}", f"t{i % 5}"]) for i in range(20)]
    assert picked(splits.balanced_subset(clips(spark, *rows), 8)) == plain_greedy(rows, 8)
    assert shapes and not any("array" in s or "string" in s for s in shapes)  # every task sends its first ones; tags follow for the chosen
