"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions alone.

Fixed masks pick some of the words of every window and ignore the others, so an equal hash survives substitutions
at the ignored places. Hashes of benchmark items are joined with those of all document windows; around every hit
item and document are compared word by word on the hit's diagonal, and of the stretches that are similar enough the
one with most matches is kept if they are enough. The two masks miss no such stretch: one of 10 matches or more, and
at most one mismatch to three matches, has four equal words in a row or three with a fourth behind a gap of one
(tests/llm go through all patterns).

Items of which LEAST_MATCHES words would be more than that share need the share, at least WHOLE words: one word of five to eight may
differ, two of eight to nine, and so on, which further masks find that are used only if there are such items. Items of WHOLE words
must match whole. Still shorter ones are whole seeds of their own length, from ``shortest`` words on: by default WHOLE, so they match
nothing, as so few words stand together by chance anywhere; shortest=1 looks for single words, too.

Windows are narrow rows: a document's id, a place and a hash. They meet the benchmark's by broadcast while it is small
enough, which is counted first; beyond that by shuffle, apart from frequent seeds, which are broadcast still. Only distinct diagonals are shuffled, and go back to the texts for the comparison.

Defined cases: words are runs of letters and digits, lower-cased; null and empty texts, and items of fewer words than
shortest, overlap with nothing; null ids are ids like others; rows with one id are one document, of which the best
stretch counts; repeated items give one row each by id; a very long text costs as many narrow rows as it has words; empty
tables give no rows; further columns are ignored, and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Places of a window that are hashed, and those for items that need fewer than LEAST_MATCHES matches.
MASKS = ((0, 1, 2, 3), (0, 1, 2, 4))
SHORT_MASKS = ((0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 5))
LEAST_MATCHES = 10
#: Items of fewer words match as a whole or not at all.
WHOLE = 4
LEAST_IDENTITY = 0.75
#: Seeds of the benchmark, diagonals and contaminated ids up to so many rows are broadcast, items up to so many words in
#: all; more are joined by shuffle.
BROADCAST_ROWS, BROADCAST_WORDS = 1_000_000, 4_000_000
#: Seeds of a benchmark beyond the broadcast that more windows have are frequent.
HOT = 100_000

TOKEN = r"[\p{L}\p{N}]+"


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(words: Column, masks: Sequence[Sequence[int]], sizes: Sequence[tuple[int, int]] | None = None) -> Column:
    """Of every mask and every window that it fits into, the place and the hash of the words it picks; masks differ in
    their hash, too. With sizes, a mask is for lists of so many words, from and to."""

    def of(mask: Sequence[int], within: tuple[int, int] | None) -> Column:
        seeds = F.transform(
            F.sequence(F.lit(0), F.size(words) - mask[-1] - 1),
            lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(",".join(map(str, mask))), *[F.get(words, i + p) for p in mask]).alias("seed")),
        )
        fits = F.size(words) > mask[-1]
        return F.when(fits & F.size(words).between(*within) if within else fits, seeds).otherwise(F.array().cast("array<struct<at:int,seed:bigint>>"))

    return F.inline(F.concat(*[of(m, sizes[k] if sizes else None) for k, m in enumerate(masks)]))


def _needed(size: Column, least_matches: int, least_identity: float) -> Column:
    """Matches that an item of so many words needs: all of a short one, else the share, up to least_matches."""
    share = Fraction(str(least_identity))
    ceiling = F.floor((size * share.numerator + share.denominator - 1) / share.denominator).cast("int")
    return F.when(size <= WHOLE, size).otherwise(F.least(F.lit(least_matches), F.greatest(F.lit(WHOLE), ceiling)))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _met(windows: DataFrame, seeds: DataFrame) -> DataFrame:
    """Windows with the benchmark's seeds. Where those are too many to broadcast, the frequent ones are, if there are few,
    so that no task gets all windows of one; they are counted in partial sums before anything is shuffled."""
    if seeds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return windows.join(F.broadcast(seeds), "seed")
    hot = windows.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > HOT).join(seeds.select("seed").distinct(), "seed", "left_semi")
    hot = staged(seeds.join(hot.select("seed"), "seed"), "frequent-seeds")
    if not 0 < hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return windows.join(seeds, "seed")
    keys = F.broadcast(hot.select("seed").distinct())
    rest = windows.join(keys, "seed", "left_anti").join(seeds.join(keys, "seed", "left_anti"), "seed")
    return windows.join(F.broadcast(hot), "seed").unionByName(rest)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: Sequence[Sequence[int]] = MASKS,
    least_matches: int = LEAST_MATCHES,
    least_identity: float = LEAST_IDENTITY,
    shortest: int = WHOLE,
) -> DataFrame:
    """doc_id, item_id, and their best stretch: doc_start (words before it), n_words, n_matches. shortest: words of the shortest
    items that are looked for."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("item"))
    size, most = F.size("item"), 2**31 - 1
    tight = size.between(WHOLE + 1, most) & (_needed(size, least_matches, least_identity) < least_matches)
    kinds = items.agg(F.max(F.when(tight, size)).alias("tight"), *[F.max((size == n).cast("int")).alias(f"whole{n}") for n in range(max(shortest, 1), WHOLE)]).first()
    used = [(m, (WHOLE, most)) for m in masks] + [(m, (WHOLE + 1, kinds["tight"])) for m in SHORT_MASKS if kinds["tight"]]
    used += [(tuple(range(n)), (n, n)) for n in range(max(shortest, 1), WHOLE) if kinds[f"whole{n}"]]
    masks = [m for m, _ in used]
    seeds = items.select("item_id", _seeds(F.col("item"), masks, [s for _, s in used])).withColumnRenamed("at", "item_at")
    words = docs.select("doc_id", word_hashes(F.col("text")).alias("words"))
    hits = _met(words.select("doc_id", _seeds(F.col("words"), masks)), seeds)
    hits = staged(hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct(), "diagonals")
    held = items.agg(F.coalesce(F.sum(F.size("item")), F.lit(0))).first()[0]
    wanted = hits.join(F.broadcast(items) if held <= BROADCAST_WORDS else items, hits["item_id"].eqNullSafe(items["item_id"])).select(
        F.col("doc_id").alias("_doc"), hits["item_id"], "item", "diagonal"
    )
    ids = _few(hits.select(F.col("doc_id").alias("_id")).distinct())
    some = words.join(ids, words["doc_id"].eqNullSafe(ids["_id"]), "left_semi")
    met = some.join(wanted, some["doc_id"].eqNullSafe(wanted["_doc"]))
    here = F.col("diagonal")
    at = F.filter(F.sequence(F.lit(0), F.size("item") - 1), lambda k: (here + k >= 0) & (F.get("words", F.greatest(here + k, F.lit(0))) == F.get("item", k)))
    need = _needed(F.size("item"), least_matches, least_identity)
    met = met.select("doc_id", "item_id", "diagonal", need.alias("need"), at.alias("places")).where(F.size("places") >= F.col("need"))
    # a generator is not merged with its neighbours, so each diagonal's stretch is found once
    best = met.select("doc_id", "item_id", "diagonal", "need", F.inline(F.array(_stretch(least_identity)))).where("n_matches >= need")
    start = F.col("diagonal") + F.col("start")
    order = F.struct((-F.col("n_matches")).alias("n"), start.alias("doc_start"), F.col("n_words"))
    return (
        best.groupBy("doc_id", "item_id")
        .agg(F.min(order).alias("x"))
        .select(
            "doc_id",
            "item_id",
            F.col("x.doc_start").cast("long").alias("doc_start"),
            F.col("x.n_words").cast("long").alias("n_words"),
            (-F.col("x.n")).cast("long").alias("n_matches"),
        )
    )


def _stretch(least_identity: float) -> Column:
    """Of the item's stretches on the diagonal, given the places that match, whose share of matches is least_identity or
    more, the one with most matches, of equal ones the shortest, then the first. Null without a match.

    With m matches among the first k words, a stretch qualifies where m - least_identity * k is no less at its end than
    at its start. So starts and ends, which are matches, are sorted by that, and each end takes the first of the starts
    before it in this order.
    """
    share = Fraction(str(least_identity))

    def level(m: Column, k: Column) -> Column:
        return m.cast("long") * share.denominator - k.cast("long") * share.numerator

    def event(value: Column, kind: int, m: Column, k: Column) -> Column:
        return F.struct(value.alias("level"), F.lit(kind).alias("kind"), m.alias("m"), k.alias("k"))

    starts = F.transform("places", lambda k, m: event(level(m, k), 0, m, k))
    ends = F.transform("places", lambda k, m: event(level(m + 1, k + 1), 1, m, k))

    def stretch(n: Column, words: Column, start: Column) -> Column:
        return F.struct(n.alias("n_matches"), (-words).alias("short"), (-start).alias("before"))

    def step(a: Column, e: Column) -> Column:
        opens = (e["kind"] == 0) & (a["m"].isNull() | (e["m"] < a["m"]))
        found = F.when(e["kind"] == 1, stretch(e["m"] - a["m"] + 1, e["k"] - a["k"] + 1, a["k"]))
        return F.struct(
            F.when(opens, e["m"]).otherwise(a["m"]).alias("m"),
            F.when(opens, e["k"]).otherwise(a["k"]).alias("k"),
            F.greatest(a["best"], found).alias("best"),
        )

    none = F.lit(None).cast("int")
    zero = F.struct(none.alias("m"), none.alias("k"), F.lit(None).cast("struct<n_matches:int,short:int,before:int>").alias("best"))

    def result(a: Column) -> Column:
        best = a["best"]
        return F.struct((-best["before"]).alias("start"), (-best["short"]).alias("n_words"), best["n_matches"].alias("n_matches"))

    return F.aggregate(F.array_sort(F.concat(starts, ends)), zero, step, result)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no item."""
    hit = staged(overlaps(docs, benchmark).select(F.col("doc_id").alias("_hit")).distinct(), "overlaps")
    hit = _few(hit)
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_anti")
