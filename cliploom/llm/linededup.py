"""Removing repeated runs of lines by distributed prefix doubling over line-ID sequences.

Every document is a sequence of line ids. Suffixes are ranked by their first line, then by their first 2, 4, 8, ...
lines: a round pairs the rank of a suffix with that of the suffix as many lines later, sorts the distinct pairs over
range partitions, and numbers them in order. Suffixes whose pair nobody else has drop out, so only repeated runs go on.
Equal ranks are the intervals of suffixes whose longest common prefix is at least as long; for a length in between, two
overlapping ranks name the run. Runs count from ``least_words`` words; for every line, the shortest such run that begins
there and the shortest that ends there are looked up, and together they cover all maximal repeated runs. The first copy
(by document id, then line) stays, the lines of later copies go; where a later copy overlaps with the first one in its
document, only its lines behind the first one go.

Defined cases: blank lines are not part of a sequence and stay; null texts stay null, empty ones empty, and a document
that loses all its other lines is left with an empty text; lines are compared without white space at their ends; a null
id comes before all others; rows equal in id and text are one document and treated alike; rows that share an id only are
documents of their own; a very long text is one sequence like others; an empty table gives no rows; all other columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Workspace, fresh, staged

LEAST_WORDS = 50
#: Whose characters at a line's ends do not matter.
_ENDS = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
KEY = ["d", "t"]
#: Rows of one key in a join beyond which the key is broadcast; and of documents, or of lines to remove, that are.
HOT, BROADCAST_ROWS, BROADCAST_LINES = 2000, 500_000, 4_000_000


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(-(2**63))).cast("long")


def _lines() -> Column:
    return F.split("text", "\n", -1)


def _met(many: DataFrame, once: DataFrame, keys: list[str]) -> DataFrame:
    """many joined with once: one row a key, n of them rows of many. Frequent keys, of which there are few, are broadcast,
    so no task gets all rows of one."""
    hot = once.where(F.col("n") > HOT)
    some = hot.limit(BROADCAST_ROWS + 1).count()
    if not 0 < some <= BROADCAST_ROWS:
        return many.join(once, keys)
    rest = many.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(once.where(F.col("n") <= HOT), keys)
    return many.join(F.broadcast(hot), keys).unionByName(rest)


def _sequences(docs: DataFrame, work: Workspace) -> DataFrame:
    """d, t (document), i (number among the lines that aren't blank), h (line id), w (words); only lines that occur again."""
    lines = docs.where("text is not null").select(
        _id().alias("d"),
        F.xxhash64("text").alias("t"),
        F.posexplode(F.filter(F.transform(_lines(), lambda x: F.regexp_replace(x, _ENDS, "")), lambda x: x != "")).alias("i", "line"),
    )
    lines = lines.select("d", "t", "i", F.xxhash64("line").alias("h"), F.regexp_count("line", F.lit(WORD)).alias("w"))
    lines = work(lines, "lines")
    again = work(lines.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "again")
    return work(_met(lines, again, ["h"]).drop("n").distinct(), "repeated-lines")


def _windows(lines: DataFrame, least_words: int) -> DataFrame:
    """d, t, start, size: the shortest runs of least_words words from each line on and up to each line, over unbroken
    stretches of lines that occur again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for d, t, s in zip(batch["d"], batch["t"], batch["lines"], strict=True):
                i = np.array([x["i"] for x in s])
                w = np.array([x["w"] for x in s])
                for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i) != 1) + 1):
                    upto = np.concatenate([[0], np.cumsum(w[part])])
                    last = np.searchsorted(upto, upto[:-1] + least_words)  # first end that suffices
                    found = {(a, b) for a, b in enumerate(last) if b < len(upto)}
                    first = np.searchsorted(upto, upto[1:] - least_words, side="right") - 1
                    found |= {(a, b + 1) for b, a in enumerate(first) if a >= 0}
                    out += [(d, t, int(i[part[0]] + a), int(b - a)) for a, b in found]
            if out:
                yield pd.DataFrame(out, columns=["d", "t", "start", "size"])

    grouped = lines.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("lines"))
    return grouped.mapInPandas(run, "d long, t long, start int, size int")


def ranks(lines: DataFrame, longest: int, work: Workspace) -> DataFrame:
    """d, t, i, k, r: for suffixes whose first 2**k lines occur again, their rank by those lines; 2**k up to longest."""
    level = lines.select(*KEY, "i", F.col("h").alias("r"))
    out = level.withColumn("k", F.lit(0))
    k = 0
    while 2 ** (k + 1) <= longest:
        later = level.select(*KEY, (F.col("i") - 2**k).alias("i"), F.col("r").alias("r2"))
        pairs = work(level.join(later, [*KEY, "i"]), "suffix-pairs")
        named = pairs.groupBy("r", "r2").agg(F.count("*").alias("n")).where("n > 1")
        # numbers of rows in range partitions rise with the sort order
        named = work(named.repartitionByRange("r", "r2").sortWithinPartitions("r", "r2").withColumn("name", F.monotonically_increasing_id()), "suffix-ranks")
        level = work(_met(pairs, named, ["r", "r2"]).select(*KEY, "i", F.col("name").alias("r")), "suffixes")
        k += 1
        out = out.unionByName(level.withColumn("k", F.lit(k)))
        if level.isEmpty():
            break
    return out


def later_copies(docs: DataFrame, work: Workspace, least_words: int = LEAST_WORDS) -> DataFrame:
    """d, t and the sorted numbers, among the lines that aren't blank, of those to remove."""
    lines = _sequences(docs, work)
    windows = _windows(lines, least_words).withColumn("k", F.floor(F.log2("size")).cast("int"))
    windows = work(windows, "runs")
    longest = windows.agg(F.max("size")).first()[0] or 1
    names = ranks(lines, longest, work)
    first = names.select(*KEY, F.col("i").alias("start"), "k", F.col("r").alias("ra"))
    last = names.select(*KEY, F.col("i").alias("tail"), "k", F.col("r").alias("rb"))
    tail = F.col("start") + F.col("size") - F.expr("shiftleft(1, k)")
    runs = windows.join(first, [*KEY, "start", "k"]).withColumn("tail", tail).join(last, [*KEY, "tail", "k"])
    runs = work(runs.select(*KEY, "start", "size", "ra", "rb"), "named-runs")
    firsts = runs.groupBy("size", "ra", "rb").agg(F.min(F.struct("d", "t", "start")).alias("kept"), F.count("*").alias("n")).where("n > 1")
    again = _met(runs, work(firsts, "first-copies"), ["size", "ra", "rb"])
    here = (F.col("d") == F.col("kept.d")) & (F.col("t") == F.col("kept.t"))
    begin = F.when(here, F.greatest("start", F.col("kept.start") + F.col("size"))).otherwise(F.col("start"))
    again = again.where(~(here & (F.col("start") == F.col("kept.start")))).select(*KEY, begin.alias("begin"), (F.col("start") + F.col("size") - 1).alias("end")).where("begin <= end")
    gone = again.select(*KEY, F.explode(F.sequence("begin", "end")).alias("i"))
    return gone.groupBy(*KEY).agg(F.array_sort(F.collect_set("i")).alias("gone"))


def remove_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, lines: str = "_lines", gone: str = "_gone") -> DataFrame:
    """The documents without later copies of runs, plus two columns, named so that no column of docs is hidden: lines
    that aren't blank, and of those removed."""
    work = Workspace(docs.sparkSession, "linededup")
    dropped = staged(later_copies(docs.select("doc_id", "text"), work, least_words), "later-copies")
    work.close()
    n, held = dropped.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    small = n <= BROADCAST_ROWS and held <= BROADCAST_LINES
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", _id().alias("d"), F.xxhash64("text").alias("t"))
    joined = rows.join(dropped.hint("broadcast" if small else "shuffle_hash"), KEY, "left")
    # a line that isn't blank is numbered by how many such lines stand before it
    numbered = F.aggregate(
        "blank",
        F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("at")),
        lambda a, b: F.struct(F.when(b, a["n"]).otherwise(a["n"] + 1).alias("n"), F.array_append(a["at"], F.when(b, -1).otherwise(a["n"])).alias("at")),
    )
    kept = F.filter(F.arrays_zip(_lines().alias("line"), F.col("numbers.at").alias("at")), lambda x: ~F.array_contains("gone", x["at"]))
    touched = F.col("gone").isNotNull()
    out = joined.withColumn("blank", F.transform(_lines(), lambda x: F.regexp_replace(x, _ENDS, "") == ""))
    out = out.withColumn("n_lines", F.greatest(F.size(F.filter("blank", lambda b: ~b)), F.lit(0))).withColumn("n_gone", F.when(touched, F.size("gone")).otherwise(0))
    out = out.withColumn("numbers", F.when(touched, numbered))
    rest = F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
    text = F.when(~touched, F.col("text")).when(F.col("n_gone") == F.col("n_lines"), "").otherwise(rest)
    columns = [text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return out.select(*columns, F.col("n_lines").alias(fresh(lines, docs.columns)), F.col("n_gone").alias(fresh(gone, docs.columns)))
