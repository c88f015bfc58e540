"""Joining documents whose word shingles have a Jaccard similarity of 0.75 or more, by PartEnum signatures.

Sets that differ little agree on some part of the feature domain. Sets are put into bands of sizes; a band's domain is
cut into n1 partitions of N2 sub-partitions each, and a signature is what a set has in a kept subset of N2 - K2
sub-partitions of one partition. A set within reach of the next band has signatures there, too. Two sets share a
signature unless their differences spoil all: a differing shingle spoils at most SPOILED signatures, and empty subsets
(which say nothing) are left out, so a set with more than SPOILED times the largest possible difference of usable
signatures misses no partner. Signatures of more than MOST_SHARING sets are not followed; they count as unusable.

What remains without that proof (short sets, and large families of near copies, all of whose signatures are frequent)
is joined exactly in another way: among themselves, by their rarest shingles, as many as any partner must share one of.

Either way gives groups of sets that may be similar. Within a group each is compared with its most typical set first;
pairs are compared further only where they are not in one component by then and no proof keeps them apart. Every link is verified on whole sets.
Documents of equal sets are one class throughout, so copies are never paired.

Texts are shingled once: the pass that gives signatures also gives every document's set size and class. A task gives the
signatures of a class once, however many copies it reads; only sets that may have a partner are made again, to be verified.

Defined cases: texts without a word, and null texts, have no shingles and are linked with nothing; with fewer than five
words the whole sequence is the only shingle; null ids count as the smallest id; rows that share an id are documents of
their own; a very long text is one set like others, held whole by one task; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import chain, combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Workspace, staged
from .components import connected

SHINGLE = 5
#: Similarity as a fraction: 100 * common >= 75 * all.
COMMON, ALL = 75, 100
#: Sub-partitions of a partition, and how many of them are left out of a signature.
N2, K2 = 3, 2
#: A link's distance with what floating point may add, and the width of a ring of distances.
LINK = 1 - COMMON / ALL + 1e-9
RING = 1 - COMMON / ALL + 1e-6
#: Signatures that one differing shingle can spoil.
SPOILED = comb(N2 - 1, N2 - K2 - 1)
#: Mean shingles of a sub-partition for the largest sets of a band.
FILL = 2.8
MOST_SHARING = 16
#: Times that sets with too few shared signatures are taken out.
PEELS = 2
#: Ids and classes are broadcast up to so many; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Members of a group outside its main component that are paired in one task; more are split.
SIDE = 512
CACHE_WORDS = 200_000
#: Classes whose signatures a task remembers to have given.
CACHE_CLASSES = 100_000
#: Characters of text that are shingled together.
CHUNK_CHARS = 500_000
NULL_ID = -(2**63)

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _Q
    return (x ^ (x >> np.uint64(29))) * _P


class _Words(dict):
    """Numbers of words: short words are their own bytes behind a one, others a digest."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = int.from_bytes(word + b"\1" if len(word) < 8 else hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


class Shingler:
    """Hashes of the distinct shingles of texts; words are numbered once."""

    def __init__(self) -> None:
        self.words = _Words()

    def __call__(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The sets one after the other, each sorted, and their bounds."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        rows = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        words = np.fromiter(map(self.words.__getitem__, chain.from_iterable(rows)), np.uint64, int(n.sum()))
        size = np.minimum(n, SHINGLE)
        count = np.where(n > 0, n - size + 1, 0)
        upto = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(upto[-1]) + np.repeat(np.cumsum(n) - n - upto[:-1], count)
        sizes = np.repeat(size, count)
        out = sizes.astype(np.uint64)
        for k in range(SHINGLE):
            longer = k < sizes
            out[longer] = out[longer] * _P + words[at[longer] + k]
        out = _mix(out)
        for lo, hi in zip(upto[:-1], upto[1:], strict=True):
            out[lo:hi].sort()
        fresh = np.ones(len(out), bool)
        fresh[1:] = out[1:] != out[:-1]
        fresh[upto[:-1][count > 0]] = True
        return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[upto]


def chunks(batch: Sequence[str | None]) -> Iterator[slice]:
    """Parts of a batch of CHUNK_CHARS characters, or of one text."""
    lo = chars = 0
    for k, text in enumerate(batch):
        if k > lo and chars + len(text or "") > CHUNK_CHARS:
            yield slice(lo, k)
            lo, chars = k, 0
        chars += len(text or "")
    if len(batch):
        yield slice(lo, len(batch))


def class_of(h: np.ndarray) -> int:
    """63 bits of a set's digest."""
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little") >> 1


def band(size: int) -> int:
    return (size - 1).bit_length()


def partitions(level: int) -> int:
    """n1 of a band: its largest sets have FILL shingles in a sub-partition."""
    return int(-(-(2**level) // (FILL * N2))) or 1


def levels(size: int) -> list[int]:
    """The set's band, and the next if a similar set may be there."""
    own = band(size)
    return [own, own + 1] if size * ALL // COMMON > 2**own else [own]


def _spare(size: int, level: int, usable: int) -> int:
    """Usable signatures beyond those that the differences to any similar set of the level can spoil."""
    largest = min(size * ALL // COMMON, 2**level)
    return usable - SPOILED * ((size + largest) * (ALL - COMMON) // (ALL + COMMON))


def signatures(h: np.ndarray, bounds: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sets one after the other, each for a band of its own: one signature for each partition and kept subset that
    holds a shingle, and whose it is."""
    count = np.diff(bounds)
    n1 = np.array([partitions(x) for x in level], np.int64)
    first = np.cumsum(n1) - n1
    cell = (_mix(h + np.repeat(level + 1, count).astype(np.uint64)) >> np.uint64(16)) % np.repeat(n1 * N2, count).astype(np.uint64)
    at = cell.astype(np.int64) + np.repeat(first * N2, count)
    total = np.zeros(int(n1.sum()) * N2, np.uint64)
    np.add.at(total, at, _mix(h))
    held = np.bincount(at, minlength=len(total)).reshape(-1, N2)
    total = total.reshape(-1, N2)
    owner = np.repeat(np.arange(len(n1)), n1)
    out, whose = [], []
    for number, kept in enumerate(combinations(range(N2), N2 - K2)):
        some = np.flatnonzero(held[:, kept].sum(1))
        mine = owner[some]
        name = ((some - first[mine]).astype(np.uint64) * np.uint64(64) + np.uint64(number)) * np.uint64(64) + level[mine].astype(np.uint64)
        value = np.zeros(len(some), np.uint64)
        for c in kept:
            value = value * _Q + total[some, c]
        out.append(_mix(value + _mix(name)))
        whose.append(mine)
    return np.concatenate(out), np.concatenate(whose)


def _signed(docs: DataFrame) -> DataFrame:
    """Two kinds of rows. Signatures: sig, mark (the class times two, plus one for a signature of the next band).
    Documents: doc (id, set size, class, spare signatures in the band and in the next one; empty if it has none
    there), and any number as sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        seen: dict[int, str] = {}
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("id").to_pylist()
            for part in chunks(texts):
                h, bounds = shingles(texts[part])
                if len(seen) > CACHE_CLASSES:
                    seen.clear()
                classes, fresh = [], {}
                for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    classes.append(c := class_of(h[lo:hi]) if hi > lo else None)
                    if c is not None and c not in seen:
                        fresh.setdefault(c, k)
                pick = [(k, c, up, x) for c, k in fresh.items() for up, x in enumerate(levels(int(bounds[k + 1] - bounds[k])))]
                sig, mark = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if pick:
                    sizes = np.array([bounds[k + 1] - bounds[k] for k, *_ in pick])
                    level = np.array([x for *_, x in pick])
                    sig, whose = signatures(np.concatenate([h[bounds[k] : bounds[k + 1]] for k, *_ in pick]), np.concatenate([[0], np.cumsum(sizes)]), level)
                    mark = np.array([c * 2 - 2**63 + up for _, c, up, _ in pick], np.int64)[whose]
                    usable = np.bincount(whose, minlength=len(pick))
                    spare: dict[int, list[int]] = {}
                    for (_, c, _, x), size, n in zip(pick, sizes, usable, strict=True):
                        spare.setdefault(c, []).append(_spare(int(size), x, int(n)))
                    seen.update((c, " ".join(map(str, s))) for c, s in spare.items())
                stated = ["" if i is None else str(i) for i in ids[part]]
                told = [f"{i} {hi - lo} {'' if c is None else c} {seen.get(c, '')}" for i, c, lo, hi in zip(stated, classes, bounds[:-1], bounds[1:], strict=True)]
                spread = _mix(np.arange(len(told), dtype=np.uint64) + np.uint64(len(h)))
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate([sig, spread]).view(np.int64)),
                        pa.concat_arrays([pa.array(mark, pa.int64()), pa.nulls(len(told), pa.int64())]),
                        pa.concat_arrays([pa.nulls(len(sig), pa.string()), pa.array(told, pa.string())]),
                    ],
                    ["sig", "mark", "doc"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(run, "sig long, mark long, doc string")


def _signatures(docs: DataFrame) -> DataFrame:
    """sig, cls, up, hot: signatures that several classes share; and doc: the documents (see _signed)."""
    mark = F.col("mark")
    w = Window.partitionBy("sig")
    n, lo, hi = F.count(mark).over(w), F.min(F.shiftright(mark, 1)).over(w), F.max(F.shiftright(mark, 1)).over(w)
    found = _signed(docs).repartition("sig").select("sig", "mark", "doc", n.alias("n"), lo.alias("lo"), hi.alias("hi"))
    # half of a mark is its class, moved by as much as keeps marks in range
    return found.where((F.col("lo") < F.col("hi")) | F.col("doc").isNotNull()).select(
        "sig", (F.shiftright(mark, 1) + F.lit(2**62)).alias("cls"), mark.bitwiseAND(1).cast("int").alias("up"), (F.col("n") > MOST_SHARING).alias("hot"), "doc"
    )


def _documents(signed: DataFrame) -> DataFrame:
    """doc_id, n_shingles, cls, own and up: spare signatures in the band and in the next one."""
    parts = F.split("doc", " ")
    names = {"doc_id": "long", "n_shingles": "long", "cls": "long", "own": "int", "up": "int"}
    return signed.where("doc is not null").select(*[F.nullif(F.get(parts, F.lit(k)), F.lit("")).cast(t).alias(c) for k, (c, t) in enumerate(names.items())])


def _peeled(groups: DataFrame, level: DataFrame, work: Workspace) -> DataFrame:
    """groups (sig, cls, up) without what cannot hold a link: a set shares with any similar one at least the signatures
    that their differences cannot spoil (need), so a set with fewer goes, and then signatures that one class is left with."""
    counts = groups.groupBy("cls", "up").agg(F.count("*").alias("n")).join(level, ["cls", "up"]).where("n >= need")
    kept = work(groups.join(counts.select("cls", "up"), ["cls", "up"], "left_semi"), "peeled")
    several = kept.groupBy("sig").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select("sig")
    return work(kept.join(several, "sig", "left_semi"), "peeled")


def _few(df: DataFrame) -> DataFrame:
    """With a hint to broadcast it where it has few rows, which are counted."""
    return F.broadcast(df) if df.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else df


def _sets(docs: DataFrame, wanted: DataFrame, work: Workspace) -> DataFrame:
    """cls, h: the sets of the classes in wanted (cls, rep: the id of one of its documents)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler()
        for batch in batches:
            texts, want = batch["text"].tolist(), batch["want"].to_numpy()
            for part in chunks(texts):
                h, bounds = shingles(texts[part])
                sets = [h[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
                same = [k for k, x in enumerate(sets) if class_of(x) == want[part][k]]
                if same:
                    yield pd.DataFrame({"cls": want[part][same], "h": [sets[k].view(np.int64) for k in same]})

    ids = _few(wanted.select(F.col("rep").alias("id"), F.col("cls").alias("want")))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "text").join(ids, "id").select("want", "text")
    return work(work(texts.mapInPandas(run, "cls long, h array<long>"), "sets").dropDuplicates(["cls"]), "class-sets")


def _measured(pairs: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """Pairs a, b of classes whose sizes may fit, with the distance d of their sets and whether they are linked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            far, linked = [], []
            for x, y in zip(batch["ha"], batch["hb"], strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                either = len(x) + len(y) - both
                far.append(1 - both / either)
                linked.append(ALL * both >= COMMON * either)
            if far:
                yield batch[["a", "b"]].assign(d=far, linked=linked)

    # sizes first: they rule out many pairs before any set is moved
    x, y = (sets.select(F.col("cls").alias(c), F.size("h").alias(f"n{c}")) for c in "ab")
    fits = F.least("na", "nb") * ALL >= F.greatest("na", "nb") * COMMON
    pairs = work(pairs.join(x, "a").join(y, "b").where(fits).select("a", "b"), "fitting-pairs")
    x, y = (sets.select(F.col("cls").alias(c), F.col("h").alias(f"h{c}")) for c in "ab")
    found = pairs.join(x, "a").join(y, "b").select("a", "b", "ha", "hb").mapInPandas(run, "a long, b long, d double, linked boolean")
    return work(found, "measured")


def _still_open(named: DataFrame, measured: DataFrame, work: Workspace) -> DataFrame:
    """Pairs a, b in one group but not in one component that may be linked. One of the two is outside the component of the
    group's typical set, so those outside meet all members, and members inside never meet each other. Three proofs spare
    more: their distances to the typical set differ by more than a link's distance (members meet those of their own and the
    neighbouring rings around it, or all if that distance isn't known); a rare shingle stands too far back in their sets to
    be the first that they share; or they have been measured. Of more than SIDE members outside each is dealt to one of
    several parts and meets the others there."""
    typical = F.max(F.when(F.col("cls") == F.col("pivot"), F.col("root"))).alias("main")
    main = named.groupBy("g").agg(typical, F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("g", "main")
    far = measured.select(F.col("a").alias("pivot"), F.col("b").alias("cls"), "d")
    left = named.join(main, "g").join(far, ["pivot", "cls"], "left").withColumn("outside", F.col("root") != F.col("main"))
    d = F.when(F.col("cls") == F.col("pivot"), 0.0).otherwise(F.col("d"))
    # a ring is a little wider than a link's distance; -1: of unknown distance
    left = left.withColumn("d", d).withColumn("ring", F.coalesce(F.floor(F.col("d") / RING), F.lit(-1)).cast("int"))
    left = work(left.select("g", "cls", "root", "d", "pos", "n", "outside", "ring"), "open-groups")
    parts = left.where("outside").groupBy("g").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("parts"))
    ring = F.col("ring")
    around = F.when(ring < 0, F.sequence(F.lit(-1), F.lit(int(1 / RING)))).otherwise(F.array(F.lit(-1), ring - 1, ring, ring + 1))
    around = F.array_distinct(around)  # ring 0 has the unknown ones below it
    left = left.join(parts, "g")
    columns = ("cls", "root", "d", "pos", "n")
    x = left.where("outside").select("g", "ring", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("part"), *[F.col(c).alias(f"{c}_a") for c in columns])
    y = left.select("g", F.explode(around).alias("ring"), "parts", "outside", *columns)
    y = y.select("g", "ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "outside", *[F.col(c).alias(f"{c}_b") for c in columns])
    # the least that similar sets share
    common = F.ceil((F.col("n_a") + F.col("n_b")) * COMMON / (ALL + COMMON))
    early = (F.col("n_a") - F.col("pos_a") >= common) & (F.col("n_b") - F.col("pos_b") >= common)
    near = F.abs(F.col("d_a") - F.col("d_b")) <= LINK
    once = ~F.col("outside") | (F.col("cls_a") < F.col("cls_b"))
    rule = (F.col("root_a") != F.col("root_b")) & once & F.coalesce(near, F.lit(True)) & F.coalesce(early, F.lit(True))
    pairs = x.join(y, ["g", "ring", "part"]).where(rule).select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct()
    known = measured.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return work(pairs.join(known, ["a", "b"], "left_anti"), "more-pairs")


def _rare_groups(sets: DataFrame, work: Workspace) -> DataFrame:
    """g, cls, pos, n, typical: classes by their rarest shingles, as many as a similar set must share one of; pos: how many
    of its n shingles are rarer; typical: how many sets share one of its shingles on average."""
    parts = work(sets.select("cls", F.size("h").alias("n"), F.explode("h").alias("g")), "shingles")
    seen = parts.groupBy("g").agg(F.count("*").alias("df"))
    ordered = parts.join(seen, "g").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("o"), F.first("n").alias("n"), F.avg("df").alias("typical"))
    prefix = F.col("n") - F.ceil(F.col("n") * COMMON / ALL) + 1
    rare = ordered.select("cls", "n", "typical", F.posexplode(F.slice("o", F.lit(1), prefix.cast("int"))).alias("pos", "x"))
    return rare.where("x.df > 1").select(F.col("x.g").alias("g"), "cls", "pos", "n", "typical")


def _links(docs: DataFrame, signed: DataFrame, classes: DataFrame, work: Workspace) -> DataFrame:
    """node, root: classes that are linked with others, and the smallest class of their component."""
    shared = signed.where("doc is null").select("sig", "cls", "up", "hot")
    hot = shared.where("hot").groupBy("cls").agg(F.sum(1 - F.col("up")).alias("hot_own"), F.sum("up").alias("hot_up"))
    spare = F.col("own") - F.coalesce("hot_own", F.lit(0)), F.col("up") - F.coalesce("hot_up", F.lit(0))
    needs = work(classes.join(hot, "cls", "left").select("cls", "rep", spare[0].alias("own"), spare[1].alias("up")), "needs")
    unproven = needs.where("own <= 0 or up <= 0").select("cls")
    level = needs.select("cls", F.lit(0).alias("up"), F.col("own").alias("need")).unionByName(needs.where("up is not null").select("cls", F.lit(1).alias("up"), F.col("up").alias("need")))
    groups = shared.where("not hot").select("sig", "cls", "up")
    for _ in range(PEELS):
        groups = _peeled(groups, level, work)
    groups = groups.select(F.col("sig").alias("g"), "cls").distinct()
    wanted = groups.select("cls").unionByName(unproven).distinct().join(needs.select("cls", "rep"), "cls")
    sets = _sets(docs, work(wanted, "wanted"), work)
    rare = _rare_groups(sets.join(unproven, "cls", "left_semi"), work)
    groups = groups.withColumns({"pos": F.lit(None).cast("int"), "n": F.lit(None).cast("int"), "typical": F.lit(0.0)})
    groups = work(groups.unionByName(rare), "groups")
    # a family's most typical set is likeliest to be linked with all of it
    first = groups.groupBy("g").agg(F.max_by("cls", F.struct("typical", -F.col("cls"))).alias("pivot"))
    groups = work(groups.join(first, "g").drop("typical"), "groups")
    pairs = groups.where("cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    measured = _measured(pairs, sets, work)
    links = measured.where("linked").select("a", "b")
    labels = connected(links, work)
    named = groups.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    more = _measured(_still_open(work(named, "named-groups"), measured, work), sets, work)
    return connected(links.unionByName(more.where("linked").select("a", "b")), work)


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links)."""
    signed = staged(_signatures(docs), "signatures")
    known = _documents(signed)
    work = Workspace(docs.sparkSession, "ngramjoin")
    classes = known.where("n_shingles > 0").groupBy("cls").agg(
        F.min(F.coalesce("doc_id", F.lit(NULL_ID))).alias("rep"), F.first("own").alias("own"), F.first("up").alias("up"), F.count("*").alias("copies")
    )
    classes = work(classes, "classes")
    labels = _links(docs, signed, classes, work).withColumnRenamed("node", "cls")
    # classes whose documents have another id than their own as the smallest
    linked = work(classes.join(labels, "cls", "left").where("root is not null or copies > 1").select("cls", "rep", F.coalesce("root", "cls").alias("root")), "linked")
    least = _few(work(linked.groupBy("root").agg(F.min("rep").alias("component")), "least"))
    found = staged(linked.join(least, "root").select("cls", "component"), "components")
    work.close()
    out = known.join(_few(found), "cls", "left")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.nullif("component", F.lit(NULL_ID)))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))
