"""Resolution and frame-count buckets for clips: projection, seed, greedy selection, assignment.

Feature points are distinct (width, height, frames) with the number of their clips; those of one aspect ratio and frame count
are one position for the greedy picks. Total costs add up by axis, from running
sums. A point's gain falls from its distance to the nearest pick to nothing, evenly. To candidates of one frame count it is a
tent over the aspect, so the gains of all of them are running sums over the tents' feet and tips, in blocks. Beyond PAIRWISE
positions it is four triangles around the point; a triangle is two corners of the plane less one, so the gains of all
candidates are twelve sums over points below and left of them, in near-linear time. Both carry rounding errors of all that is
added up; so the leading candidates, with a margin for that, are measured again pair by pair. Gains only fall as picks are
made, so a pass over all candidates serves many picks: the driver holds the HELD best of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import log_distance, quantized_frames, rounded
from .dominance import dominance_sums
from .ordering import running

# Fixed values of the bucket grid.
MULTIPLE, RADIUS, MOST_BUCKETS, LEAST_GAIN = 32, 16, 30, 1e-12
BLOCK = 10_000
HELD = 256
#: Up to so many points gains are summed up by frame count, which takes less time there and gives the same.
PAIRWISE = 200_000
#: Rounding errors of gains from sums, as a share of all weighted distances that are added up.
MARGIN = 1e-10
FEATURE = ["width", "height", "frames", "weight"]
BUCKET = ["bucket_width", "bucket_height", "bucket_frames"]


def feature_points(clips: DataFrame) -> DataFrame:
    """clips: width, height, frames."""
    return clips.groupBy("width", "height", "frames").agg(F.count("*").alias("weight"))


def positions(features: DataFrame) -> DataFrame:
    """The smallest of the features of one aspect ratio and frame count, with the weight of all: they have the same distances
    and the same bucket, and the smallest goes before the others."""
    at = features.groupBy((F.col("width") / F.col("height")).alias("aspect"), "frames")
    out = at.agg(F.min(F.struct("width", "height")).alias("size"), F.sum("weight").alias("weight"))
    return out.select("size.width", "size.height", "frames", "weight")


def _units(ideal: Column) -> Column:
    center = F.greatest(F.lit(1).cast("long"), rounded(ideal / MULTIPLE))
    return F.sequence(F.greatest(F.lit(1).cast("long"), center - RADIUS), center + RADIUS)


def projected_size(aspect: Column, resolution: int) -> Column:
    """struct(width, height): of the multiples of 32 around the ideal size, the one nearest in aspect, then area."""
    root = F.sqrt(aspect)

    def error(w: Column, h: Column) -> Column:
        w, h = w * MULTIPLE, h * MULTIPLE
        return F.struct(
            F.abs(F.ln(w / h / aspect)).alias("e"), F.abs(w * h - resolution * resolution).alias("a"), w.cast("int").alias("width"), h.cast("int").alias("height")
        )

    grid = F.flatten(F.transform(_units(resolution * root), lambda w: F.transform(_units(resolution / root), lambda h: error(w, h))))
    best = F.array_min(grid)
    return F.struct(best["width"].alias("width"), best["height"].alias("height"))


def projected(features: DataFrame, resolution: int) -> DataFrame:
    """Adds bucket_width, bucket_height and bucket_frames. Sizes are projected once per aspect ratio."""
    aspect = F.col("width") / F.col("height")
    sizes = features.select(aspect.alias("aspect")).distinct().withColumn("size", projected_size(F.col("aspect"), resolution))
    out = features.withColumn("aspect", aspect).join(sizes, "aspect")
    return out.select(
        *features.columns, F.col("size.width").alias("bucket_width"), F.col("size.height").alias("bucket_height"), quantized_frames(F.col("frames")).alias("bucket_frames")
    )


def _logs(width: np.ndarray, height: np.ndarray, frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.log(width / height), np.log(frames)


def _axis_costs(features: DataFrame, value: Column, name: str) -> DataFrame:
    """name (a distinct value) and name_cost: the summed weighted distance of its logarithm to those of all features."""
    log = F.ln(name)
    at = features.groupBy(value.alias(name)).agg(F.sum("weight").alias("weight"))
    summed = running(at, [F.col(name)], {"below": F.col("weight"), "mass": F.col("weight") * log})
    whole = at.agg(F.sum("weight").alias("all"), F.sum(F.col("weight") * log).alias("all_mass"), F.lit(1).alias("k"))
    both = summed.withColumn("k", F.lit(1)).join(F.broadcast(whole), "k")  # one row
    cost = log * (2 * F.col("below") - F.col("all")) + F.col("all_mass") - 2 * F.col("mass")
    return both.select(name, cost.alias(f"{name}_cost"))


def total_costs(features: DataFrame) -> DataFrame:
    """features with cost: the summed weighted distance to all features, axis by axis."""
    aspect = F.col("width") / F.col("height")
    aspects, frames = _axis_costs(features, aspect, "aspect"), _axis_costs(features, F.col("frames"), "frames")
    out = features.withColumn("aspect", aspect).join(aspects, "aspect").join(frames, "frames")
    return out.select(*features.columns, (F.col("aspect_cost") + F.col("frames_cost")).alias("cost"))


def seed(features: DataFrame) -> DataFrame:
    """The feature with the lowest total cost; ties by aspect, frames, width, height."""
    key = F.struct(F.round("cost", 9).alias("c"), (F.col("width") / F.col("height")).alias("a"), "frames", "width", "height")
    return total_costs(features).agg(F.min_by(F.struct("width", "height", "frames", "cost"), key).alias("x")).select("x.*")


def greedy(features: DataFrame, resolution: int, most: int = MOST_BUCKETS) -> DataFrame:
    """bucket_width, bucket_height, bucket_frames, pick: the seed, then each time the feature whose bucket lowers the
    total distance most. The driver holds the picks and the HELD best candidates of the last pass over all; these are
    measured again for each pick, and all are when none of them stays ahead of the first that was left out."""
    spark = features.sparkSession
    points = projected(positions(features), resolution).repartition(spark.sparkContext.defaultParallelism).persist()
    try:
        picks = _picks(points, seed(features).first(), most)
    finally:
        points.unpersist()
    rows = [(*(p[c] for c in BUCKET), k) for k, p in enumerate(picks, 1)]
    return spark.createDataFrame(rows, "bucket_width int, bucket_height int, bucket_frames long, pick int")


def _picks(points: DataFrame, first, most: int) -> list:
    if first is None or first["width"] is None:
        return []
    picks = [points.where((F.col("width") == first["width"]) & (F.col("height") == first["height"]) & (F.col("frames") == first["frames"])).first()]
    size = points.count()
    held: list = []
    bound = np.inf  # the largest gain that a candidate which is not held can have
    while len(picks) < most:
        taken = {tuple(p[c] for c in BUCKET) for p in picks}
        near = _with_distance(points, picks)
        held = [c for c in held if tuple(c[x] for x in BUCKET) not in taken]
        best = _best(_held_gains(near, held), held) if held else None
        if bound > LEAST_GAIN and (best is None or round(best[1], 9) <= round(bound, 9)):
            held, bound = _leaders(near, taken, size)
            best = _best([c["gain"] for c in held], held)
        if best is None:
            break
        picks.append(best[0])
    return picks


def _with_distance(points: DataFrame, picks: list) -> DataFrame:
    """points with near: the distance to the nearest picked feature (MOST_BUCKETS at most)."""
    xs, ys = _logs(*np.array([[p[c] for c in FEATURE[:3]] for p in picks], float).T)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            la, lf = _logs(*(batch[c].to_numpy(float) for c in FEATURE[:3]))
            near = np.full(len(batch), np.inf)
            for x, y in zip(xs, ys, strict=True):
                np.minimum(near, np.abs(la - x) + np.abs(lf - y), out=near)
            yield batch.assign(near=near)

    return points.mapInPandas(run, ", ".join(f"{c} {kind}" for c, kind in points.dtypes) + ", near double")


def _gains(candidates: pd.DataFrame, points: pd.DataFrame) -> list[float]:
    """Points are sorted by aspect, so that each candidate meets those alone that may be in reach."""
    xs, ys = _logs(*(candidates[c].to_numpy(float) for c in FEATURE[:3]))
    la, lf = _logs(*(points[c].to_numpy(float) for c in FEATURE[:3]))
    order = np.argsort(la, kind="stable")
    la, lf, near, weight = la[order], lf[order], points["near"].to_numpy()[order], points["weight"].to_numpy(float)[order]
    reach = near.max(initial=0.0)
    reach += 1e-9 * (1 + reach)  # for rounding of the bounds
    first, last = np.searchsorted(la, xs - reach), np.searchsorted(la, xs + reach, "right")
    out = []
    for x, y, i, j in zip(xs, ys, first, last, strict=True):
        left = near[i:j] - np.abs(la[i:j] - x)
        left -= np.abs(lf[i:j] - y)
        np.maximum(left, 0, out=left)
        left *= weight[i:j]
        out.append(float(left.sum()))
    return out


def _tents(candidates: pd.DataFrame, points: pd.DataFrame) -> np.ndarray:
    """As _gains, but for rounding: by frame count, from sums over the points' tents between the candidates' aspects."""
    xs, ys = _logs(*(candidates[c].to_numpy(float) for c in FEATURE[:3]))
    la, lf = _logs(*(points[c].to_numpy(float) for c in FEATURE[:3]))
    near, weight = points["near"].to_numpy(), points["weight"].to_numpy(float)
    order = np.lexsort((xs, ys))
    rows = np.split(order, np.flatnonzero(np.diff(ys[order])) + 1)
    if 8 * len(rows) > len(xs):  # hardly any in a row
        return np.array(_gains(candidates, points))
    out = np.zeros(len(xs))
    for row in rows:
        x, left = xs[row], near - np.abs(lf - ys[row[0]])
        some = np.flatnonzero(left > 0)
        a, r, w = la[some], left[some], weight[some]
        foot, tip, end = (np.searchsorted(x, at) for at in (a - r, a, a + r))

        def steps(at: np.ndarray, by: np.ndarray, n: int = len(x) + 1) -> np.ndarray:
            return np.bincount(at, by, n)

        level = steps(foot, w * (r - a)) + steps(tip, 2 * w * a) - steps(end, w * (r + a))
        slope = steps(foot, w) - 2 * steps(tip, w) + steps(end, w)
        out[row] = np.cumsum(level)[:-1] + np.cumsum(slope)[:-1] * x
    return out


def _held_gains(near: DataFrame, held: list) -> list[float]:
    """The gain of each held candidate, from sums by task."""
    shared = near.sparkSession.sparkContext.broadcast(pd.DataFrame([[c[x] for x in FEATURE] for c in held], columns=FEATURE))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(shared.value))
        for batch in batches:
            total += _gains(shared.value, batch)
        yield pd.DataFrame({"at": range(len(total)), "gain": total})

    sums = near.select(*FEATURE, "near").mapInPandas(run, "at int, gain double").groupBy("at").agg(F.sum("gain").alias("gain"))
    found = {r["at"]: r["gain"] for r in sums.collect()}
    return [found.get(k, 0.0) for k in range(len(held))]


def _leaders(near: DataFrame, taken: set, size: int) -> tuple[list, float]:
    """The HELD first candidates by gain and tie order (features whose bucket is not taken), and the gain of the first one left
    out (0 if none is). Those that the sums show to be behind the HELD first, by more than the sums can err, are not measured."""
    free = near.where(~F.struct(*BUCKET).isin([F.struct(F.lit(w), F.lit(h), F.lit(f).cast("long")) for w, h, f in taken]))
    blocks = -(-size // BLOCK)
    summed = _by_frames(near, free, blocks) if size <= PAIRWISE else free.join(_summed_gains(near, free), FEATURE[:3])
    summed = summed.select(*FEATURE, *BUCKET, "total").persist()
    try:
        x, y = _coordinates()
        # rounding errors grow with the places of points and of candidates
        added = near.agg(F.sum(F.col("weight") * (F.col("near") + F.abs(x) + F.abs(y))) + F.sum("weight") * F.max(F.abs(x))).first()[0]
        first = summed.orderBy(F.desc("total")).limit(2 * HELD + 1).collect()
        least = first[HELD]["total"] - 2 * MARGIN * added if len(first) > HELD else -np.inf
        if len(first) <= 2 * HELD or first[-1]["total"] < least:
            ahead = [c.asDict() for c in first if c["total"] >= least]
            ahead = [{**c, "gain": gain} for c, gain in zip(ahead, _held_gains(near, ahead), strict=True) if gain > LEAST_GAIN]
            ahead.sort(key=lambda c: _order(c, c["gain"]))
            return ahead[:HELD], ahead[HELD]["gain"] if len(ahead) > HELD else 0.0
        ahead = summed.where(F.col("total") >= least)
        return _leading(_measured(near, ahead, -(-ahead.count() // BLOCK), blocks))
    finally:
        summed.unpersist()


def _coordinates() -> tuple[Column, Column]:
    return F.ln(F.col("width") / F.col("height")), F.ln("frames")


def _summed_gains(near: DataFrame, free: DataFrame) -> DataFrame:
    """width, height, frames and total: the gain of each candidate, summed up over points.

    Mirrored by signs, a triangle is x >= a, y >= b, x + y <= a + b + r, with the gain r + a + b - (x + y); that is what
    meets the first and the last condition, less what misses the second and meets the last, plus what misses the first two.
    A mirrored condition is strict, so every place is in one triangle.
    """
    x, y = _coordinates()
    r, w = F.col("near"), F.col("weight").cast("double")
    zero = F.lit(0.0)
    sides = {True: [], False: []}
    for sx, sy in ((1, 1), (1, -1), (-1, 1), (-1, -1)):
        a, b = x * sx, y * sy
        level = a + b
        edge = -(level + r)
        # sign; p of points and of places, and whether equal ones don't count; q and so on
        corners = [
            (1, a, a, sx < 0, edge, -level, False),
            (-1, -b, -b, sy > 0, edge, -level, False),
            (1, -a, -a, sx > 0, -b, -b, sy > 0),
        ]
        for sign, p, p_place, p_strict, q, q_place, q_strict in corners:
            kind = F.lit(len(sides[True]))
            # of equal coordinates places come after points, unless equal ones don't count
            turns = [(F.lit(int(p_strict)), F.lit(int(q_strict))), (F.lit(int(not p_strict)), F.lit(int(not q_strict)))]
            point = (kind, F.lit(False), p, turns[0][0], q, turns[0][1], sign * w * (r + level), sign * w, zero)
            place = (kind, F.lit(True), p_place, turns[1][0], q_place, turns[1][1], zero, zero, -level)
            for asks, row in ((False, point), (True, place)):
                names = ("kind", "asks", "p", "p_turn", "q", "q_turn", "a", "b", "m")
                sides[asks].append(F.struct(*[c.alias(n) for c, n in zip(row, names, strict=True)]))
    keys = FEATURE[:3]
    points = near.where("near > 0").select(*keys, F.inline(F.array(*sides[False])))
    places = free.select(*keys, F.inline(F.array(*sides[True])))
    return dominance_sums(points.unionByName(places), keys, BLOCK)


def _by_frames(near: DataFrame, free: DataFrame, blocks: int) -> DataFrame:
    """Candidates with total: their gain from sums, one row of candidates (of a frame count) after the other."""
    wide = max(blocks, near.sparkSession.sparkContext.defaultParallelism)
    return _in_blocks(near, free, (wide, -(-blocks // 5)), ["frames"], _tents, "total")  # sums take less memory than pairs


def _measured(near: DataFrame, free: DataFrame, candidate_blocks: int, point_blocks: int) -> DataFrame:
    """Candidates with their gain, pair by pair."""
    return _in_blocks(near, free, (candidate_blocks, point_blocks), FEATURE[:3], _gains, "gain")


def _in_blocks(near: DataFrame, free: DataFrame, blocks: tuple[int, int], keys: list[str], gains: Callable, name: str) -> DataFrame:
    """Candidates with the sum of gains to all points; blocks of both sides meet in a group, candidates with equal keys in one."""

    def block(n: int, by: list[str]) -> Column:
        return F.pmod(F.xxhash64(*by), F.lit(max(n, 1))).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))

    columns = [*FEATURE, *BUCKET]
    left = free.select(*columns, block(blocks[0], keys).alias("i"), every(blocks[1]).alias("j"))
    right = near.select(*FEATURE, "near", block(blocks[1], FEATURE[:3]).alias("j"), every(blocks[0]).alias("i"))
    # columns of their own, as both come from one table; groups are few bytes and much work, so their number of tasks is given
    tasks = 2 * near.sparkSession.sparkContext.defaultParallelism
    left, right = (side.toDF(*side.columns).repartition(tasks, "i", "j") for side in (left, right))
    types = dict(free.dtypes)

    def run(candidates: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        return candidates[columns].assign(**{name: gains(candidates, points)})

    parts = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(run, ", ".join(f"{c} {types[c]}" for c in columns) + f", {name} double")
    return parts.groupBy(*columns).agg(F.sum(name).alias(name))


def _leading(gains: DataFrame) -> tuple[list, float]:
    """The HELD first candidates by gain and tie order, and the gain of the first one left out (0 if none is)."""
    bucket_aspect, aspect = F.col("bucket_width") / F.col("bucket_height"), F.col("width") / F.col("height")
    order = [F.desc(F.round("gain", 9)), bucket_aspect, "bucket_frames", "bucket_width", "bucket_height", aspect, "frames", "width", "height"]
    top = gains.where(F.col("gain") > LEAST_GAIN).orderBy(*order).limit(HELD + 1).collect()
    return top[:HELD], top[HELD]["gain"] if len(top) > HELD else 0.0


def _best(gains: list[float], held: list):
    """The held candidate with the largest gain, by the tie order, and that gain; None if none gains."""
    able = [k for k in range(len(held)) if gains[k] > LEAST_GAIN]
    return (held[k], gains[k]) if able and (k := min(able, key=lambda k: _order(held[k], gains[k]))) is not None else None


def _order(c, gain: float) -> tuple:
    return -round(gain, 9), c["bucket_width"] / c["bucket_height"], c["bucket_frames"], c["bucket_width"], c["bucket_height"], c["width"] / c["height"], c["frames"], c["width"], c["height"]


def assigned(features: DataFrame, buckets: DataFrame) -> DataFrame:
    """The weight of the features nearest to each bucket, 0 for buckets without any. Ties by aspect, frames, width, height.
    buckets has at most MOST_BUCKETS or so rows, the driver's own picks, which every feature row carries as an array."""
    listed = buckets.agg(F.collect_list(F.struct("bucket_width", "bucket_height", "bucket_frames")).alias("all"))
    ratio = F.col("width") / F.col("height")

    def key(b: Column) -> Column:
        aspect = b["bucket_width"] / b["bucket_height"]
        distance = log_distance(aspect, b["bucket_frames"], ratio, F.col("frames"))
        return F.struct(F.round(distance, 12).alias("d"), aspect.alias("a"), b["bucket_frames"].alias("f"), b["bucket_width"].alias("w"), b["bucket_height"].alias("h"))

    one = features.withColumn("k", F.lit(1)).join(F.broadcast(listed.withColumn("k", F.lit(1))), "k")
    near = one.select("weight", F.array_min(F.transform("all", key)).alias("b"))
    sums = near.groupBy(F.col("b.w").alias("bucket_width"), F.col("b.h").alias("bucket_height"), F.col("b.f").alias("bucket_frames")).agg(F.sum("weight").alias("weight"))
    return buckets.select("bucket_width", "bucket_height", "bucket_frames").join(sums, ["bucket_width", "bucket_height", "bucket_frames"], "left").withColumn("weight", F.coalesce("weight", F.lit(0)))


def listed(buckets: DataFrame) -> DataFrame:
    """All buckets as one text, WxHxF joined by ';', in order of aspect, frames, width, height."""
    order = F.struct((F.col("bucket_width") / F.col("bucket_height")).alias("a"), "bucket_frames", "bucket_width", "bucket_height")
    text = F.transform(F.array_sort(F.collect_set(order)), lambda b: F.format_string("%dx%dx%d", b["bucket_width"], b["bucket_height"], b["bucket_frames"]))
    return buckets.agg(F.array_join(text, ";").alias("buckets"))
