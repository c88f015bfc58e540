"""Time spans free of scene cuts, from a boundary score for every frame, and clips tiled into them.

Series are rows (video, frame, score); spans are rows (video, start, end). Everything is keyed by video.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.numbers import EPSILON, clip_name, frame_guard


def combined_scores(one: Column, other: Column) -> Column:
    """Frame by frame the larger of two heads' scores; raises where their lengths differ."""
    return F.when(F.size(one) == F.size(other), F.zip_with(one, other, lambda a, b: F.greatest(a, b))).otherwise(
        F.raise_error(F.lit("boundary heads differ in length"))
    )


def unsafe_spans(scores: DataFrame, threshold: float, padding: float, guard: float | None = None) -> DataFrame:
    """scores: video, frame, score, fps, duration. A run of frames at the threshold or above, padded on both sides by
    padding and guard (a frame by default), within the video."""
    pad = F.lit(padding) + (F.lit(guard) if guard is not None else frame_guard(F.col("fps")))
    w = Window.partitionBy("video").orderBy("frame")
    hot = scores.withColumn("row", F.row_number().over(w)).where(F.col("score") >= threshold)
    runs = hot.withColumn("run", F.col("row") - F.row_number().over(w))
    ends = runs.groupBy("video", "run").agg(
        F.min("frame").alias("first"), (F.max("frame") + 1).alias("past"), F.first("fps").alias("fps"), F.first("duration").alias("duration")
    )
    return ends.select(
        "video",
        F.greatest(F.lit(0.0), F.col("first") / F.col("fps") - pad).alias("start"),
        F.least(F.col("duration"), F.col("past") / F.col("fps") + pad).alias("end"),
    )


def merged_spans(spans: DataFrame) -> DataFrame:
    """Touching and overlapping spans become one; empty ones go."""
    w = Window.partitionBy("video").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("start") > before + EPSILON), 1).otherwise(0)
    named = spans.where(F.col("end") - F.col("start") > EPSILON).withColumn("fresh", fresh)
    named = named.withColumn("n", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return named.groupBy("video", "n").agg(F.min("start").alias("start"), F.max("end").alias("end")).select("video", "start", "end")


def inverted_spans(spans: DataFrame, videos: DataFrame) -> DataFrame:
    """What merged spans leave of each video (video, duration); a video without spans is left whole."""
    w = Window.partitionBy("video").orderBy("start")
    gaps = spans.select("video", F.lag("end", 1, 0.0).over(w).alias("start"), F.col("start").alias("end"))
    last = spans.groupBy("video").agg(F.max("end").alias("start"))
    tails = videos.join(last, "video", "left").select("video", F.coalesce("start", F.lit(0.0)).alias("start"), F.col("duration").alias("end"))
    return gaps.unionByName(tails).where(F.col("end") - F.col("start") > EPSILON)


def long_enough(spans: DataFrame, shortest: float) -> DataFrame:
    return spans.where(F.col("end") - F.col("start") + EPSILON >= shortest)


def safe_spans(scores: DataFrame, videos: DataFrame, threshold: float, padding: float, shortest: float, guard: float | None = None) -> DataFrame:
    return long_enough(inverted_spans(merged_spans(unsafe_spans(scores, threshold, padding, guard)), videos), shortest)


def tiled_fixed(spans: DataFrame, length: float, gap: float) -> DataFrame:
    """Clips of one length, one after the other with a gap, from the start of every span; numbered by video."""
    room = F.floor((F.col("end") - F.col("start") - length + EPSILON) / (length + gap)).cast("int")
    slots = spans.where(F.col("end") - F.col("start") + EPSILON >= length).select("video", F.col("start").alias("s"), F.explode(F.sequence(F.lit(0), room)).alias("k"))
    start = F.col("s") + F.col("k") * (length + gap)
    clips = slots.select("video", start.alias("start"), (start + length).alias("end"))
    index = F.row_number().over(Window.partitionBy("video").orderBy("start"))
    clips = clips.withColumn("clip_index", index)
    return clips.withColumn("clip", clip_name(F.col("video").cast("string"), F.col("clip_index"), F.col("start"), F.col("end")))


def video_seed(seed: int, path: str) -> int:
    """Unsigned 64 bits that depend on the seed and the video."""
    return int.from_bytes(hashlib.sha256(f"{seed}:{path}".encode()).digest()[:8], "big")


def seed_column(seed: int, path: Column) -> Column:
    """video_seed as a decimal string."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), path).cast("binary"), 256), 1, 16), 16, 10)


@F.udtf(returnType=T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType())]))
class RandomTiles:
    """Clips of random lengths within a video's spans; one generator for all of them, in order."""

    def eval(self, seed: str, starts: list, ends: list, shortest: float, longest: float, gap: float) -> Iterator[tuple]:
        rng = random.Random(int(seed))
        for at, end in zip(starts, ends, strict=True):
            while end - at + EPSILON >= shortest:
                most = min(longest, end - at)
                length = shortest if abs(most - shortest) <= EPSILON else rng.uniform(shortest, most)
                yield at, min(at + length, end)
                at += length + gap


def tiled_seeded(spans: DataFrame, seed: int, shortest: float, longest: float, gap: float) -> DataFrame:
    """Reproducible clips of random lengths; a video's spans are few, and only they meet in a row."""
    grouped = spans.groupBy("video").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    seeded = grouped.withColumn("seed", seed_column(seed, F.col("video").cast("string")))
    given = [F.col(c).outer() for c in ("seed", "s.start", "s.end")]
    tiles = seeded.lateralJoin(RandomTiles(*given, *[F.lit(float(x)) for x in (shortest, longest, gap)])).select("video", "start", "end")
    index = F.row_number().over(Window.partitionBy("video").orderBy("start"))
    return tiles.withColumn("clip_index", index).withColumn("clip", clip_name(F.col("video").cast("string"), F.col("clip_index"), F.col("start"), F.col("end")))
