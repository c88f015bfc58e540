"""Tags of clips: clean-up, frequencies, statistics by source, distances between distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip
from .ordering import running

# Ratings, and how many hints a caption model gets.
RATINGS = ("general", "sensitive", "questionable", "explicit")
GENERAL_HINTS, CHARACTER_HINTS = 16, 8


def deduped(tags: Column, stripped: bool = True) -> Column:
    """First occurrences in order, without empty ones."""
    clean = F.transform(tags, lambda t: strip(t.cast("string"))) if stripped else tags
    return F.array_distinct(F.filter(clean, lambda t: t.isNotNull() & (t != "")))


def all_tags(every: Column, rating: Column, general: Column, character: Column) -> Column:
    """The list of all tags if there is one, even an empty one; else rating, general and character tags."""
    none = F.array().cast("array<string>")
    parts = F.concat(F.when(rating.isNotNull(), F.array(rating)).otherwise(none), F.coalesce(general, none), F.coalesce(character, none))
    return deduped(F.coalesce(every, parts))


def hints(every: Column, general: Column, character: Column) -> Column:
    """struct(general, character) for a prompt: all tags but ratings stand in where both lists are empty."""
    none = F.array().cast("array<string>")
    g, c = deduped(F.coalesce(general, none)), deduped(F.coalesce(character, none))
    rest = F.filter(deduped(F.coalesce(every, none)), lambda t: ~F.lower(t).isin(*RATINGS))
    g = F.when((F.size(g) == 0) & (F.size(c) == 0), rest).otherwise(g)
    return F.struct(F.slice(g, 1, GENERAL_HINTS).alias("general"), F.slice(c, 1, CHARACTER_HINTS).alias("character"))


def scores_as_doubles(scores: Column) -> Column:
    return F.transform_values(scores, lambda _, v: v.cast("double"))


def exploded(clips: DataFrame, *keys: str) -> DataFrame:
    return clips.select(*keys, F.explode(F.array_distinct("tags")).alias("tag"))


def tag_counts(clips: DataFrame) -> DataFrame:
    """Clips by tag; a clip counts once."""
    return exploded(clips).groupBy("tag").agg(F.count("*").alias("cnt"))


def unique_tags(clips: DataFrame) -> DataFrame:
    return tag_counts(clips).agg(F.count("*").alias("unique_tags"))


def balance_penalty(clips: DataFrame) -> DataFrame:
    return tag_counts(clips).agg(F.coalesce(F.sum(F.col("cnt") * F.col("cnt")), F.lit(0)).cast("long").alias("balance_penalty"))


def source_tag_counts(clips: DataFrame) -> DataFrame:
    return exploded(clips, "source_id").groupBy("source_id", "tag").agg(F.count("*").alias("cnt"))


def source_stats(clips: DataFrame) -> DataFrame:
    """source_id, clip_count, unique_tags, tag_mass."""
    counted = clips.groupBy("source_id").agg(F.count("*").alias("clip_count"))
    tagged = source_tag_counts(clips).groupBy("source_id").agg(F.count("*").alias("unique_tags"), F.sum("cnt").alias("tag_mass"))
    none = F.lit(0).cast("long")
    return counted.join(tagged, "source_id", "left").select(
        "source_id", "clip_count", F.coalesce("unique_tags", none).alias("unique_tags"), F.coalesce("tag_mass", none).alias("tag_mass")
    )


def subtracted(counts: DataFrame, less: DataFrame) -> DataFrame:
    """Difference of two tag, cnt tables; what falls to zero goes."""
    rest = counts.join(less.withColumnRenamed("cnt", "less"), "tag", "left").select("tag", (F.col("cnt") - F.coalesce("less", F.lit(0))).alias("cnt"))
    return rest.where("cnt > 0")


def distribution_distance(one: DataFrame, other: DataFrame) -> DataFrame:
    """Sum of the absolute differences of two sets of clips' tag frequencies; infinite if either is empty."""
    sizes = one.agg(F.count("*").alias("n1")).withColumn("k", F.lit(1)).join(other.agg(F.count("*").alias("n2")).withColumn("k", F.lit(1)), "k")
    a, b = tag_counts(one).withColumnRenamed("cnt", "c1"), tag_counts(other).withColumnRenamed("cnt", "c2")
    pairs = a.join(b, "tag", "full").select(F.coalesce("c1", F.lit(0)).alias("c1"), F.coalesce("c2", F.lit(0)).alias("c2")).withColumn("k", F.lit(1))
    gaps = pairs.join(F.broadcast(sizes), "k").agg(F.sum(F.abs(F.col("c1") * F.col("n2") - F.col("c2") * F.col("n1"))).alias("gap")).withColumn("k", F.lit(1))
    full = (F.col("n1") > 0) & (F.col("n2") > 0)
    return sizes.join(gaps, "k").select(F.when(full, F.coalesce("gap", F.lit(0)) / (F.col("n1") * F.col("n2"))).otherwise(float("inf")).alias("distance"))


def prefix_distances(ranked: DataFrame, target: DataFrame) -> DataFrame:
    """ranked: clips with rank 1, 2, ...; by rank, the distance of the clips so far to the target set's frequencies.

    A tag's running count changes only where it occurs, so its part of the distance is written down there and held: the
    rows of ranks times tags are never made. By rank r the distance is mass + sum over tags seen of
    |count / r - target| - target, which is split into the tags above their target and those below, both linear in 1 / r
    between a tag's events (its occurrences, and the rank where its frequency falls to the target)."""
    n = target.agg(F.count("*").alias("n"))
    wanted = tag_counts(target).withColumn("k", F.lit(1)).join(F.broadcast(n.withColumn("k", F.lit(1))), "k").select("tag", "cnt", "n")
    w = Window.partitionBy("tag").orderBy("rank")
    seen = exploded(ranked, "rank").withColumns({"c": F.row_number().over(w), "until": F.lead("rank").over(w)})
    seen = seen.join(wanted, "tag", "left").withColumn("t", F.coalesce("cnt", F.lit(0)))
    size = F.coalesce("n", F.lit(1))
    # count / r > t / n as long as r < count * n / t: up to there a tag adds count / r - 2 t / n, from there -count / r
    turn = F.when(F.col("t") > 0, F.least(F.coalesce("until", F.lit(2**62)), F.ceil(F.col("c") * size / F.col("t")))).otherwise(F.coalesce("until", F.lit(2**62)))
    over, turn_at = F.col("rank") < F.col("turn"), F.greatest("rank", "turn")
    events = seen.withColumn("turn", turn).select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(over, F.struct(F.col("rank").alias("r"), F.col("c").alias("a"), (-2 * F.col("t")).alias("b"))),
                    F.when(over, F.struct(F.col("turn").alias("r"), (-F.col("c")).alias("a"), (2 * F.col("t")).alias("b"))),
                    F.when(F.coalesce("until", F.lit(2**62)) > turn_at, F.struct(turn_at.alias("r"), (-F.col("c")).alias("a"), F.lit(0).alias("b"))),
                    F.when(F.coalesce("until", F.lit(2**62)) > turn_at, F.struct(F.col("until").alias("r"), F.col("c").alias("a"), F.lit(0).alias("b"))),
                )
            )
        ).alias("e")
    )
    steps = events.where("e.r is not null").groupBy(F.col("e.r").alias("rank")).agg(F.sum("e.a").alias("a"), F.sum("e.b").alias("b"))
    ranks = ranked.select("rank").distinct().join(steps, "rank", "left")
    mass = tag_counts(target).agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("mass")).withColumn("k", F.lit(1)).join(n.withColumn("k", F.lit(1)), "k")
    none = F.lit(0).cast("long")
    sums = running(ranks.select("rank", F.coalesce("a", none).alias("rise"), F.coalesce("b", none).alias("less")), [F.col("rank")], {"a": F.col("rise"), "b": F.col("less")}).withColumn("k", F.lit(1))
    out = sums.join(F.broadcast(mass), "k")
    whole = F.when(F.col("n") > 0, ((F.col("mass") + F.col("b")) * F.col("rank") + F.col("a") * F.col("n")) / (F.col("n") * F.col("rank")))
    return out.select("rank", whole.alias("distribution_distance"))


def largest_validation(clips: DataFrame) -> DataFrame:
    """All clips but those of the smallest source; 0 with fewer than two sources."""
    sizes = clips.groupBy("source_id").agg(F.count("*").alias("c"))
    return sizes.agg(F.when(F.count("*") < 2, 0).otherwise(F.sum("c") - F.min("c")).cast("long").alias("max_val_count"))


def target_count(clips: DataFrame, fraction: float) -> DataFrame:
    """How many clips a fraction means: half to even, at least 1, at most the largest feasible number."""
    n = clips.agg(F.count("*").alias("n")).withColumn("k", F.lit(1)).join(largest_validation(clips).withColumn("k", F.lit(1)), "k")
    return n.select(F.least(F.greatest(F.lit(1).cast("long"), F.bround(F.col("n") * fraction, 0).cast("long")), F.col("max_val_count")).alias("target_count"))


def resolved_count(clips: DataFrame, count: int | None = None, fraction: float | None = None, train_count: int | None = None) -> int:
    """How many clips validation takes. Raises ValueError without clips, with one source alone, for a count beyond what
    leaves a source for training, and where training and validation want more clips than there are."""
    have = clips.count()
    most = largest_validation(clips).first()[0]
    if not have:
        raise ValueError("no tagged clips are available")
    if most <= 0:
        raise ValueError("clips of at least two sources are needed for source-disjoint splits")
    if count is not None and count > most:
        raise ValueError(f"{count} validation clips wanted, {most} feasible")
    wanted = count if count is not None else target_count(clips, fraction or 0.0).first()[0]
    if train_count is not None and train_count + wanted > have:
        raise ValueError(f"{train_count} training and {wanted} validation clips wanted, {have} available")
    return wanted
