"""Rows of the manifests, with every column, in order, whether a clip succeeded or failed; and hints read from a tags manifest.

Results are joined to the clips that were asked for, so a clip without a result still gets its row, as a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_caption, strip
from . import tags
from .manifests import normalized_path

# How boundary scores are combined, and the states of a record.
BOUNDARY_MODE = "high_recall_any"
TAGGED, CAPTIONED, FAILED = "tagged", "captioned", "failed"
_SCORES, _TAGS = "map<string,double>", "array<string>"


def extract_records(clips: DataFrame, output: str, threshold: float, padding: float, seed: int) -> DataFrame:
    """clips: video (the source's path), clip (below the output folder), start, end. A row for each clip that was cut."""
    return clips.select(
        F.col("video").cast("string").alias("source_path"),
        F.concat(F.lit(output.rstrip("/") + "/"), "clip").alias("clip_path"),
        "start",
        "end",
        (F.col("end") - F.col("start")).alias("duration"),
        F.lit(float(threshold)).alias("boundary_threshold"),
        F.lit(float(padding)).alias("boundary_padding"),
        F.lit(BOUNDARY_MODE).alias("boundary_mode"),
        F.lit(seed).alias("seed"),
    )


def _given(name: str, ok: Column, default: Column) -> Column:
    return F.coalesce(F.when(ok, F.col(name)), default).alias(name)


def tag_records(clips: DataFrame, results: DataFrame, model: str) -> DataFrame:
    """clips: clip_path, clip_relpath, duration, frame_time. results: clip_path, rating, rating_scores, general_tags,
    general_tag_scores, character_tags, character_tag_scores, all_tags, status, error. What failed, or has no result, keeps its times and
    the error, and has empty tags."""
    joined = clips.join(results, "clip_path", "left")
    ok = F.col("status").eqNullSafe(TAGGED)
    scores, none = F.create_map().cast(_SCORES), F.array().cast(_TAGS)
    doubles = {c: tags.scores_as_doubles(F.col(c)) for c in ("rating_scores", "general_tag_scores", "character_tag_scores")}
    joined = joined.withColumns(doubles)
    return joined.select(
        "clip_path",
        "clip_relpath",
        F.lit(model).alias("model_repo"),
        "duration",
        "frame_time",
        F.when(ok, F.col("rating")).alias("rating"),
        _given("rating_scores", ok, scores),
        _given("general_tags", ok, none),
        _given("general_tag_scores", ok, scores),
        _given("character_tags", ok, none),
        _given("character_tag_scores", ok, scores),
        F.coalesce(F.when(ok, tags.deduped(F.col("all_tags"))), none).alias("all_tags"),
        F.when(ok, TAGGED).otherwise(FAILED).alias("status"),
        F.when(ok, "").otherwise(F.coalesce("error", F.lit("no result"))).alias("error"),
    )


def caption_records(clips: DataFrame, results: DataFrame, model: str) -> DataFrame:
    """clips: clip_path, duration, has_audio_track, used_audio, audio_skip_reason. results: clip_path, caption (as generated), status,
    error. Captions are normalised; one that is empty then is a failure."""
    joined = clips.join(results, "clip_path", "left").withColumn("said", normalize_caption(F.col("caption")))
    came = F.col("status").eqNullSafe(CAPTIONED)
    ok = came & F.col("said").isNotNull()
    text = F.lit(None).cast("string")
    return joined.select(
        "clip_path",
        F.lit(model).alias("model_repo"),
        "duration",
        "has_audio_track",
        F.coalesce("used_audio", F.lit(False)).alias("used_audio"),
        "audio_skip_reason",
        *[text.alias(c) for c in ("scene_overview", "visual_details", "dialogue", "other_sounds")],
        F.when(ok, F.col("said")).alias("caption"),
        F.when(ok, CAPTIONED).otherwise(FAILED).alias("status"),
        F.when(ok, "").when(came, "the caption is empty").otherwise(F.coalesce("error", F.lit("no result"))).alias("error"),
    )


def hint_rows(manifest: DataFrame, folder: str) -> DataFrame:
    """manifest: line_no and the columns of tag_records. Gives line_no, clip_path (normalised, below the folder if relative),
    clip_relpath (stated, else what the path is below the folder) and hints, of tagged clips that have any: what
    :func:`cliploom.operators.manifests.with_hints` matches clips with."""
    base = normalized_path(F.lit(folder.rstrip("/") or "/"))
    path = strip(F.col("clip_path"))
    full = F.when(F.coalesce(path, F.lit("")) != "", normalized_path(F.when(path.startswith("/"), path).otherwise(F.concat(base, F.lit("/"), path))))
    stated = strip(F.col("clip_relpath"))
    rows = manifest.where(F.col("status") == TAGGED).select("line_no", full.alias("clip_path"), stated.alias("stated"), tags.hints(F.col("all_tags"), F.col("general_tags"), F.col("character_tags")).alias("hints"))
    below = F.when(F.col("clip_path").startswith(F.concat(base, F.lit("/"))), F.substring(F.col("clip_path"), F.length(base) + 2, F.length("clip_path")))
    rel = F.when(F.coalesce("stated", F.lit("")) != "", F.col("stated")).otherwise(below)
    return rows.where((F.size("hints.general") > 0) | (F.size("hints.character") > 0)).select("line_no", "clip_path", rel.alias("clip_relpath"), "hints")
