"""Probe results, sampling plans, prompts and chat messages of clips as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import numbers
from .text import strip

# Limits of the caption model, file types, review states, why audio or a clip is not used, heads of hint lines.
AUDIO_LIMIT_S = 30.0
VIDEO_LIMIT_S = 60.0
VIDEO_TYPES = (".avi", ".mkv", ".mov", ".mp4", ".webm")
FEED_TYPES = ("mp4", "webm")
NO_AUDIO = "clip has no audio track"
NO_AUDIO_INPUT = "model does not support audio input"
LONG_AUDIO = f"clip audio exceeds {AUDIO_LIMIT_S:.0f}s limit"
LONG_VIDEO = f"clip duration exceeds {VIDEO_LIMIT_S:.0f}s video limit"
CHARACTER_HINTS = "Character hints: "
VISUAL_HINTS = "Visual hints: "
STATES = ("pending", "accepted", "rejected", "error")
PROBE = (
    "format struct<duration:string>, streams array<struct<codec_type:string,width:string,height:string,duration:string,"
    "avg_frame_rate:string,r_frame_rate:string,nb_frames:string>>"
)


def probe(json: Column) -> Column:
    """A probe's JSON as struct(width, height, duration, fps, frames, has_audio) of its first video stream."""
    found = F.from_json(json, f"struct<{', '.join(x.replace(' ', ':', 1) for x in PROBE.split(', '))}>")
    video = F.get(F.filter(found["streams"], lambda s: s["codec_type"] == "video"), 0)
    duration = F.coalesce(numbers.safe_float(found["format"]["duration"]), numbers.safe_float(video["duration"]))
    fps = numbers.frame_rate(video["avg_frame_rate"], video["r_frame_rate"])
    frames = F.coalesce(numbers.safe_int(video["nb_frames"]), F.when((duration > 0) & (fps > 0), numbers.frame_count(duration, fps)))
    return F.struct(
        numbers.safe_int(video["width"]).alias("width"),
        numbers.safe_int(video["height"]).alias("height"),
        F.when(duration > 0, duration).alias("duration"),
        fps.alias("fps"),
        frames.alias("frames"),
        F.coalesce(F.exists(found["streams"], lambda s: s["codec_type"] == "audio"), F.lit(False)).alias("has_audio"),
    )


def caption_probe(json: Column) -> Column:
    """A probe's JSON as struct(duration, has_audio, fps, frames), as captions are planned on: rates of 0 count as unknown,
    no frames as a number. duration is null where there is no video stream, or none is stated: such a clip can't be captioned."""
    shape = "struct<format:struct<duration:string>,streams:array<struct<codec_type:string,duration:string,avg_frame_rate:string,r_frame_rate:string,nb_frames:variant>>>"
    found = F.from_json(json, shape)
    video = F.get(F.filter(found["streams"], lambda s: s["codec_type"] == "video"), 0)
    duration = F.coalesce(numbers.safe_float(found["format"]["duration"]), numbers.safe_float(video["duration"]))
    duration = F.when((duration > 0) & video.isNotNull(), duration)
    fps = F.coalesce(numbers.positive_fraction(video["avg_frame_rate"]), numbers.positive_fraction(video["r_frame_rate"]))
    said = video["nb_frames"]
    stated = F.when(F.schema_of_variant(said) == "STRING", numbers.safe_int(said.try_cast("string"), 0)).otherwise(numbers.truncated_int(said))
    return F.struct(
        duration.alias("duration"),
        F.coalesce(F.exists(found["streams"], lambda s: s["codec_type"] == "audio"), F.lit(False)).alias("has_audio"),
        fps.alias("fps"),
        F.coalesce(stated, F.when(duration.isNotNull() & fps.isNotNull(), numbers.frame_count(duration, fps))).alias("frames"),
    )


def audio_plan(has_audio: Column, supported: Column, duration: Column) -> Column:
    """Why a clip's audio is not used; null where it is."""
    return (
        F.when(~has_audio, NO_AUDIO)
        .when(~supported, NO_AUDIO_INPUT)
        .when(duration > AUDIO_LIMIT_S, LONG_AUDIO)
    )


def length_error(duration: Column) -> Column:
    return F.when(duration > VIDEO_LIMIT_S, LONG_VIDEO)


def frame_plan(total: Column, fps: Column, least: int = 12, ratio: float = 0.5, every: bool = False) -> Column:
    """struct(sample, frames, fps): all frames; a share of the known number; a share of the rate; or the least number."""
    known = F.least(F.greatest(F.lit(least).cast("long"), F.ceil(total * ratio)), total.cast("long"))
    plan = F.struct(
        F.lit(not every).alias("sample"),
        F.when(F.lit(every), None).when(total > 0, known).when(fps > 0, None).otherwise(least).cast("long").alias("frames"),
        F.when(F.lit(every) | (F.coalesce(total, F.lit(0)) > 0), None).when(fps > 0, fps * ratio).cast("double").alias("fps"),
    )
    return plan


def coerced_state(value: Column) -> Column:
    return F.when(value.isin(*STATES), value).otherwise(STATES[0])


def shown_state(state: Column, seen: Column) -> Column:
    """What a reviewer sees: an item they have seen and left counts as accepted."""
    return F.when((state == "pending") & seen.isNotNull(), "accepted").otherwise(state)


def relative_to(path: Column, folder: Column) -> Column:
    """The path below a folder, null outside it."""
    prefix = F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"))
    return F.when(path.startswith(prefix), F.substring(path, F.length(prefix) + 1, F.length(path)))


def default_relative(path: Column, folder: Column) -> Column:
    """The path below a folder; outside it, the name alone."""
    return F.coalesce(relative_to(path, folder), F.element_at(F.split(path, "/"), -1))


def hint_lines(general: Column, character: Column) -> Column:
    """Prompt lines that state a tagger's hints; empty without any."""
    some = (F.size(general) > 0) | (F.size(character) > 0)
    made = F.array_compact(
        F.array(
            F.when(F.size(character) > 0, F.concat(F.lit(CHARACTER_HINTS), F.array_join(character, ", "))),
            F.when(F.size(general) > 0, F.concat(F.lit(VISUAL_HINTS), F.array_join(general, ", "))),
        )
    )
    intro = F.array(F.lit("Tags that a separate model suggests; trust the clip where they disagree."))
    return F.when(some, F.concat(intro, made)).otherwise(F.array().cast("array<string>"))


def prompt(with_audio: Column, general: Column, character: Column) -> Column:
    """What a caption model is asked: one paragraph in order of time, hints, and whether sound is described."""
    head = F.array(
        F.lit("Describe this video clip in one paragraph, in the order in which things happen."),
        F.lit("State only what can be seen or heard; no labels, lists or other formatting."),
    )
    sound = F.when(with_audio, "Name speech, music and other sounds where they occur.").otherwise("Describe only what can be seen.")
    return F.array_join(F.concat(head, hint_lines(general, character), F.array(sound)), "\n")


def messages(clip_path: Column, text: Column, system: str = "You caption clips from evidence alone.") -> Column:
    """The prompt as chat messages: array of struct(role, content array of struct(type, text, video))."""

    def part(kind: str, said: Column, video: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), said.alias("text"), video.alias("video"))

    none = F.lit(None).cast("string")
    return F.array(
        F.struct(F.lit("system").alias("role"), F.array(part("text", F.lit(system), none)).alias("content")),
        F.struct(F.lit("user").alias("role"), F.array(part("video", none, clip_path), part("text", text, none)).alias("content")),
    )


def supports_audio(modalities: Column) -> Column:
    return F.coalesce(F.exists(modalities, lambda m: F.lower(strip(m)) == "audio"), F.lit(False))
