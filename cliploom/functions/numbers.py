"""Lenient numbers, fractions and frame arithmetic as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-9


def safe_float(value: Column) -> Column:
    """A number that is not negative, else null; NaN and text that is no number are null."""
    x = F.trim(value.cast("string")).try_cast("double")
    return F.when((x >= 0) & ~F.isnan(x), x)


def safe_int(value: Column, least: int = 1) -> Column:
    """A whole number of at least least, else null."""
    text = F.trim(value.cast("string"))
    x = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))
    return F.when(x >= least, x)


def truncated_int(value: Column) -> Column:
    """A whole number that is not negative, else null; of a variant or a number, a fraction is cut off, of a text it is none."""
    text = value.try_cast("string")
    x = F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))
    return F.when(x >= 0, x)


def fraction(text: Column) -> Column:
    """'a/b' as a number, 'a' as itself; null where either is no such number or b is 0."""
    parts = F.split(F.trim(text), "/", 2)
    top, bottom = safe_float(F.get(parts, 0)), safe_float(F.get(parts, 1))
    return F.when(F.size(parts) == 2, F.try_divide(top, F.when(bottom > 0, bottom))).otherwise(top)


def positive_fraction(text: Column) -> Column:
    """As fraction, but only what is above 0."""
    x = fraction(text)
    return F.when(x > 0, x)


def frame_rate(average: Column, real: Column) -> Column:
    """The average rate unless it is null or 0, else the real one."""
    return F.coalesce(F.nullif(fraction(average), F.lit(0.0)), fraction(real))


def rounded(x: Column) -> Column:
    """Half to even, as a long."""
    return F.bround(x, 0).cast("long")


def frame_count(duration: Column, fps: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), rounded(duration * fps))


def analysed_duration(duration: Column, scores: Column, fps: Column) -> Column:
    """How much of a video its scores cover: no more than its duration."""
    return F.least(duration, scores / fps)


def frame_guard(fps: Column) -> Column:
    return F.lit(1.0) / fps


def frame_delay_ms(duration: Column, frames: Column) -> Column:
    return F.greatest(F.lit(40).cast("long"), rounded(duration / frames * 1000))


def frame_time(duration: Column) -> Column:
    """Where the representative frame is taken: the middle, but before the last millisecond."""
    return F.least(duration * 0.5, F.greatest(duration - 1e-3, F.lit(0.0)))


def preview_start(duration: Column, length: float = 2.0) -> Column:
    return F.greatest((duration - preview_length(duration, length)) / 2, F.lit(0.0))


def preview_length(duration: Column, length: float = 2.0) -> Column:
    return F.least(F.lit(length), F.greatest(duration, F.lit(0.0)))


def clip_name(stem: Column, index: Column, start: Column, end: Column) -> Column:
    return F.format_string("%s/clip_%d_%d_%d.mp4", stem, index, rounded(start * 1000), rounded(end * 1000))


def quantized_frames(frames: Column) -> Column:
    """The nearest of 1, 9, 17, ...; the lower of two as near; at least 1."""
    lower = F.floor((frames - 1) / 8) * 8 + 1
    return F.when(frames <= 1, 1).when(frames - lower <= 4, lower).otherwise(lower + 8).cast("long")


def log_distance(aspect_a: Column, frames_a: Column, aspect_b: Column, frames_b: Column) -> Column:
    return F.abs(F.ln(aspect_a / aspect_b)) + F.abs(F.ln(frames_a / frames_b))
