"""Model calls over clips, a batch at a time; a batch that fails is tried again row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import analysed_duration

#: Rows given to a model at once.
BATCH = 8


def tagged(clips: DataFrame, load: Callable[[], Callable[[list], list[dict]]], column: str = "clip_path", batch: int = BATCH) -> DataFrame:
    """clip_path, rating, general_tags, character_tags, status ('tagged' or 'failed'), error. load() gives the model, once a
    task: a function from values to dicts of rating, general_tags, character_tags, one for each value."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def call(values: list) -> list[tuple]:
            try:
                found = model(values)
                if len(found) != len(values):
                    raise ValueError(f"{len(found)} results for {len(values)} rows")
            except Exception as e:  # a model may fail in any way; its rows say so
                if len(values) > 1:
                    return [call([v])[0] for v in values]
                return [(values[0], None, [], [], "failed", str(e))]
            return [(v, x.get("rating"), list(x.get("general_tags", ())), list(x.get("character_tags", ())), "tagged", "") for v, x in zip(values, found, strict=True)]

        for frame in batches:
            values = list(frame[column])
            rows = [r for k in range(0, len(values), batch) for r in call(values[k : k + batch])]
            yield pd.DataFrame(rows, columns=[column, "rating", "general_tags", "character_tags", "status", "error"])

    return clips.select(column).mapInPandas(run, f"{column} string, rating string, general_tags array<string>, character_tags array<string>, status string, error string")


def boundary_scores(videos: DataFrame, load: Callable[[], Callable[[list[str]], list[tuple]]], batch: int = BATCH) -> DataFrame:
    """videos: video, path, fps and the probed duration. Frames as rows (video, frame, score, fps, duration) for
    :func:`cliploom.operators.spans.unsafe_spans`: score is the larger of the two that the model gives, duration as far as frames
    were scored. load() gives the model, once a task: a function from paths to pairs of arrays, one entry a frame. A pair of
    unlike lengths, and any error of the model, stop the job: spans of a video that was not analysed must not count as safe. A video
    without frames gives no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in batches:
            for k in range(0, len(frame), batch):
                rows = frame.iloc[k : k + batch]
                found = model(list(rows["path"]))
                if len(found) != len(rows):
                    raise ValueError(f"{len(found)} results for {len(rows)} videos")
                scores = []
                for path, (one, every) in zip(rows["path"], found, strict=True):
                    a, b = np.asarray(one, float).reshape(-1), np.asarray(every, float).reshape(-1)
                    if a.shape != b.shape:
                        raise ValueError(f"{path}: {len(a)} and {len(b)} scores of the same frames")
                    scores.append(np.maximum(a, b))
                yield pd.DataFrame({"video": rows["video"], "fps": rows["fps"], "duration": rows["duration"], "scores": scores})

    scored = videos.select("video", "path", "fps", "duration").mapInPandas(run, "video string, fps double, duration double, scores array<double>")
    within = analysed_duration(F.col("duration"), F.size("scores"), F.col("fps"))
    return scored.withColumn("duration", within).select("video", F.posexplode("scores").alias("frame", "score"), "fps", "duration")


CAPTIONED = "clip_path string, caption string, status string, error string"


def captioned(clips: DataFrame, load: Callable[[], tuple[Callable, Callable]], batch: int = BATCH) -> DataFrame:
    """clips: clip_path, prompt. clip_path, caption, status ('captioned' or 'failed'), error.

    load() gives, once a task, prepare(path, prompt, thinking) and generate(list of what was prepared), which gives a text for
    each. Inputs are prepared without thinking; a prepare that does not know that option (a TypeError that names it) is called
    without it from then on. A batch that fails is generated again row by row, so one clip fails alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prepare, generate = load()
        plain = False

        def ready(path: str, prompt: str):
            nonlocal plain
            if not plain:
                try:
                    return prepare(path, prompt, thinking=False)
                except TypeError as e:
                    if "thinking" not in str(e):
                        raise
                    plain = True
            return prepare(path, prompt)

        def said(inputs: list) -> list[str]:
            texts = list(generate(inputs))
            if len(texts) != len(inputs):
                raise ValueError(f"{len(texts)} captions for {len(inputs)} clips")
            return texts

        for frame in batches:
            out: list[tuple] = []
            todo = list(zip(frame["clip_path"], frame["prompt"], strict=True))
            for k in range(0, len(todo), batch):
                inputs, rows = [], {}
                for i, (path, prompt) in enumerate(todo[k : k + batch]):
                    try:
                        inputs.append((i, ready(path, prompt)))
                    except Exception as e:  # a model may fail in any way; its rows say so
                        rows[i] = (path, None, "failed", str(e))
                try:
                    texts = said([x for _, x in inputs]) if inputs else []
                    rows |= {i: (todo[k + i][0], text, "captioned", "") for (i, _), text in zip(inputs, texts, strict=True)}
                except Exception:
                    for i, x in inputs:
                        try:
                            rows[i] = (todo[k + i][0], said([x])[0], "captioned", "")
                        except Exception as e:  # as above
                            rows[i] = (todo[k + i][0], None, "failed", str(e))
                out += [rows[i] for i in sorted(rows)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CAPTIONED.split(", ")])

    return clips.select("clip_path", "prompt").mapInPandas(run, CAPTIONED)
