"""Writing manifests, split tables, logs and media copies."""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.media import VIDEO_TYPES
from ..operators import manifests


def ascii_json(text: Column) -> Column:
    """JSON with characters beyond printable ASCII as escapes of their UTF-16 units."""
    others = F.array_distinct(F.regexp_extract_all(text, F.lit(r"([^\x00-\x7e])"), F.lit(1)))
    escaped = F.aggregate(others, text, lambda said, c: F.replace(said, c, F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")))
    return F.when(text.rlike(r"[^\x00-\x7e]"), escaped).otherwise(text)


def json_lines(rows: DataFrame) -> DataFrame:
    """One JSON text a row, in ASCII, nulls kept."""
    return rows.select(ascii_json(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})).alias("value"))


def write_json_lines(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    json_lines(rows).write.mode(mode).text(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Adds rows to a log, each with the time in UTC."""
    stamped = rows.withColumn("timestamp", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    json_lines(stamped).write.mode("append").text(path)


def write_splits(rows: DataFrame, path: str) -> None:
    """One folder per split."""
    rows.write.mode("errorifexists").partitionBy("split").json(path)


def _holds(fs, path, names: tuple[str, ...]) -> str | None:
    """What lies below a folder, or its parent's folders, that an export must not be written over."""
    if not fs.exists(path):
        return None
    files = fs.listFiles(path, True)
    while files.hasNext():
        name = files.next().getPath()
        if name.getName().lower().endswith(tuple(VIDEO_TYPES)) or name.getName() in names:
            return name.toString()
    return None


def check_target(spark: SparkSession, path: str, names: tuple[str, ...] = ("tags.jsonl",)) -> None:
    """Raises ValueError if there are videos, or files of these names, in or below a folder that is to be written."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = _holds(hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop, names)
    if found:
        raise ValueError(f"{path} holds {found}")


def write_together(splits: dict[str, DataFrame], paths: dict[str, str]) -> None:
    """Writes all splits as JSON Lines, each into its folder, or nothing into any.

    One job writes them below a folder beside the first target, so a task that fails leaves no split; Spark commits that job as a
    whole. Then the folders are moved to their places, which a store does at once; should one move fail, those before it are moved
    back. Raises FileExistsError if a target is there, before anything is written."""
    if not splits:
        return
    spark = next(iter(splits.values())).sparkSession
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    at = {name: spark._jvm.org.apache.hadoop.fs.Path(paths[name]) for name in splits}
    fs = {name: p.getFileSystem(conf) for name, p in at.items()}
    taken = [paths[name] for name in splits if fs[name].exists(at[name])]
    if taken:
        raise FileExistsError(f"{taken[0]} is there already")
    order = {name: k for k, name in enumerate(splits)}
    rows = None
    for name, df in splits.items():
        one = json_lines(df).withColumn("_split", F.lit(order[name]))
        rows = one if rows is None else rows.unionByName(one)
    beside = paths[next(iter(splits))].rstrip("/")
    staging = f"{beside}.writing-{uuid.uuid4().hex}"
    base = spark._jvm.org.apache.hadoop.fs.Path(staging)
    store = base.getFileSystem(conf)
    moved: list[str] = []
    try:
        rows.write.partitionBy("_split").text(staging)
        for name in splits:
            source = spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/_split={order[name]}")
            fs[name].mkdirs(at[name].getParent())
            if not store.exists(source):  # a split without rows
                store.mkdirs(source)
            if not store.rename(source, at[name]):
                raise OSError(f"{paths[name]} can't be written")
            moved.append(name)
    except BaseException:
        for name in moved:
            fs[name].delete(at[name], True)
        raise
    finally:
        store.delete(base, True)


def write_export(splits: dict[str, tuple[DataFrame, DataFrame]], paths: dict[str, str]) -> None:
    """Writes the exports of all splits, or, with a violation in any, raises before the first is written."""
    bad = None
    for _, violations in splits.values():
        bad = violations if bad is None else bad.unionByName(violations)
    if bad is not None and (message := manifests.first_violation(bad)):
        raise ValueError(message)
    write_together({name: rows for name, (rows, _) in splits.items()}, paths)


def existing_download(size: Column, target: Column, part: Column) -> Column:
    """What a download finds: 'complete', 'part-complete' or null. target, part: bytes of the files, null if missing."""
    return F.when((size > 0) & (target == size), "complete").when((size > 0) & (part == size), "part-complete")


def copied_media(rows: DataFrame, source: str = "source_file", target: str = "target_file") -> DataFrame:
    """Copies files from within tasks and says of each whether it was 'copied' or 'failed' and why; folders are shared."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            states, errors = [], []
            for a, b in zip(batch[source], batch[target], strict=True):
                try:
                    Path(b).parent.mkdir(parents=True, exist_ok=True)
                    shutil.copy2(a, b)
                    states.append("copied")
                    errors.append("")
                except OSError as e:
                    states.append("failed")
                    errors.append(str(e))
            yield batch[[source, target]].assign(status=states, error=errors)

    return rows.select(source, target).mapInPandas(run, f"{source} string, {target} string, status string, error string")


def summary_line(row: DataFrame) -> DataFrame:
    """A one-row table as 'name=value name=value'."""
    return row.select(F.concat_ws(" ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in row.columns]).alias("summary"))
