"""Videos below a folder, as a data source: folders are partitions, listed by tasks.

Spark's own file sources pass over names that begin with '_' or '.' and over empty files; this lists every file. The store is
reached through pyarrow, so a folder may be a path or an address such as hdfs:// or s3://. The driver opens folders level by
level until there are FOLDERS of them, LEVELS at most; a task lists its folder, and what is below it, one folder at a time.
"""

from __future__ import annotations

import json
import os
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.media import VIDEO_TYPES

FOLDERS, LEVELS = 64, 3
SCHEMA = "path string, relpath string, length long"


@dataclass
class Folder(InputPartition):
    """A folder, alone or with all below it."""

    path: str
    deep: bool


class Videos(DataSourceReader):
    def __init__(self, folder: str, exclude: list[str]):
        self.folder, self.exclude = folder, exclude

    def _opened(self) -> tuple[fs.FileSystem, str]:
        """The store, and the folder's path in it. Local paths have '.' and '..' resolved."""
        store, path = fs.FileSystem.from_uri(self.folder if "://" in self.folder else os.path.abspath(self.folder))
        return store, path.rstrip("/") or "/"

    def _without(self) -> set[str]:
        return {fs.FileSystem.from_uri(x if "://" in x else os.path.abspath(x))[1].rstrip("/") for x in self.exclude}

    def _entries(self, store: fs.FileSystem, path: str) -> tuple[list[str], list[fs.FileInfo]]:
        """Folders and files in a folder. Links to folders are not followed, so no walk goes round in a circle."""
        found = store.get_file_info(fs.FileSelector(path))
        local = isinstance(store, fs.LocalFileSystem)
        folders = [x.path for x in found if x.type == fs.FileType.Directory and not (local and os.path.islink(x.path))]
        return folders, [x for x in found if x.type == fs.FileType.File]

    def partitions(self) -> list[InputPartition]:
        store, root = self._opened()
        without = self._without()
        alone, edge = [], [] if root in without else [root]
        for _ in range(LEVELS):
            if not edge or len(edge) >= FOLDERS:
                break
            alone += edge
            edge = [x for path in edge for x in self._entries(store, path)[0] if x not in without]
        return [*(Folder(x, False) for x in alone), *(Folder(x, True) for x in edge)]

    def read(self, partition: Any) -> Iterator[tuple]:
        store, root = self._opened()
        without = self._without()
        left = [partition.path] if partition else []  # Spark reads once, with None, where there are no partitions
        while left:
            folders, files = self._entries(store, left.pop())
            for x in files:
                if posixpath.splitext(x.path)[1].lower() in VIDEO_TYPES and x.path not in without:
                    yield x.path, posixpath.relpath(x.path, root), x.size
            if partition.deep:
                left += [x for x in folders if x not in without]


class VideoSource(DataSource):
    """Options: path, and exclude (a JSON list of folders that are not entered)."""

    @classmethod
    def name(cls) -> str:
        return "videos"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Videos(self.options["path"], json.loads(self.options.get("exclude", "[]")))


def videos(spark: SparkSession, folder: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """path, relpath, length of the videos below a folder, whatever the case of their suffix; not those below exclude.
    A name that is a suffix alone ('.mp4') is no video. A folder without videos gives no rows; a missing one is an error."""
    spark.dataSource.register(VideoSource)
    return spark.read.format("videos").option("exclude", json.dumps(list(exclude))).load(folder)


def path_order(path: str):
    """Sorts paths by their parts, not as text."""
    return F.split(path, "/")


def ordered_videos(spark: SparkSession, folder: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """The videos in order of their paths' parts."""
    return videos(spark, folder, exclude).orderBy(path_order("relpath"))
