"""A paged feed as a data source: pages are partitions of a batch read, and offsets of a stream.

What fetches pages is given, as a network client or a folder of recorded pages: has(page) says whether the feed has come to a
page, get(page) gives its XML. Both are called in tasks and on the driver, so they must be picklable and reach a shared place. A
fetch that fails in a way that may pass (RETRIED) is tried again, after a wait that doubles; other errors stop the read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any, Protocol, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Errors that may pass.
RETRIED = (ConnectionError, TimeoutError, InterruptedError)
# Tries, and seconds before the second one.
ATTEMPTS, WAIT = 4, 0.5
SCHEMA = "page int, xml string"
T = TypeVar("T")


class Feed(Protocol):
    def has(self, page: int) -> bool: ...

    def get(self, page: int) -> str: ...


@dataclass
class Recorded:
    """Pages page-1.xml, page-2.xml, ... in a folder that all executors share."""

    folder: str

    def has(self, page: int) -> bool:
        return (Path(self.folder) / f"page-{page}.xml").exists()

    def get(self, page: int) -> str:
        return (Path(self.folder) / f"page-{page}.xml").read_text()


def retried(call: Callable[[], T], attempts: int = ATTEMPTS, wait: float = WAIT) -> T:
    for k in range(1, attempts):
        try:
            return call()
        except RETRIED:
            time.sleep(wait * 2 ** (k - 1))
    return call()


@dataclass
class Page(InputPartition):
    page: int


class Pages(DataSourceReader):
    """The pages 1, 2, ... of a feed, as many as asked for; those it has not come to give no rows."""

    def __init__(self, feed: Feed, pages: int, attempts: int, wait: float):
        self.feed, self.pages, self.attempts, self.wait = feed, pages, attempts, wait

    def partitions(self) -> list[InputPartition]:
        return [Page(k) for k in range(1, self.pages + 1)]

    def read(self, partition: Any) -> Iterator[tuple]:
        if retried(lambda: self.feed.has(partition.page), self.attempts, self.wait):
            yield partition.page, retried(lambda: self.feed.get(partition.page), self.attempts, self.wait)


class NewPages(DataSourceStreamReader):
    """Pages as the feed comes to them. An offset is the last page that was read; after a restart the stream goes on behind it."""

    def __init__(self, feed: Feed, attempts: int, wait: float):
        self.feed, self.attempts, self.wait, self.last = feed, attempts, wait, 0

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        while retried(lambda: self.feed.has(self.last + 1), self.attempts, self.wait):
            self.last += 1
        return {"page": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Page(k) for k in range(start["page"] + 1, end["page"] + 1)]

    def read(self, partition: Any) -> Iterator[tuple]:
        yield partition.page, retried(lambda: self.feed.get(partition.page), self.attempts, self.wait)

    def commit(self, end: dict) -> None:
        self.last = max(self.last, end["page"])


def source(feed: Feed, name: str = "feed", attempts: int = ATTEMPTS, wait: float = WAIT) -> type[DataSource]:
    """A data source over a feed, to be registered. Option pages: how many pages a batch read asks for."""

    class FeedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Pages(feed, int(self.options["pages"]), attempts, wait)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return NewPages(feed, attempts, wait)

    return FeedSource


def read_feed(spark: SparkSession, feed: Feed, pages: int, **how: Any) -> DataFrame:
    """page and xml of the first pages of a feed, a partition a page."""
    spark.dataSource.register(source(feed, **how))
    return spark.read.format(how.get("name", "feed")).option("pages", pages).load()


def watch_feed(spark: SparkSession, feed: Feed, **how: Any) -> DataFrame:
    """page and xml of a feed's pages as a stream."""
    spark.dataSource.register(source(feed, **how))
    return spark.readStream.format(how.get("name", "feed")).load()
