"""Small helpers that the training-data operators share."""

from __future__ import annotations

import pickle
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word, wherever an operator counts words: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local master gets a temporary one
    (as in tests); on a cluster that is an error, as executors would write to disks of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="cliploom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, computed once. The table
    stays; it is for what a result still reads."""
    return _written(df, f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}")


class Workspace:
    """Staged tables that are needed only while a function runs: ``close`` removes them together, once what the function
    gives has been staged elsewhere."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self.n = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}", 0

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        self.n += 1
        return _written(df, f"{self.path}/{self.n}-{label}")

    def close(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fresh(name: str, columns: list[str]) -> str:
    """The name, or the name with as many underscores behind it that no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text falls into the fold kept from learning. A null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def label_table(labels: DataFrame, label: str) -> DataFrame:
    """One row per labelled id; contradicting or repeated rows take the larger label, nulls drop out."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias(label))


def fitted(docs: DataFrame, ids: DataFrame, classes: list, per_class: int, most_chars: int, fit: Callable[[list[tuple[str, int]]], Any]) -> Any:
    """What fit makes of a bounded sample: of each class at most per_class rows of ids (doc_id, y), picked in a seeded
    order, and of their texts as many, in that order, as begin within most_chars, the last one cut there; fit gets texts
    and indexes of classes. Both bounds are the caller's parameters, and no more than they allow goes to one task, which
    fits; so the driver sees the model alone, and a lost executor only repeats it."""
    picked = None
    for k, y in enumerate(classes):
        some = ids.where(F.col("y") == y).select("doc_id", F.lit(k).alias("k")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        return fit([])
    work = Workspace(docs.sparkSession, "sample")
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked.distinct()), "doc_id")
    key = ["o", "t", "k"]
    rows = work(rows.select(F.xxhash64("doc_id").alias("o"), F.xxhash64("text").alias("t"), "k", F.length("text").alias("n"), "text"), "sample")
    # sizes are summed up without the texts, of a bounded number of rows
    first = rows.select(*key, "n").orderBy(*key).limit(2 * per_class * len(classes))
    upto = first.withColumn("before", F.sum("n").over(Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)))
    chosen = upto.where(F.coalesce("before", F.lit(0)) < most_chars).select(*key).distinct()
    rows = rows.join(F.broadcast(chosen), key).select(*key, "text").coalesce(1).sortWithinPartitions(*key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[str, int]] = []
        chars = 0
        for batch in batches:
            for text, k in zip(batch["text"], batch["k"], strict=True):
                if chars < most_chars:
                    held.append((text[: most_chars - chars], int(k)))
                    chars += len(held[-1][0])
        yield pd.DataFrame({"model": [pickle.dumps(fit(held))]})

    found = rows.select("text", "k").mapInPandas(run, "model binary").first()
    work.close()
    return fit([]) if found is None else pickle.loads(found["model"])
