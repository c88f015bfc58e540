"""Numbering rows in an order without bringing them into one task."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Bits of monotonically_increasing_id() that count rows within a partition.
ROW_BITS = 33


def shared_folder(df: DataFrame) -> str:
    """spark.checkpoint.dir; a local master without one gets a temporary folder, a cluster must name it."""
    spark = df.sparkSession
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="cliploom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with their range and place (_range, _at). Ranges are sorted apart and written once, so that what is computed over
    ranges and over their rows sees the same ones."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    path = f"{shared_folder(rows)}/ranges-{uuid.uuid4().hex}"
    sorted_.write.parquet(path)
    return rows.sparkSession.read.schema(sorted_.schema).parquet(path).withColumn("_range", F.shiftright("_at", ROW_BITS))


def _sum_before(column: str) -> Column:
    """Over one row per range."""
    return F.coalesce(F.sum(column).over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds 1, 2, ... in the given order, which must tell all rows apart to be the same on every run."""
    placed = _ranges(rows, order)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size")).select("_range", _sum_before("_size").alias("_before"))
    within = F.col("_at") - F.shiftleft(F.col("_range"), ROW_BITS) + 1
    return placed.join(F.broadcast(sizes), "_range").withColumn(name, (F.col("_before") + within).cast("long")).drop("_at", "_range", "_before")


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds running sums (name: what is summed) in the given order, each row's own included."""
    placed = _ranges(rows.select("*", *[c.alias(n) for n, c in sums.items()]), order)
    whole = placed.groupBy("_range").agg(*[F.sum(n).alias(n) for n in sums])
    before = whole.select("_range", *[_sum_before(n).alias(f"_{n}") for n in sums])
    within = Window.partitionBy("_range").orderBy("_at")
    return placed.join(F.broadcast(before), "_range").select(*rows.columns, *[(F.col(f"_{n}") + F.sum(n).over(within)).alias(n) for n in sums])


def walked(rows: DataFrame, order: list[Column], step: Column, begin: int, least: int, most: int, name: str) -> DataFrame:
    """Adds where a walk from begin stands before each row, in the given order; a row's step moves it, but not beyond least and
    most. Steps between bounds compose to x -> min(max(x + a, low), high), so ranges are summed up apart, a triple each; the
    driver composes the triples, and a second pass over the ranges walks from where each begins. Tasks hold no rows."""
    placed = _ranges(rows.withColumn("_step", F.coalesce(step, F.lit(0)).cast("long")), order)

    def together(df: DataFrame) -> DataFrame:
        return df.repartition("_range").sortWithinPartitions("_range", "_at")

    def composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[int, int, int]] = {}
        for batch in batches:
            for k, s in zip(batch["_range"], batch["_step"], strict=True):
                a, low, high = held.get(k, (0, least, most))
                held[k] = a + s, min(max(low + s, least), most), min(max(high + s, least), most)
        yield pd.DataFrame([(k, *x) for k, x in held.items()], columns=["_range", "a", "low", "high"])

    triples = together(placed.select("_range", "_at", "_step")).mapInPandas(composed, "_range long, a long, low long, high long").collect()  # a row a range
    begins, at = {}, min(max(begin, least), most)
    for r in sorted(triples, key=lambda r: r["_range"]):
        begins[r["_range"]] = at
        at = min(max(at + r["a"], r["low"]), r["high"])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: dict[int, int] = {}
        for batch in batches:
            stands = []
            for k, s in zip(batch["_range"], batch["_step"], strict=True):
                x = now.get(k, begins[k])
                stands.append(x)
                now = {k: min(max(x + s, least), most)}
            yield batch.drop(columns=["_range", "_at", "_step"]).assign(**{name: stands})

    return together(placed).mapInPandas(walk, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))
