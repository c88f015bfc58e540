"""The driver's tables seen as captions, clips, frame series, clip sizes, review logs and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("text").alias("caption"))


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clip per document; its tags are all its distinct words of four letters or more."""
    long_words = F.filter(text.tokens(F.col("text")), lambda t: F.length(t) >= 4)
    return table(spark, sf_dir, "documents").select(
        F.concat("lang", F.lit("/doc_"), "doc_id", F.lit(".mp4")).alias("clip_relpath"),
        F.concat("lang", F.lit("-"), "source").alias("source_id"),
        F.array_distinct(long_words).alias("tags"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A video per user, a frame per event in order of time, one frame a second."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    numbered = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video"), (F.row_number().over(w) - 1).alias("frame"), (F.col("value") / 500).alias("score"), F.lit(1.0).alias("fps")
    )
    return numbered.join(videos(spark, sf_dir), "video")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("video")).agg(F.count("*").cast("double").alias("duration"))


def clip_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        (F.col("p_size") * 64).cast("int").alias("width"),
        ((F.col("p_partkey") % 25 + 1) * 64).cast("int").alias("height"),
        (F.col("p_partkey") % 121 + 1).cast("int").alias("frames"),
    )


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey and a clip's duration (s), frame rate, frames (null for some), audio."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        (key % 700 / 10.0).cast("double").alias("duration"),
        F.when(key % 5 != 0, (key % 3 * 6 + 12).cast("double")).alias("fps"),
        F.when(key % 7 != 0, (key % 400).cast("long")).alias("total_frames"),
        (key % 4 != 0).alias("has_audio"),
    )


def review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    state = F.when(kind == "purchase", "accepted").when(kind == "error", "error").when(kind == "click", "rejected").otherwise("pending")
    return table(spark, sf_dir, "events").select(
        F.format_string("v%05d", "user_id").alias("video_id"),
        state.alias("status"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("motion_score"),
        F.when((F.col("event_id") % 3 == 0) & (F.col("user_id") % 2 == 0), F.col("user_id")).otherwise(0).cast("long").alias("discovered_order"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("seen_order"),
        F.col("event_id").alias("line_no"),
    )
