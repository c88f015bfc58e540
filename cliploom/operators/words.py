"""Word and bigram statistics over captions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from .ordering import shared_folder


def caption_blocks(captions: DataFrame, column: str = "caption") -> DataFrame:
    """One row per block of tokens."""
    return captions.select(F.explode(text.blocks(F.col(column))).alias("block"))


def word_counts(captions: DataFrame, column: str = "caption") -> DataFrame:
    return caption_blocks(captions, column).select(F.explode("block").alias("word")).groupBy("word").agg(F.count("*").alias("cnt"))


def bigram_counts(captions: DataFrame, column: str = "caption") -> DataFrame:
    """Pairs never reach across blocks."""
    pairs = caption_blocks(captions, column).select(F.explode(text.bigrams(F.col("block"))).alias("bigram"))
    return pairs.groupBy("bigram").agg(F.count("*").alias("cnt"))


def top_counts(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent, ties by text, with their rank."""
    top = counts.orderBy(F.desc("cnt"), key).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("cnt"), key)))  # over n rows


def said_counts(captions: DataFrame, column: str = "caption") -> DataFrame:
    """said, cnt: words and bigrams together, so captions are cut into tokens once for both; only bigrams hold a blank."""
    both = caption_blocks(captions, column).select(F.explode(F.concat("block", text.bigrams(F.col("block")))).alias("said"))
    return both.groupBy("said").agg(F.count("*").alias("cnt"))


def _summed_up(captions: DataFrame, said: DataFrame, manifests: int) -> DataFrame:
    pair = F.col("said").contains(" ")
    rows = captions.agg(F.count("*").alias("caption_rows"))
    unique = said.agg(F.count_if(~pair).alias("unique_words"), F.count_if(pair).alias("unique_bigrams"))
    one = F.lit(1).alias("_one")
    joined = rows.select("*", one).join(unique.select("*", one), "_one")  # single rows
    return joined.select(F.lit(manifests).cast("long").alias("manifests"), "caption_rows", "unique_words", "unique_bigrams")


def summary(captions: DataFrame, manifests: int = 1, column: str = "caption") -> DataFrame:
    """manifests, caption_rows, unique_words, unique_bigrams in one row."""
    both = caption_blocks(captions, column).select(F.explode(F.concat("block", text.bigrams(F.col("block")))).alias("said")).distinct()
    return _summed_up(captions, both, manifests)


def report(captions: DataFrame, n: int = 25, manifests: int = 1, column: str = "caption") -> DataFrame:
    """The report's lines in order: line_no, line. Holds 2 n lines and headings, however large the input. All its parts come
    from one table of counts, written once."""
    path = f"{shared_folder(captions)}/said-{uuid.uuid4().hex}"
    counted = said_counts(captions, column)
    counted.write.parquet(path)
    said = captions.sparkSession.read.schema(counted.schema).parquet(path)

    def part(pairs: bool, key: str, title: str, at: int) -> DataFrame:
        top = top_counts(said.where(F.col("said").contains(" ") == pairs).withColumnRenamed("said", key), key, n)
        listed = top.select((F.lit(at) + F.col("rank")).alias("line_no"), F.concat(F.col("rank"), F.lit(". "), F.col(key), F.lit(" ("), F.col("cnt"), F.lit(")")).alias("line"))
        none = top.agg(F.count("*").alias("c")).where("c = 0").select(F.lit(at + 1).alias("line_no"), F.lit("(none)").alias("line"))
        head = captions.sparkSession.range(1).select(F.lit(at).alias("line_no"), F.lit(title).alias("line"))
        return head.unionByName(listed).unionByName(none)

    s = _summed_up(captions, said, manifests)
    first = s.select(F.lit(0).alias("line_no"), F.concat_ws(" ", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in s.columns]).alias("line"))
    out = first.unionByName(part(False, "word", f"Top {n} words", 2))
    return out.unionByName(part(True, "bigram", f"Top {n} bigrams", 4 + n)).orderBy("line_no")
