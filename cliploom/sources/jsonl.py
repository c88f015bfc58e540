"""JSON-Lines manifests, post feeds and a synthetic table, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.media import FEED_TYPES
from ..functions.text import strip

POST = "_id bigint, _file_ext string, _file_url string, _file_size bigint, _tags string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1), line; blank lines are left out but counted. Splits of a file are read and counted apart; a
    line's number is its place in its split and the lines of the splits before."""
    part = ["file", "start"]
    read = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")
    )
    sizes = read.groupBy(*part).agg(F.count("*").alias("lines"))  # a row per split
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*part, F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    placed = read.withColumn("n", F.row_number().over(Window.partitionBy(*part).orderBy("at"))).join(before, part)
    return placed.select("file", (F.col("before") + F.col("n")).alias("line_no"), "line").where(strip(F.col("line")) != "")


def read_strict(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows (line_no and the fields of schema), and violations (file, line_no, rule): lines that are no JSON objects."""
    lines = numbered_lines(spark, path)
    variant = F.try_parse_json("line")
    rule = F.when(variant.isNull(), "invalid JSON").when(~F.schema_of_variant(variant).startswith("OBJECT"), "not a JSON object")
    checked = lines.withColumn("rule", rule)
    rows = checked.where("rule is null").select("line_no", F.from_json("line", schema).alias("r")).select("line_no", "r.*")
    return rows, checked.where("rule is not null").select("file", "line_no", "rule")


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a manifest; a line that is no JSON stops the query. Lines are read in parallel and not numbered."""
    lines = spark.read.text(path).where(strip(F.col("value")) != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As read_manifest, with no rows where there is no file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return read_manifest(spark, path, schema) if there else spark.createDataFrame([], schema)


def posts(feed: DataFrame, column: str = "xml") -> DataFrame:
    """Feed pages (one XML text a row) as posts; those without id, type or address go; size 0 by default."""
    one = F.from_xml(F.col(column), f"post array<struct<{POST.replace(' ', ':').replace(',:', ',')}>>")
    rows = feed.select(F.explode(one["post"]).alias("p"))
    out = rows.select(
        F.col("p._id").alias("id"),
        F.lower("p._file_ext").alias("file_ext"),
        F.col("p._file_url").alias("file_url"),
        F.coalesce("p._file_size", F.lit(0).cast("long")).alias("file_size"),
        F.coalesce("p._tags", F.lit("")).alias("tags"),
    )
    return out.where("id is not null and coalesce(file_ext, '') <> '' and coalesce(file_url, '') <> ''")


def matching_posts(found: DataFrame, count: int) -> DataFrame:
    """The first count videos in feed order, newest first."""
    return found.where(F.col("file_ext").isin(*FEED_TYPES)).orderBy(F.desc("id")).limit(count)


def post_file(post: Column, ext: Column) -> Column:
    """The file name of a post's video."""
    return F.concat_ws(".", post.cast("string"), ext)


def paged_posts(found: DataFrame, count: int, page_size: int) -> DataFrame:
    """found: posts with their page (1, 2, ...) and position. The first count videos in feed order; the feed ends with its
    first page that has fewer than page_size posts, or with the last one before a page that is missing."""
    sizes = found.groupBy("page").agg(F.count("*").alias("posts"))
    # a row per page: short ones, and those before a gap
    ends = sizes.join(sizes.select((F.col("page") - 1).alias("page"), F.lit(True).alias("more")), "page", "left")
    last = ends.where((F.col("posts") < page_size) | F.col("more").isNull()).agg(F.min("page").alias("last"), F.lit(1).alias("k"))
    first = sizes.agg(F.min("page").alias("first"), F.lit(1).alias("k"))
    bounds = last.join(first, "k").where("first = 1").select("last")
    kept = found.where(F.col("file_ext").isin(*FEED_TYPES)).join(F.broadcast(bounds), F.col("page") <= F.col("last")).drop("last")  # bounds: one row
    return kept.orderBy("page", "position").limit(count)


def feed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """page and xml of the files page-1.xml, page-2.xml, ... in a folder; a missing page ends the feed."""
    name = F.col("_metadata.file_name")
    read = spark.read.text(f"{folder.rstrip('/')}/page-*.xml", wholetext=True).select(F.regexp_extract(name, r"^page-(\d+)\.xml$", 1).cast("int").alias("page"), F.col("value").alias("xml"))
    pages = read.select("page")
    after = pages.select((F.col("page") + 1).alias("page")).unionByName(spark.range(1).select(F.lit(1).alias("page")))
    missing = after.join(pages, "page", "left_anti").agg(F.min("page").alias("missing"))
    return read.join(F.broadcast(missing), F.col("page") < F.col("missing")).drop("missing")  # one row


def synthetic_clips(ids: DataFrame, per_source: int = 5, tag_pool: int = 80, tags_per_clip: int = 5, seed: int = 0) -> DataFrame:
    """A clip for each id, with seeded tags from a pool, some to a source: what the split is timed on (spark.range(n) gives ids)."""
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(tag_pool - 1)), lambda t: F.struct(F.xxhash64(F.lit(seed), F.col("id"), t).alias("h"), t.alias("t"))))
    tag_list = F.transform(F.slice(ranked, 1, tags_per_clip), lambda x: F.format_string("tag_%03d", x["t"]))
    source = F.floor(F.col("id") / per_source).cast("int")
    return ids.select(
        F.format_string("source_%05d/clip_%06d.mp4", source, F.col("id")).alias("clip_relpath"),
        F.format_string("source_%05d.mp4", source).alias("source_id"),
        tag_list.alias("tags"),
        F.lit("tagged").alias("status"),
    )
