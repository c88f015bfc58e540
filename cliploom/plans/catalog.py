"""All queries over the driver's tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media, numbers, text
from ..operators import buckets, manifests, ordering, records, review, spans, splits, tags, words
from ..sources import jsonl, listing, sinks
from ..streaming import review as stream
from . import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if it has one."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


# Shared SQL. Captions are documents; blocks are their lines without section labels.
_P = "'[a-z0-9]+(?:''[a-z0-9]+)*'"
_BLOCKS = rf"""
WITH raw AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
bodies AS (SELECT regexp_replace(trim(line, E' \t\r\n'), '(?is)^(?:SCENE_OVERVIEW|VISUAL_DETAILS|DIALOGUE|OTHER_SOUNDS)\s*:?\s*(.*)$', '\1') AS line FROM raw),
blocks AS (SELECT t FROM (SELECT list_filter(regexp_extract_all(lower(line), {_P}), lambda x: x <> 'none') AS t FROM bodies) WHERE len(t) > 0),
words AS (SELECT unnest(t) AS word FROM blocks),
pairs AS (SELECT t[i] || ' ' || t[i + 1] AS bigram FROM (SELECT t, unnest(range(1, len(t))) AS i FROM blocks))
"""
_CLIPS = f"""
WITH tok AS (SELECT doc_id, unnest(t) AS tag, generate_subscripts(t, 1) AS p FROM (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), {_P}), lambda x: x <> 'none' AND length(x) >= 4) AS t FROM documents)),
firsts AS (SELECT doc_id, tag, min(p) AS p FROM tok GROUP BY ALL),
kept AS (SELECT doc_id, tag FROM firsts),
hinted AS (SELECT doc_id, tag, p FROM firsts WHERE tag NOT IN ('general', 'sensitive', 'questionable', 'explicit') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p) <= 16),
clips AS (SELECT doc_id, lang || '/doc_' || doc_id || '.mp4' AS clip_relpath, lang || '-' || source AS source_id FROM documents),
tagged AS (SELECT clip_relpath, source_id, tag FROM clips JOIN kept USING (doc_id))
"""
_SPANS = """
WITH frames AS (
  SELECT user_id AS video, row_number() OVER w - 1 AS frame, value / 500 AS score, count(*) OVER (PARTITION BY user_id) AS duration
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), hot AS (
  SELECT *, frame - row_number() OVER (PARTITION BY video ORDER BY frame) AS run FROM frames WHERE score >= 0.35
), unsafe AS (
  SELECT video, greatest(0.0, min(frame) - 1.25)::DOUBLE AS start, least(any_value(duration), max(frame) + 1 + 1.25)::DOUBLE AS "end" FROM hot GROUP BY video, run
), flagged AS (
  SELECT *, max("end") OVER (PARTITION BY video ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM unsafe
), islands AS (
  SELECT *, sum(CASE WHEN before IS NULL OR start > before + 1e-9 THEN 1 ELSE 0 END) OVER (PARTITION BY video ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS n FROM flagged
), merged AS (
  SELECT video, min(start) AS start, max("end") AS "end" FROM islands GROUP BY video, n
), lengths AS (SELECT DISTINCT video, duration::DOUBLE AS duration FROM frames),
gaps AS (
  SELECT video, lag("end", 1, 0.0) OVER (PARTITION BY video ORDER BY start) AS start, start AS "end" FROM merged
  UNION ALL SELECT video, coalesce(m, 0.0), duration FROM lengths LEFT JOIN (SELECT video, max("end") AS m FROM merged GROUP BY video) USING (video)
), safe AS (SELECT * FROM gaps WHERE "end" - start > 1e-9)
"""
_SIZES = """
WITH sizes AS (SELECT (p_size * 64)::INT AS width, ((p_partkey % 25 + 1) * 64)::INT AS height, (p_partkey % 121 + 1)::INT AS frames FROM part),
features AS (SELECT width, height, frames, count(*) AS weight FROM sizes GROUP BY ALL)
"""
_CHOSEN = "(VALUES (512, 512, 33), (768, 448, 17), (448, 768, 65), (1024, 576, 97))"
_DURATIONS = """
WITH d AS (SELECT p_partkey, (p_partkey % 700 / 10.0)::DOUBLE AS duration, CASE WHEN p_partkey % 5 <> 0 THEN (p_partkey % 3 * 6 + 12)::DOUBLE END AS fps,
  CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 400 END AS total_frames, p_partkey % 4 <> 0 AS has_audio FROM part)
"""
_LOG = """
WITH log AS (
  SELECT printf('v%05d', user_id) AS video_id, CASE event_type WHEN 'purchase' THEN 'accepted' WHEN 'error' THEN 'error' WHEN 'click' THEN 'rejected' ELSE 'pending' END AS status,
    CASE WHEN event_id % 5 <> 0 THEN value END AS motion_score, CASE WHEN event_id % 3 = 0 AND user_id % 2 = 0 THEN user_id ELSE 0 END AS discovered_order,
    CASE WHEN event_id % 2 = 0 THEN event_id END AS seen_order, event_id AS line_no
  FROM events
), last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY line_no DESC) = 1),
given AS (SELECT video_id, discovered_order FROM log WHERE discovered_order <> 0 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY line_no DESC) = 1),
seen AS (SELECT video_id, min(line_no) AS f FROM log GROUP BY 1),
fresh AS (SELECT video_id, row_number() OVER (ORDER BY f, video_id) AS n FROM seen WHERE video_id NOT IN (SELECT video_id FROM given)),
states AS (
  SELECT l.video_id, l.status, l.motion_score, l.seen_order, CAST(coalesce(g.discovered_order, (SELECT coalesce(max(discovered_order), 0) FROM given) + f.n) AS BIGINT) AS discovered_order
  FROM last l LEFT JOIN given g USING (video_id) LEFT JOIN fresh f USING (video_id)
), queue AS (
  SELECT *, row_number() OVER (ORDER BY seen_order IS NULL, seen_order, CASE WHEN seen_order IS NULL THEN motion_score END NULLS LAST, discovered_order, video_id) AS position FROM states
)
"""


# Words


@query(_BLOCKS + "SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) AS rank FROM (SELECT word, count(*) AS cnt FROM words GROUP BY 1) ORDER BY cnt DESC, word LIMIT 25")
def word_topk(spark, sf_dir):
    return words.top_counts(words.word_counts(b.captions(spark, sf_dir)), "word", 25)


@query(_BLOCKS + "SELECT bigram, cnt, row_number() OVER (ORDER BY cnt DESC, bigram) AS rank FROM (SELECT bigram, count(*) AS cnt FROM pairs GROUP BY 1) ORDER BY cnt DESC, bigram LIMIT 25")
def bigram_topk(spark, sf_dir):
    return words.top_counts(words.bigram_counts(b.captions(spark, sf_dir)), "bigram", 25)


@query(_BLOCKS + "SELECT word, count(*) AS cnt FROM words GROUP BY 1")
def word_counts(spark, sf_dir):
    return words.word_counts(b.captions(spark, sf_dir))


@query(_BLOCKS + "SELECT bigram, count(*) AS cnt FROM pairs GROUP BY 1")
def bigram_counts(spark, sf_dir):
    return words.bigram_counts(b.captions(spark, sf_dir))


@query(
    _BLOCKS
    + "SELECT 1::BIGINT AS manifests, (SELECT count(*) FROM documents) AS caption_rows, (SELECT count(DISTINCT word) FROM words) AS unique_words, (SELECT count(DISTINCT bigram) FROM pairs) AS unique_bigrams"
)
def text_summary(spark, sf_dir):
    return words.summary(b.captions(spark, sf_dir))


@query(_BLOCKS + """, w AS (SELECT word AS k, count(*) AS cnt, row_number() OVER (ORDER BY count(*) DESC, word) AS rank FROM words GROUP BY word),
p AS (SELECT bigram AS k, count(*) AS cnt, row_number() OVER (ORDER BY count(*) DESC, bigram) AS rank FROM pairs GROUP BY bigram)
SELECT 0::INT AS line_no, 'manifests=1 caption_rows=' || (SELECT count(*) FROM documents) || ' unique_words=' || (SELECT count(*) FROM w) || ' unique_bigrams=' || (SELECT count(*) FROM p) AS line
UNION ALL SELECT 2, 'Top 10 words' UNION ALL SELECT (2 + rank)::INT, rank || '. ' || k || ' (' || cnt || ')' FROM w WHERE rank <= 10 UNION ALL SELECT 3, '(none)' WHERE NOT EXISTS (SELECT 1 FROM w)
UNION ALL SELECT 14, 'Top 10 bigrams' UNION ALL SELECT (14 + rank)::INT, rank || '. ' || k || ' (' || cnt || ')' FROM p WHERE rank <= 10 UNION ALL SELECT 15, '(none)' WHERE NOT EXISTS (SELECT 1 FROM p)""")
def text_report(spark, sf_dir):
    return words.report(b.captions(spark, sf_dir), 10)


@query(r"""
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
bare AS (SELECT doc_id, n, trim(line, E' \t\r\n') AS line FROM raw),
body AS (SELECT doc_id, n, CASE WHEN regexp_matches(line, '^`{3,}\s*$') THEN '' ELSE replace(trim(regexp_replace(trim(regexp_replace(line, '(?s)^\s*(?:SCENE_OVERVIEW|VISUAL_DETAILS|DIALOGUE|OTHER_SOUNDS|VISUAL|AUDIO)\s*:?\s*(.*)$', '\1'), E' \t\r\n'), '^(?:[-*+]\s+|\d+\.\s+)', ''), E' \t\r\n'), '`', '') END AS line FROM bare WHERE line <> ''),
text AS (SELECT doc_id, nullif(trim(regexp_replace(string_agg(line, ' ' ORDER BY n) FILTER (WHERE line <> ''), '\s+', ' ', 'g')), '') AS caption FROM body GROUP BY 1)
SELECT doc_id, caption FROM documents LEFT JOIN text USING (doc_id)""")
def caption_normalize(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").select("doc_id", text.normalize_caption(F.col("text")).alias("caption"))


@query("""
SELECT 'documents' AS manifest, count(*) AS n_rows FROM documents UNION ALL SELECT 'benchmark', count(*) FROM benchmark""")
def union_manifests(spark, sf_dir):
    both = b.table(spark, sf_dir, "documents").select(F.lit("documents").alias("manifest"), "text").unionByName(
        b.table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("manifest"), "text")
    )
    return both.groupBy("manifest").agg(F.count("*").alias("n_rows"))


@query("SELECT p_partkey, coalesce(nullif(lower(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', '-', 'g'), '-')), ''), 'search') AS slug FROM part")
def slug_query(spark, sf_dir):
    return b.table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' order:score' ELSE p_name || ' order:id_desc' END AS query FROM part")
def ordered_query(spark, sf_dir):
    asked = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" order:score"))).otherwise(F.col("p_name"))
    return b.table(spark, sf_dir, "part").select("p_partkey", text.ordered_query(asked).alias("query"))


# Tags and sources


@query(_CLIPS + "SELECT tag, count(*) AS cnt FROM tagged GROUP BY 1")
def tag_counts(spark, sf_dir):
    return tags.tag_counts(b.clips(spark, sf_dir))


@query(_CLIPS + "SELECT count(DISTINCT tag) AS unique_tags FROM tagged")
def unique_tags(spark, sf_dir):
    return tags.unique_tags(b.clips(spark, sf_dir))


@query(_CLIPS + "SELECT CAST(sum(c * c) AS BIGINT) AS balance_penalty FROM (SELECT count(*) AS c FROM tagged GROUP BY tag)")
def balance_penalty(spark, sf_dir):
    return tags.balance_penalty(b.clips(spark, sf_dir))


@query(_CLIPS + """SELECT source_id, (SELECT count(*) FROM clips c WHERE c.source_id = s.source_id) AS clip_count, unique_tags, tag_mass
FROM (SELECT c.source_id, count(DISTINCT tag) AS unique_tags, count(tag) AS tag_mass FROM clips c LEFT JOIN tagged t USING (clip_relpath) GROUP BY 1) s""")
def source_stats(spark, sf_dir):
    return tags.source_stats(b.clips(spark, sf_dir))


@query(_CLIPS + "SELECT source_id, tag, count(*) AS cnt FROM tagged GROUP BY ALL")
def source_tag_counts(spark, sf_dir):
    return tags.source_tag_counts(b.clips(spark, sf_dir))


@query(_CLIPS + """, c AS (SELECT tag, count(*) AS cnt FROM tagged GROUP BY 1), s AS (SELECT tag, count(*) AS cnt FROM tagged WHERE source_id = 'en-src1' GROUP BY 1)
SELECT tag, c.cnt - coalesce(s.cnt, 0) AS cnt FROM c LEFT JOIN s USING (tag) WHERE c.cnt - coalesce(s.cnt, 0) > 0""")
def subtracted_counts(spark, sf_dir):
    clips = b.clips(spark, sf_dir)
    return tags.subtracted(tags.tag_counts(clips), tags.tag_counts(clips.where("source_id = 'en-src1'")))


@query("SELECT CAST(CASE WHEN count(*) < 2 THEN 0 ELSE sum(c) - min(c) END AS BIGINT) AS max_val_count FROM (SELECT count(*) AS c FROM documents GROUP BY lang || '-' || source)")
def max_val_count(spark, sf_dir):
    return tags.largest_validation(b.clips(spark, sf_dir))


@query("""SELECT CAST(least(greatest(1, round_even((SELECT count(*) FROM documents) * 0.1, 0)), sum(c) - min(c)) AS BIGINT) AS target_count
FROM (SELECT count(*) AS c FROM documents GROUP BY lang || '-' || source)""")
def target_count(spark, sf_dir):
    return tags.target_count(b.clips(spark, sf_dir), 0.1)


_DISTANCE = _CLIPS + """, side AS (SELECT clip_relpath, source_id LIKE '%src1%' AS one FROM clips),
n AS (SELECT count(*) FILTER (WHERE one) AS n1, count(*) FILTER (WHERE NOT one) AS n2 FROM side),
f AS (SELECT tag, count(*) FILTER (WHERE source_id LIKE '%src1%') AS c1, count(*) FILTER (WHERE source_id NOT LIKE '%src1%') AS c2 FROM tagged GROUP BY 1)
"""


@query(_DISTANCE + "SELECT sum(abs(c1 * n2 - c2 * n1)) / any_value(n1 * n2)::DOUBLE AS distance FROM f, n")
def l1_distance(spark, sf_dir):
    clips = b.clips(spark, sf_dir)
    one = F.col("source_id").contains("src1")
    return tags.distribution_distance(clips.where(one), clips.where(~one))


@query()
def prefix_l1_distance(spark, sf_dir):
    clips = b.clips(spark, sf_dir)
    one = F.col("source_id").contains("src1")
    ranked = ordering.numbered(clips.where(one), [F.col("clip_relpath")], "rank")  # as a validation subset's picks
    return tags.prefix_distances(ranked, clips.where(~one)).withColumn("distribution_distance", F.round("distribution_distance", 9))


@query(_CLIPS + "SELECT clip_relpath, list_sort(list(tag)) AS hints FROM clips JOIN hinted USING (doc_id) GROUP BY 1")
def tag_hints(spark, sf_dir):
    none = F.lit(None).cast("array<string>")
    found = b.clips(spark, sf_dir).select("clip_relpath", tags.hints(F.col("tags"), none, none)["general"].alias("hints"))
    return found.where(F.size("hints") > 0).withColumn("hints", F.array_sort("hints"))


@query("""SELECT doc_id, list_sort(list(DISTINCT w)) AS tags FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents)
WHERE trim(w, E' \t\r\n') <> '' GROUP BY 1""")
def tag_dedupe(spark, sf_dir):
    listed = tags.deduped(F.split("text", " "), stripped=False)
    some = b.table(spark, sf_dir, "documents").select("doc_id", F.array_sort(F.filter(listed, lambda t: text.strip(t) != "")).alias("tags"))
    return some.where(F.size("tags") > 0)


# Manifests


@query("""SELECT o_orderkey, coalesce(nullif(trim(o_orderstatus), 'F'), c.c_name, 'order') AS source_id FROM orders LEFT JOIN customer c ON o_custkey = c_custkey AND c_custkey % 3 <> 0""")
def source_lookup_join(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("clip_relpath"), F.nullif("o_orderstatus", F.lit("F")).alias("source_path"))
    rows = b.table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("string").alias("clip_relpath"), F.col("c_custkey").alias("line_no"), F.col("c_name").alias("source_path"))
    found = manifests.with_source(orders, manifests.source_lookup(rows))
    return found.select("o_orderkey", F.when(F.col("source_id") == F.col("clip_relpath"), "order").otherwise(F.col("source_id")).alias("source_id"))


@query("""WITH h AS (SELECT doc_id, quality, toxic FROM labels)
SELECT d.doc_id, coalesce('q' || CASE WHEN d.doc_id % 2 = 0 THEN h.quality END, 't' || CASE WHEN d.doc_id % 3 = 0 THEN h.toxic END) AS hints FROM documents d LEFT JOIN h USING (doc_id)""")
def tag_hints_join(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("/in/"), "doc_id").alias("clip_path"), F.col("doc_id").cast("string").alias("clip_relpath"))
    labels = b.table(spark, sf_dir, "labels")
    even = labels.where("doc_id % 2 = 0").select(F.concat(F.lit("/in/"), "doc_id").alias("clip_path"), F.lit(None).cast("string").alias("clip_relpath"), F.concat(F.lit("q"), "quality").alias("hints"), F.col("doc_id").alias("line_no"))
    third = labels.where("doc_id % 3 = 0").select(F.lit(None).cast("string").alias("clip_path"), F.col("doc_id").cast("string").alias("clip_relpath"), F.concat(F.lit("t"), "toxic").alias("hints"), F.col("doc_id").alias("line_no"))
    return manifests.with_hints(docs, even.unionByName(third)).select("doc_id", "hints")


# A tags manifest: documents are clips, those with labels were tagged, of which toxic ones failed.
_TAGGED = """
WITH r AS (
  SELECT d.doc_id, '/in/' || d.doc_id || '.mp4' AS clip_path, d.n_chars / 1000.0 AS duration, l.quality, l.toxic, l.doc_id IS NOT NULL AND l.toxic = 0 AS ok, d.lang, d.source
  FROM documents d LEFT JOIN labels l USING (doc_id)
)
"""


def _tag_records(spark, sf_dir):
    docs, labels = b.table(spark, sf_dir, "documents"), b.table(spark, sf_dir, "labels")
    path = F.concat(F.lit("/in/"), "doc_id", F.lit(".mp4")).alias("clip_path")
    clips = docs.select(path, F.when(F.col("doc_id") % 2 == 0, F.concat("doc_id", F.lit(".mp4"))).alias("clip_relpath"), (F.col("n_chars") / 1000).alias("duration"), F.lit(0.5).alias("frame_time"))
    rating = F.when(F.col("quality") == 1, "general").otherwise("sensitive")
    results = labels.join(docs.select("doc_id", "lang", "source"), "doc_id").select(
        path, rating.alias("rating"), F.create_map(rating, F.lit(0.75).cast("float")).alias("rating_scores"), F.array("lang").alias("general_tags"), F.create_map("lang", F.lit(0.5)).alias("general_tag_scores"),
        F.array("source").alias("character_tags"), F.create_map("source", F.lit(0.25)).alias("character_tag_scores"), F.array(rating, F.lit(" "), F.concat(F.lit(" "), "lang"), "lang", "source").alias("all_tags"),
        F.when(F.col("toxic") == 0, "tagged").otherwise("failed").alias("status"), F.when(F.col("toxic") == 0, "").otherwise("refused").alias("error"),
    )
    return records.tag_records(clips, results, "tagger")


@query(_TAGGED + """SELECT clip_path, CASE WHEN doc_id % 2 = 0 THEN doc_id || '.mp4' END AS clip_relpath, 'tagger' AS model_repo, duration::DOUBLE AS duration, 0.5::DOUBLE AS frame_time,
  CASE WHEN ok THEN CASE WHEN quality = 1 THEN 'general' ELSE 'sensitive' END END AS rating, CASE WHEN ok THEN 0.75 END::DOUBLE AS rating_score,
  CASE WHEN ok THEN [lang] ELSE [] END AS general_tags, CASE WHEN ok THEN [source] ELSE [] END AS character_tags, CASE WHEN ok THEN 1 ELSE 0 END AS n_scores,
  CASE WHEN ok THEN [CASE WHEN quality = 1 THEN 'general' ELSE 'sensitive' END, lang, source] ELSE [] END AS all_tags,
  CASE WHEN ok THEN 'tagged' ELSE 'failed' END AS status, CASE WHEN ok THEN '' WHEN toxic IS NULL THEN 'no result' ELSE 'refused' END AS error FROM r""")
def tag_records(spark, sf_dir):
    out = _tag_records(spark, sf_dir)
    return out.withColumn("rating_score", F.try_element_at("rating_scores", F.col("rating"))).withColumn("n_scores", F.size("general_tag_scores")).drop("rating_scores", "general_tag_scores", "character_tag_scores")


@query(_TAGGED + "SELECT doc_id AS line_no, clip_path, doc_id || '.mp4' AS clip_relpath, [lang] AS general, [source] AS character FROM r WHERE ok")
def tag_hint_rows(spark, sf_dir):
    rows = _tag_records(spark, sf_dir).withColumn("line_no", F.regexp_extract("clip_path", r"(\d+)", 1).cast("long"))
    # paths as manifests have them: relative ones, and ones that go up and down
    path = F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("./"), F.substring("clip_path", 5, 99))).when(F.col("line_no") % 3 == 1, F.concat(F.lit("/in/x/.."), F.substring("clip_path", 4, 99))).otherwise(F.col("clip_path"))
    out = records.hint_rows(rows.withColumn("clip_path", path), "/in/")
    return out.select("line_no", "clip_path", "clip_relpath", "hints.general", "hints.character")


@query("""SELECT '/in/' || doc_id || '.mp4' AS clip_path, 'captioner' AS model_repo, n_chars / 1000.0::DOUBLE AS duration, doc_id % 3 <> 0 AS has_audio_track, doc_id % 3 = 1 AS used_audio,
  CASE WHEN doc_id % 3 = 0 THEN 'clip has no audio track' END AS audio_skip_reason, CAST(NULL AS VARCHAR) AS scene_overview, CAST(NULL AS VARCHAR) AS visual_details, CAST(NULL AS VARCHAR) AS dialogue, CAST(NULL AS VARCHAR) AS other_sounds,
  CASE WHEN quality = 1 THEN lang || ' of ' || source END AS caption, CASE WHEN quality = 1 THEN 'captioned' ELSE 'failed' END AS status,
  CASE WHEN quality = 1 THEN '' WHEN quality = 0 THEN 'the caption is empty' ELSE 'no result' END AS error
FROM documents LEFT JOIN labels USING (doc_id)""")
def caption_records(spark, sf_dir):
    docs, labels = b.table(spark, sf_dir, "documents"), b.table(spark, sf_dir, "labels")
    path, key = F.concat(F.lit("/in/"), "doc_id", F.lit(".mp4")).alias("clip_path"), F.col("doc_id") % 3
    clips = docs.select(path, (F.col("n_chars") / 1000).alias("duration"), (key != 0).alias("has_audio_track"), F.when(key > 0, key == 1).alias("used_audio"), F.when(key == 0, "clip has no audio track").alias("audio_skip_reason"))
    said = F.when(F.col("quality") == 1, F.concat(F.lit("- `"), "lang", F.lit("`\n\n* of  "), "source")).otherwise("```\n `")
    results = labels.join(docs.select("doc_id", "lang", "source"), "doc_id").select(path, said.alias("caption"), F.lit("captioned").alias("status"), F.lit("").alias("error"))
    return records.caption_records(clips, results, "captioner")


@query("SELECT doc_id FROM documents d WHERE lang || '-' || source NOT IN (SELECT lang || '-' || source FROM documents WHERE source IN ('src1', 'src7', 'src12'))")
def source_disjoint_antijoin(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "source", F.concat("lang", F.lit("-"), "source").alias("source_id"))
    return manifests.source_disjoint(docs, docs.where(F.col("source").isin("src1", "src7", "src12"))).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_labels(spark, sf_dir):
    return manifests.missing(b.table(spark, sf_dir, "documents"), b.table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_rows(spark, sf_dir):
    return manifests.duplicates(b.table(spark, sf_dir, "orders"), "o_custkey")


def _export(spark, sf_dir):
    docs, labels = b.table(spark, sf_dir, "documents"), b.table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("line_no"),
        F.concat(F.when(F.col("doc_id") % 2 == 0, "clips/../").otherwise("/in/train/"), "doc_id", F.lit(".mp4")).alias("clip_path"),
        F.col("text").alias("caption"),
        F.when(F.col("quality") == 1, "captioned").otherwise("failed").alias("status"),
    )
    listing = b.table(spark, sf_dir, "pages").select(F.concat("page_id", F.lit(".mp4")).alias("media_path"))
    return manifests.export_rows(rows, listing, "train", "/in/train")


@query("""SELECT text AS caption, doc_id || '.mp4' AS media_path FROM documents JOIN labels USING (doc_id)
WHERE quality = 1 AND doc_id IN (SELECT page_id FROM pages) AND trim(text, E' \t\r\n') <> ''""")
def export_rows(spark, sf_dir):
    return _export(spark, sf_dir)[0]


@query("""SELECT split, caption, media_path FROM (
  SELECT CASE WHEN toxic = 1 THEN 'val' ELSE 'train' END AS split, text AS caption, doc_id || '.mp4' AS media_path FROM documents JOIN labels USING (doc_id) WHERE trim(text, E' \t\r\n') <> '')""")
def export_of_all_splits(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents").join(b.table(spark, sf_dir, "labels"), "doc_id")

    def one(name, own):
        path = F.concat("doc_id", F.lit(".mp4"))
        rows = docs.where(own).select(F.col("doc_id").alias("line_no"), F.concat(F.lit(f"/in/{name}/"), path).alias("clip_path"), F.col("text").alias("caption"), F.lit("captioned").alias("status"))
        return manifests.export_rows(rows, docs.where(own).select(path.alias("media_path")), name, f"/in/{name}")[0]

    val = F.coalesce(F.col("toxic") == 1, F.lit(False))
    return manifests.all_splits({"train": one("train", ~val), "val": one("val", val)})


@query("""SELECT path, row_number() OVER (ORDER BY string_split(path, '/')) AS position FROM (SELECT DISTINCT lang || CASE doc_id % 3 WHEN 0 THEN '/' WHEN 1 THEN '!/' ELSE '' END || source || '/' || doc_id AS path FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL)""")
def listing_order(spark, sf_dir):
    kind = F.col("doc_id") % 3
    path = F.concat("lang", F.when(kind == 0, "/").when(kind == 1, "!/").otherwise(""), "source", F.lit("/"), "doc_id")
    paths = b.table(spark, sf_dir, "documents").select(path.alias("path")).where("path is not null").distinct()
    return ordering.numbered(paths, [listing.path_order("path")], "position")


@query("""SELECT doc_id, CASE WHEN source IS NULL OR doc_id % 2 = 0 THEN doc_id || '.mp4' ELSE source || '/' || doc_id || '.mp4' END AS relative_path FROM documents""")
def default_relative_paths(spark, sf_dir):
    folder = F.when(F.col("source").isNull(), "/away").when(F.col("doc_id") % 2 == 0, F.concat(F.lit("/in-"), "source")).otherwise(F.concat(F.lit("/in/"), "source"))
    path = F.concat(folder, F.lit("/"), "doc_id", F.lit(".mp4"))
    return b.table(spark, sf_dir, "documents").select("doc_id", media.default_relative(path, F.lit("/in/")).alias("relative_path"))


@query("""WITH r AS (SELECT doc_id, CASE WHEN quality <> 1 THEN 'status' WHEN trim(text, E' \t\r\n') = '' THEN 'empty caption' WHEN doc_id NOT IN (SELECT page_id FROM pages) THEN 'unknown clip' END AS rule
  FROM documents JOIN labels USING (doc_id)),
good AS (SELECT doc_id FROM r WHERE rule IS NULL)
SELECT rule, count(*) AS cnt FROM (SELECT rule FROM r WHERE rule IS NOT NULL
  UNION ALL SELECT 'missing caption' FROM pages WHERE page_id NOT IN (SELECT doc_id FROM good)) GROUP BY 1""")
def export_violations(spark, sf_dir):
    return _export(spark, sf_dir)[1].groupBy("rule").agg(F.count("*").alias("cnt"))


@query("SELECT event_type AS status, count(*) AS cnt FROM events GROUP BY 1")
def status_summary(spark, sf_dir):
    return review.status_summary(b.table(spark, sf_dir, "events").select(F.col("event_type").alias("status")))


@query("SELECT 'rows=' || count(*) || ' users=' || count(DISTINCT user_id) AS summary FROM events")
def summary_line(spark, sf_dir):
    return sinks.summary_line(b.table(spark, sf_dir, "events").agg(F.count("*").alias("rows"), F.countDistinct("user_id").alias("users")))


# Spans


@query(_SPANS + 'SELECT video, round(start, 6) AS start, round("end", 6) AS "end" FROM unsafe')
def unsafe_spans(spark, sf_dir):
    return spans.unsafe_spans(b.frames(spark, sf_dir), 0.35, 0.25).select("video", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(_SPANS + 'SELECT video, round(start, 6) AS start, round("end", 6) AS "end" FROM merged')
def merged_spans(spark, sf_dir):
    found = spans.merged_spans(spans.unsafe_spans(b.frames(spark, sf_dir), 0.35, 0.25))
    return found.select("video", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(_SPANS + 'SELECT video, round(start, 6) AS start, round("end", 6) AS "end" FROM safe')
def safe_spans(spark, sf_dir):
    found = spans.safe_spans(b.frames(spark, sf_dir), b.videos(spark, sf_dir), 0.35, 0.25, 0.0)
    return found.select("video", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(_SPANS + 'SELECT video, round(start, 6) AS start, round("end", 6) AS "end" FROM safe WHERE "end" - start + 1e-9 >= 2')
def safe_spans_filtered(spark, sf_dir):
    found = spans.safe_spans(b.frames(spark, sf_dir), b.videos(spark, sf_dir), 0.35, 0.25, 2.0)
    return found.select("video", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(_SPANS + """, slots AS (SELECT video, start + unnest(range(0, floor(("end" - start - 1.5 + 1e-9) / 1.75)::BIGINT + 1)) * 1.75 AS start FROM safe WHERE "end" - start + 1e-9 >= 1.5),
numbered AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY start) AS clip_index FROM slots)
SELECT video, clip_index, round(start, 6) AS start, round(start + 1.5, 6) AS "end",
  video || '/clip_' || clip_index || '_' || round_even(start * 1000, 0)::BIGINT || '_' || round_even((start + 1.5) * 1000, 0)::BIGINT || '.mp4' AS clip FROM numbered""")
def tiled_clips_fixed(spark, sf_dir):
    found = spans.safe_spans(b.frames(spark, sf_dir), b.videos(spark, sf_dir), 0.35, 0.25, 1.5)
    tiles = spans.tiled_fixed(found, 1.5, 0.25)
    return tiles.select("video", "clip_index", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "clip")


@query("SELECT video::VARCHAR AS source_path, '/clips/' || clip AS clip_path, start, \"end\", round(\"end\" - start, 6) AS duration, 0.35::DOUBLE AS boundary_threshold, 0.25::DOUBLE AS boundary_padding, 'high_recall_any' AS boundary_mode, 7 AS seed FROM (" + ORACLES["tiled_clips_fixed"] + ")")
def extract_records(spark, sf_dir):
    out = records.extract_records(tiled_clips_fixed(spark, sf_dir), "/clips/", 0.35, 0.25, 7)
    return out.withColumn("duration", F.round("duration", 6))


@query()
def tiled_clips_seeded(spark, sf_dir):
    found = spans.safe_spans(b.frames(spark, sf_dir), b.videos(spark, sf_dir), 0.35, 0.25, 1.0)
    return spans.tiled_seeded(found, 0, 1.0, 5.0, 0.25)


@query("SELECT user_id AS video, sum(CASE WHEN value >= 175 THEN 1 ELSE 0 END) AS hot FROM events GROUP BY 1")
def combined_scores(spark, sf_dir):
    heads = b.frames(spark, sf_dir).groupBy("video").agg(F.array_sort(F.collect_list(F.struct("frame", "score"))).alias("s"))
    one = F.transform("s", lambda x: F.when(x["frame"] % 2 == 0, x["score"]).otherwise(0.0))
    other = F.transform("s", lambda x: F.when(x["frame"] % 2 == 1, x["score"]).otherwise(0.0))
    both = heads.select("video", spans.combined_scores(one, other).alias("s"))
    return both.select("video", F.size(F.filter("s", lambda x: x >= 0.35)).cast("long").alias("hot"))


# Buckets


@query(_SIZES + "SELECT * FROM features")
def feature_points(spark, sf_dir):
    return buckets.feature_points(b.clip_sizes(spark, sf_dir))


@query("""SELECT DISTINCT f AS frames, CASE WHEN f <= 1 THEN 1 WHEN f - ((f - 1) // 8 * 8 + 1) <= 4 THEN (f - 1) // 8 * 8 + 1 ELSE (f - 1) // 8 * 8 + 9 END::BIGINT AS quantized
FROM (SELECT (p_partkey % 121 + 1)::INT AS f FROM part)""")
def quantize_frames(spark, sf_dir):
    return b.clip_sizes(spark, sf_dir).select("frames", numbers.quantized_frames(F.col("frames")).alias("quantized")).distinct()


_PROJECTED = _SIZES + """, ratios AS (SELECT DISTINCT width / height AS aspect FROM features),
centers AS (SELECT aspect, greatest(1, round_even(512 * sqrt(aspect) / 32, 0)::BIGINT) AS cw, greatest(1, round_even(512 / sqrt(aspect) / 32, 0)::BIGINT) AS ch FROM ratios),
ws AS (SELECT aspect, ch, unnest(range(greatest(1, cw - 16), cw + 17)) * 32 AS w FROM centers),
grid AS (SELECT aspect, w, unnest(range(greatest(1, ch - 16), ch + 17)) * 32 AS h FROM ws),
projected AS (SELECT aspect, w AS bucket_width, h AS bucket_height FROM grid
  QUALIFY row_number() OVER (PARTITION BY aspect ORDER BY abs(ln(w / h / aspect)), abs(w * h - 262144), w, h) = 1)
"""


@query(_PROJECTED + """SELECT f.*, bucket_width::INT AS bucket_width, bucket_height::INT AS bucket_height,
  CASE WHEN frames <= 1 THEN 1 WHEN frames - ((frames - 1) // 8 * 8 + 1) <= 4 THEN (frames - 1) // 8 * 8 + 1 ELSE (frames - 1) // 8 * 8 + 9 END::BIGINT AS bucket_frames
FROM features f JOIN projected p ON f.width / f.height = p.aspect""")
def bucket_projection(spark, sf_dir):
    return buckets.projected(buckets.feature_points(b.clip_sizes(spark, sf_dir)), 512)


@query(_SIZES + """, costs AS (SELECT a.width, a.height, a.frames, sum((abs(ln((a.width / a.height) / (o.width / o.height))) + abs(ln(a.frames / o.frames))) * o.weight) AS cost
  FROM features a CROSS JOIN features o GROUP BY ALL)
SELECT width, height, frames, round(cost, 3) AS cost FROM costs ORDER BY round(cost, 9), width / height, frames, width, height LIMIT 1""")
def bucket_seed(spark, sf_dir):
    return buckets.seed(buckets.feature_points(b.clip_sizes(spark, sf_dir))).withColumn("cost", F.round("cost", 3))


def _chosen(spark):
    return spark.createDataFrame([(512, 512, 33), (768, 448, 17), (448, 768, 65), (1024, 576, 97)], "bucket_width int, bucket_height int, bucket_frames int")


@query(_SIZES + f""", b AS (SELECT * FROM {_CHOSEN} v(bucket_width, bucket_height, bucket_frames)),
near AS (SELECT f.*, b.* FROM features f CROSS JOIN b QUALIFY row_number() OVER (PARTITION BY width, height, frames
  ORDER BY round(abs(ln((bucket_width / bucket_height) / (width / height))) + abs(ln(bucket_frames / frames)), 12), bucket_width / bucket_height, bucket_frames, bucket_width, bucket_height) = 1)
SELECT b.*, CAST(coalesce(sum(weight), 0) AS BIGINT) AS weight FROM b LEFT JOIN near USING (bucket_width, bucket_height, bucket_frames) GROUP BY ALL""")
def bucket_assign(spark, sf_dir):
    return buckets.assigned(buckets.feature_points(b.clip_sizes(spark, sf_dir)), _chosen(spark))


@query(_PROJECTED + """, found AS (SELECT DISTINCT bucket_width::INT AS w, bucket_height::INT AS h,
  CASE WHEN frames <= 1 THEN 1 WHEN frames - ((frames - 1) // 8 * 8 + 1) <= 4 THEN (frames - 1) // 8 * 8 + 1 ELSE (frames - 1) // 8 * 8 + 9 END::BIGINT AS f
  FROM features f JOIN projected p ON f.width / f.height = p.aspect)
SELECT string_agg(w || 'x' || h || 'x' || f, ';' ORDER BY w / h, f, w, h) AS buckets FROM found""")
def bucket_list(spark, sf_dir):
    return buckets.listed(buckets.projected(buckets.feature_points(b.clip_sizes(spark, sf_dir)), 512))


@query()
def bucket_greedy(spark, sf_dir):
    return buckets.greedy(buckets.feature_points(b.clip_sizes(spark, sf_dir)), 512)


# Splits


@query()
def balanced_subset(spark, sf_dir):
    return splits.balanced_subset(clips := b.clips(spark, sf_dir), min(1000, clips.count()))


@query()
def validation_subset(spark, sf_dir):
    return splits.validation_subset(clips := b.clips(spark, sf_dir), tags.resolved_count(clips, fraction=0.1))


@query()
def split_summary(spark, sf_dir):
    clips = b.clips(spark, sf_dir)
    train, validation = splits.split(clips, tags.resolved_count(clips, fraction=0.1))
    both = train.select(F.lit("train").alias("split"), "selection_rank", "new_tags_added", F.lit(None).cast("double").alias("distribution_distance")).unionByName(
        validation.select(F.lit("val").alias("split"), "selection_rank", "new_tags_added", "distribution_distance")
    )
    return both.groupBy("split").agg(F.count("*").alias("clips"), F.sum("new_tags_added").alias("tags"), F.max_by("distribution_distance", "selection_rank").alias("distance"))


@query("SELECT count(*) AS clips, count(DISTINCT doc_id // 5) AS sources, 5 * count(*) AS tag_rows, min(doc_id // 5)::BIGINT AS first_source FROM documents")
def synthetic_clips(spark, sf_dir):
    made = jsonl.synthetic_clips(b.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")))
    source = F.regexp_extract("source_id", r"(\d+)", 1).cast("long")
    return made.agg(F.count("*").alias("clips"), F.countDistinct("source_id").alias("sources"), F.sum(F.size(F.array_distinct("tags"))).cast("long").alias("tag_rows"), F.min(source).alias("first_source"))


# Review


@query(_LOG + "SELECT * FROM states")
def review_latest_state(spark, sf_dir):
    return review.latest_states(b.review_log(spark, sf_dir))


@query(_LOG + "SELECT position, video_id FROM queue")
def review_queue_order(spark, sf_dir):
    return review.queue(review.latest_states(b.review_log(spark, sf_dir))).select("position", "video_id")


@query(_LOG + """SELECT coalesce((SELECT video_id FROM queue WHERE status = 'pending' AND seen_order IS NULL ORDER BY position LIMIT 1),
  (SELECT video_id FROM states WHERE status = 'pending' ORDER BY seen_order, discovered_order, video_id LIMIT 1), (SELECT video_id FROM queue ORDER BY position DESC LIMIT 1)) AS video_id""")
def review_start(spark, sf_dir):
    return review.start(review.latest_states(b.review_log(spark, sf_dir)))


@query(_LOG + "SELECT position, video_id, lag(video_id, 1, video_id) OVER (ORDER BY position) AS previous, lead(video_id, 1, video_id) OVER (ORDER BY position) AS next FROM queue")
def review_neighbours(spark, sf_dir):
    return review.neighbours(review.queue(review.latest_states(b.review_log(spark, sf_dir))))


@query(_LOG + "SELECT position, video_id FROM queue WHERE abs(position - 20) <= 8 ORDER BY abs(position - 20), position < 20 LIMIT 8")
def preview_candidates(spark, sf_dir):
    return review.preview_candidates(review.queue(review.latest_states(b.review_log(spark, sf_dir))), 20)


@query(_LOG + "SELECT CAST(max(discovered_order) AS BIGINT) AS max_discovered, coalesce(max(seen_order), 0) AS max_seen FROM states")
def review_marks(spark, sf_dir):
    return review.order_marks(review.latest_states(b.review_log(spark, sf_dir)))


@query(_LOG + "SELECT video_id, CASE WHEN status = 'pending' AND seen_order IS NOT NULL THEN 'accepted' ELSE status END AS shown FROM states")
def review_shown(spark, sf_dir):
    return review.latest_states(b.review_log(spark, sf_dir)).select("video_id", media.shown_state(F.col("status"), F.col("seen_order")).alias("shown"))


@query(_LOG + "SELECT printf('v%05d', c_custkey) AS video_id, printf('/in/v%05d.mp4', c_custkey) AS path FROM customer WHERE printf('v%05d', c_custkey) NOT IN (SELECT video_id FROM states)")
def review_new_videos(spark, sf_dir):
    listing = b.table(spark, sf_dir, "customer").select(F.format_string("v%05d", "c_custkey").alias("video_id"), F.format_string("/in/v%05d.mp4", "c_custkey").alias("path"))
    return review.newly_found(review.latest_states(b.review_log(spark, sf_dir)), listing)


@query(_LOG + """SELECT video_id, CASE WHEN status = 'pending' AND c_custkey IS NOT NULL THEN '/new/' || video_id ELSE '/old/' || video_id END AS current_path
FROM states LEFT JOIN (SELECT c_custkey, printf('v%05d', c_custkey) AS video_id FROM customer WHERE c_custkey % 2 = 0) USING (video_id)""")
def review_scan(spark, sf_dir):
    states = review.latest_states(b.review_log(spark, sf_dir)).withColumn("current_path", F.concat(F.lit("/old/"), "video_id"))
    name = F.format_string("v%05d", "c_custkey")
    listing = b.table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(name.alias("video_id"), F.concat(F.lit("/new/"), name).alias("path"))
    return review.scanned(states, listing).select("video_id", "current_path")


@query("""WITH e AS (SELECT label AS video_id, vec_id, embedding, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM embeddings)
SELECT video_id::BIGINT AS video_id, round(coalesce(avg(list_sum(list_transform(list_zip(embedding, before), lambda p: abs(p[1]::DOUBLE - p[2]::DOUBLE))) / len(embedding)) FILTER (WHERE before IS NOT NULL), 0) / 255, 9) AS motion_score FROM e GROUP BY 1""")
def motion_score(spark, sf_dir):
    frames = b.table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("video_id"), F.col("vec_id").alias("frame"), F.col("embedding").alias("luma"))
    return review.motion_scores(frames).withColumn("motion_score", F.round("motion_score", 9))


# What the streams compute, over the whole log at once


@query(_LOG + """SELECT l.video_id, l.status, '/in/' || l.video_id AS current_path, l.motion_score, l.seen_order, g.discovered_order, l.line_no
FROM last l LEFT JOIN given g USING (video_id)""")
def stream_latest(spark, sf_dir):
    return stream.latest(b.review_log(spark, sf_dir).withColumn("current_path", F.concat(F.lit("/in/"), "video_id")))


@query(_LOG + "SELECT DISTINCT video_id FROM log")
def stream_first_seen(spark, sf_dir):
    return stream.first_seen(b.review_log(spark, sf_dir)).select("video_id")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS hour, event_type, count(*) AS cnt FROM events GROUP BY ALL")
def stream_windowed_counts(spark, sf_dir):
    counted = stream.windowed_counts(b.table(spark, sf_dir, "events"), "1 hour")
    return counted.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "cnt")


# Clip plans


@query(_DURATIONS + """SELECT p_partkey, least(2.0, duration)::DOUBLE AS length, greatest((duration - least(2.0, duration)) / 2, 0)::DOUBLE AS start FROM d""")
def preview_window(spark, sf_dir):
    d = b.durations(spark, sf_dir)
    return d.select("p_partkey", numbers.preview_length(F.col("duration")).alias("length"), numbers.preview_start(F.col("duration")).alias("start"))


@query(_DURATIONS + "SELECT p_partkey, least(duration * 0.5, greatest(duration - 0.001, 0.0))::DOUBLE AS frame_time FROM d")
def frame_time(spark, sf_dir):
    return b.durations(spark, sf_dir).select("p_partkey", numbers.frame_time(F.col("duration")).alias("frame_time"))


@query(_DURATIONS + """SELECT p_partkey, CASE WHEN total_frames > 0 THEN least(greatest(12, ceil(total_frames * 0.5)), total_frames) WHEN fps > 0 THEN NULL ELSE 12 END::BIGINT AS frames,
  CASE WHEN coalesce(total_frames, 0) = 0 AND fps > 0 THEN fps * 0.5 END AS fps FROM d""")
def frame_plan(spark, sf_dir):
    plan = b.durations(spark, sf_dir).select("p_partkey", media.frame_plan(F.col("total_frames"), F.col("fps")).alias("plan"))
    return plan.select("p_partkey", "plan.frames", "plan.fps")


@query(_DURATIONS + """SELECT p_partkey, CASE WHEN NOT has_audio THEN 'clip has no audio track' WHEN p_partkey % 9 = 0 THEN 'model does not support audio input'
  WHEN duration > 30 THEN 'clip audio exceeds 30s limit' END AS reason, CASE WHEN duration > 60 THEN 'clip duration exceeds 60s video limit' END AS error FROM d""")
def audio_plan(spark, sf_dir):
    d = b.durations(spark, sf_dir)
    return d.select("p_partkey", media.audio_plan(F.col("has_audio"), F.col("p_partkey") % 9 != 0, F.col("duration")).alias("reason"), media.length_error(F.col("duration")).alias("error"))


@query("""SELECT p_partkey, (p_size * 64)::BIGINT AS width, CASE WHEN p_partkey % 6 <> 0 THEN 480 END::BIGINT AS height, p_retailprice / 1000 AS duration,
  CASE WHEN p_partkey % 4 = 0 THEN 30.0 ELSE 24.0 END::DOUBLE AS fps, CASE WHEN p_partkey % 3 = 0 AND p_partkey > 0 THEN p_partkey ELSE greatest(1, round_even(p_retailprice / 1000 * CASE WHEN p_partkey % 4 = 0 THEN 30 ELSE 24 END, 0)) END::BIGINT AS frames,
  p_partkey % 2 = 0 AS has_audio FROM part""")
def probe_json(spark, sf_dir):
    part, key = b.table(spark, sf_dir, "part"), F.col("p_partkey")
    json = F.concat(
        F.lit('{"format":{"duration":"'), F.col("p_retailprice") / 1000, F.lit('"},"streams":['),
        F.when(key % 2 == 0, '{"codec_type":"audio"},').otherwise(""),
        F.lit('{"codec_type":"video","width":"'), F.col("p_size") * 64, F.lit('","height":"'), F.when(key % 6 != 0, "480").otherwise("N/A"),
        F.lit('","avg_frame_rate":"'), F.when(key % 4 == 0, "0/0").otherwise("24/1"), F.lit('","r_frame_rate":"30/1","nb_frames":"'),
        F.when(key % 3 == 0, key.cast("string")).otherwise("N/A"), F.lit('"}]}'),
    )
    return part.select("p_partkey", media.probe(json).alias("p")).select("p_partkey", "p.*")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 AND p_size > 0 THEN p_size END::DOUBLE AS duration, p_partkey % 2 = 0 AS has_audio,
  CASE WHEN p_partkey % 4 = 0 THEN 30.0 WHEN p_partkey % 4 = 1 THEN NULL ELSE 24.0 END::DOUBLE AS fps,
  CASE p_partkey % 3 WHEN 0 THEN p_partkey WHEN 1 THEN p_partkey ELSE CASE WHEN p_partkey % 4 = 1 OR p_partkey % 5 = 0 OR p_size <= 0 THEN NULL ELSE greatest(1, p_size * CASE WHEN p_partkey % 4 = 0 THEN 30 ELSE 24 END) END END::BIGINT AS frames FROM part""")
def caption_probe_json(spark, sf_dir):
    part, key = b.table(spark, sf_dir, "part"), F.col("p_partkey")
    json = F.concat(
        F.lit('{"format":{"duration":"'), F.when(key % 5 != 0, F.col("p_size").cast("string")).otherwise("N/A"), F.lit('"},"streams":['),
        F.when(key % 2 == 0, '{"codec_type":"audio"},').otherwise(""),
        F.lit('{"codec_type":"video","avg_frame_rate":"'), F.when(key % 4 < 2, "0/1").otherwise("24/1"),
        F.lit('","r_frame_rate":"'), F.when(key % 4 == 1, "0/0").otherwise("30/1"), F.lit('","nb_frames":'),
        F.when(key % 3 == 0, F.concat(F.lit('"'), key, F.lit('"'))).when(key % 3 == 1, F.concat(key, F.lit(".75"))).otherwise('"12.5"'), F.lit("}]}"),
    )
    return part.select("p_partkey", media.caption_probe(json).alias("p")).select("p_partkey", "p.*")


@query(_DURATIONS + "SELECT p_partkey, CASE WHEN total_frames > 0 THEN greatest(40, round_even(duration / total_frames * 1000, 0)) END::BIGINT AS delay_ms FROM d")
def frame_delay(spark, sf_dir):
    shown = F.when(F.col("total_frames") > 0, F.col("total_frames"))
    return b.durations(spark, sf_dir).select("p_partkey", F.when(shown.isNotNull(), numbers.frame_delay_ms(F.col("duration"), shown)).alias("delay_ms"))


@query("SELECT doc_id, quality::DOUBLE AS quality, toxic::DOUBLE AS toxic FROM labels")
def score_maps(spark, sf_dir):
    scores = F.create_map(F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"), F.col("toxic").cast("string"))
    return b.table(spark, sf_dir, "labels").select("doc_id", tags.scores_as_doubles(scores).alias("s")).select("doc_id", F.col("s")["quality"].alias("quality"), F.col("s")["toxic"].alias("toxic"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN p_retailprice WHEN p_partkey % 4 = 2 THEN NULL ELSE NULL END AS x,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size / (p_partkey % 3)::DOUBLE END AS f FROM part""")
def lenient_numbers(spark, sf_dir):
    part, key = b.table(spark, sf_dir, "part"), F.col("p_partkey")
    value = F.when(key % 4 == 0, "N/A").when(key % 4 == 1, F.concat(F.lit(" "), F.col("p_retailprice"))).when(key % 4 == 2, F.concat(F.lit("-"), F.col("p_retailprice"))).otherwise("NaN")
    return part.select("p_partkey", numbers.safe_float(value).alias("x"), numbers.fraction(F.concat("p_size", F.lit("/"), key % 3)).alias("f"))


_PROMPT = r"""'Describe this video clip in one paragraph, in the order in which things happen.' || chr(10) || 'State only what can be seen or heard; no labels, lists or other formatting.' || chr(10)"""


@query(_CLIPS + f"""SELECT c.clip_relpath, {_PROMPT} || CASE WHEN any_value(k.tag) IS NULL THEN '' ELSE 'Tags that a separate model suggests; trust the clip where they disagree.' || chr(10)
  || 'Visual hints: ' || string_agg(k.tag, ', ' ORDER BY k.p) || chr(10) END || CASE WHEN c.doc_id % 2 = 0 THEN 'Name speech, music and other sounds where they occur.' ELSE 'Describe only what can be seen.' END AS prompt
FROM clips c LEFT JOIN hinted k USING (doc_id) GROUP BY c.doc_id, c.clip_relpath""")
def prompt_text(spark, sf_dir):
    clips = b.clips(spark, sf_dir)
    none = F.lit(None).cast("array<string>")
    even = F.regexp_extract("clip_relpath", r"(\d+)\.mp4$", 1).cast("long") % 2 == 0
    found = clips.withColumn("h", tags.hints(F.col("tags"), none, none))
    return found.select("clip_relpath", media.prompt(even, F.col("h.general"), F.col("h.character")).alias("prompt"))


@query(f"""SELECT doc_id, 2::BIGINT AS n_messages, lang || '/doc_' || doc_id || '.mp4' AS video, {_PROMPT} || 'Describe only what can be seen.' AS said FROM documents""")
def chat_messages(spark, sf_dir):
    docs, none = b.table(spark, sf_dir, "documents"), F.array().cast("array<string>")
    path = F.concat("lang", F.lit("/doc_"), "doc_id", F.lit(".mp4"))
    sent = docs.select("doc_id", media.messages(path, media.prompt(F.lit(False), none, none)).alias("m"))
    user = F.element_at("m", 2)["content"]
    return sent.select("doc_id", F.size("m").cast("long").alias("n_messages"), F.element_at(user, 1)["video"].alias("video"), F.element_at(user, 2)["text"].alias("said"))


@query("SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'mp4' ELSE 'webm' END AS file_ext, p_size::BIGINT AS file_size FROM part WHERE p_partkey % 3 < 2 ORDER BY p_partkey DESC LIMIT 50")
def feed_filter(spark, sf_dir):
    part, key = b.table(spark, sf_dir, "part"), F.col("p_partkey")
    ext = F.when(key % 3 == 0, "MP4").when(key % 3 == 1, "webm").otherwise("png")
    xml = F.concat(F.lit('<posts><post id="'), key, F.lit('" file_ext="'), ext, F.lit('" file_url="u" file_size="'), F.col("p_size"), F.lit('" tags="a b"/></posts>'))
    return jsonl.matching_posts(jsonl.posts(part.select(xml.alias("xml"))), 50).select("id", "file_ext", "file_size")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'complete' WHEN p_partkey % 3 = 1 THEN 'part-complete' END AS found FROM part""")
def existing_downloads(spark, sf_dir):
    size, key = F.col("p_size") + 1, F.col("p_partkey")
    return b.table(spark, sf_dir, "part").select("p_partkey", sinks.existing_download(size, F.when(key % 3 == 0, size), F.when(key % 3 == 1, size)).alias("found"))


@query("""WITH f AS (SELECT p_partkey, p_partkey // 20 + 1 AS page, p_partkey % 20 AS position, CASE p_partkey % 3 WHEN 0 THEN 'mp4' WHEN 1 THEN 'webm' ELSE 'png' END AS ext FROM part WHERE p_partkey <> 1015),
s AS (SELECT page, count(*) AS n FROM f GROUP BY 1)
SELECT p_partkey AS id, p_partkey || '.' || ext AS file FROM f WHERE ext <> 'png' AND page <= (SELECT min(page) FROM s WHERE n < 20 OR page + 1 NOT IN (SELECT page FROM s)) ORDER BY page, position LIMIT 900""")
def paged_feed(spark, sf_dir):
    key = F.col("p_partkey")
    ext = F.when(key % 3 == 0, "mp4").when(key % 3 == 1, "webm").otherwise("png")
    found = b.table(spark, sf_dir, "part").where("p_partkey <> 1015").select(key.alias("id"), ext.alias("file_ext"), (F.floor(key / 20) + 1).alias("page"), (key % 20).alias("position"))
    return jsonl.paged_posts(found, 900, 20).select("id", jsonl.post_file(F.col("id"), F.col("file_ext")).alias("file"))


@query("""WITH a AS (SELECT event_id, printf('v%05d', user_id) AS video_id, CASE event_type WHEN 'purchase' THEN 'accept' WHEN 'error' THEN 'error' WHEN 'click' THEN 'leave' WHEN 'view' THEN 'view' ELSE 'reject' END AS action FROM events),
said AS (SELECT video_id, arg_max(action, event_id) FILTER (WHERE action IN ('accept', 'reject', 'error')) AS last, min(event_id) FILTER (WHERE action = 'view') AS viewed, max(event_id) FILTER (WHERE action = 'leave') AS gone FROM a GROUP BY 1)
SELECT printf('v%05d', c_custkey) AS video_id, CASE last WHEN 'accept' THEN 'accepted' WHEN 'reject' THEN 'rejected' WHEN 'error' THEN 'error' ELSE CASE WHEN gone > viewed THEN 'accepted' ELSE 'pending' END END AS status, viewed IS NOT NULL AS seen
FROM customer LEFT JOIN said ON video_id = printf('v%05d', c_custkey)""")
def review_decisions(spark, sf_dir):
    kind = F.col("event_type")
    action = F.when(kind == "purchase", "accept").when(kind == "error", "error").when(kind == "click", "leave").when(kind == "view", "view").otherwise("reject")
    actions = b.table(spark, sf_dir, "events").select(F.format_string("v%05d", "user_id").alias("video_id"), action.alias("action"), F.col("event_id").alias("action_no"))
    states = b.table(spark, sf_dir, "customer").select(F.format_string("v%05d", "c_custkey").alias("video_id"), F.lit("pending").alias("status"))
    return review.decided(states, actions)


_SESSION = _LOG.replace("WITH log", "WITH RECURSIVE log", 1) + """, begin AS (
  SELECT coalesce((SELECT video_id FROM queue WHERE status = 'pending' AND seen_order IS NULL ORDER BY position LIMIT 1),
    (SELECT video_id FROM states WHERE status = 'pending' ORDER BY seen_order, discovered_order, video_id LIMIT 1), (SELECT video_id FROM queue ORDER BY position DESC LIMIT 1)) AS begin
), marked AS (
  SELECT s.* REPLACE (CASE WHEN video_id = begin AND seen_order IS NULL THEN (SELECT coalesce(max(seen_order), 0) + 1 FROM states) ELSE seen_order END AS seen_order) FROM states s, begin
), ordered AS (
  SELECT video_id, row_number() OVER (ORDER BY seen_order IS NULL, seen_order, CASE WHEN seen_order IS NULL THEN motion_score END NULLS LAST, discovered_order, video_id) AS position FROM marked
), acts AS (
  SELECT event_id AS action_no, row_number() OVER (ORDER BY event_id) AS k,
    CASE event_type WHEN 'purchase' THEN 'accept' WHEN 'error' THEN 'error' WHEN 'click' THEN 'next' WHEN 'view' THEN 'previous' ELSE 'reject' END AS action FROM events
), steps AS (SELECT *, CASE action WHEN 'error' THEN 0 WHEN 'previous' THEN -1 ELSE 1 END AS step FROM acts),
walk AS (
  SELECT 1::BIGINT AS k, (SELECT position FROM ordered JOIN begin ON video_id = begin) AS position
  UNION ALL SELECT w.k + 1, greatest(1, least((SELECT count(*) FROM ordered), w.position + s.step)) FROM walk w JOIN steps s ON s.k = w.k
), replay AS (
  SELECT s.action_no, s.action, a.video_id, b.video_id AS moved_to FROM steps s JOIN walk w USING (k) JOIN walk v ON v.k = w.k + 1
  JOIN ordered a ON a.position = w.position JOIN ordered b ON b.position = v.position
)
"""


def _session(spark, sf_dir):
    kind = F.col("event_type")
    action = F.when(kind == "purchase", "accept").when(kind == "error", "error").when(kind == "click", "next").when(kind == "view", "previous").otherwise("reject")
    states = review.latest_states(b.review_log(spark, sf_dir))
    return states, review.replayed(states, b.table(spark, sf_dir, "events").select(F.col("event_id").alias("action_no"), action.alias("action")))


@query(_SESSION + "SELECT * FROM replay")
def review_session(spark, sf_dir):
    return _session(spark, sf_dir)[1]


@query(_SESSION + """, done AS (
  SELECT video_id, arg_max(action, action_no) FILTER (WHERE action IN ('accept', 'reject', 'error')) AS said, max(action_no) FILTER (WHERE action IN ('next', 'previous') AND video_id <> moved_to) AS gone FROM replay GROUP BY 1
), views AS (SELECT video_id, min(n) AS viewed FROM (SELECT moved_to AS video_id, action_no AS n FROM replay WHERE moved_to <> video_id UNION ALL SELECT begin, -1 FROM begin) GROUP BY 1)
SELECT video_id, CASE said WHEN 'accept' THEN 'accepted' WHEN 'reject' THEN 'rejected' WHEN 'error' THEN 'error' ELSE CASE WHEN status = 'pending' AND gone > viewed THEN 'accepted' ELSE status END END AS status, viewed IS NOT NULL AS seen
FROM states LEFT JOIN done USING (video_id) LEFT JOIN views USING (video_id)""")
def review_session_states(spark, sf_dir):
    return review.session_states(*_session(spark, sf_dir))


@query("""SELECT printf('v%05d', c_custkey) AS video_id, CASE WHEN o.k IS NOT NULL THEN '/now/' || c_custkey WHEN c_custkey IN (SELECT s_suppkey FROM supplier) THEN '/in/' || c_custkey || '.mp4'
  WHEN c_custkey IN (SELECT p_partkey FROM part WHERE p_size > 25) THEN '/keep/' || c_custkey || '.mp4' WHEN c_custkey % 5 = 0 THEN '/first/' || c_custkey END AS source_path
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P') o ON k = c_custkey""")
def source_candidates(spark, sf_dir):
    key, path = F.col("c_custkey"), lambda folder, k, end="": F.concat(F.lit(folder), k, F.lit(end)).alias("path")
    customers = b.table(spark, sf_dir, "customer")
    states = customers.select(F.format_string("v%05d", key).alias("video_id"), path("/now/", key).alias("current_path"), path("", key, ".mp4").alias("relative_path"), path("/first/", key).alias("original_path"))
    listing = b.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(path("/now/", F.col("o_custkey")))
    listing = listing.unionByName(b.table(spark, sf_dir, "supplier").select(path("/in/", F.col("s_suppkey"), ".mp4")))
    listing = listing.unionByName(b.table(spark, sf_dir, "part").where("p_size > 25").select(path("/keep/", F.col("p_partkey"), ".mp4")))
    listing = listing.unionByName(customers.where(key % 5 == 0).select(path("/first/", key)))
    return review.existing_sources(states, listing, ("/in", "/keep/", "/reject"))


@query(_DURATIONS + """SELECT p_partkey, CASE WHEN fps IS NULL OR total_frames IS NULL THEN NULL ELSE least(duration, total_frames / fps) END AS analysed,
  CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 <> 0 THEN (p_partkey % 4) / (p_partkey % 3)::DOUBLE END AS rate FROM d""")
def analysed_durations(spark, sf_dir):
    d, key = b.durations(spark, sf_dir), F.col("p_partkey")
    known = F.col("fps").isNotNull() & F.col("total_frames").isNotNull()
    return d.select(
        "p_partkey",
        F.when(known, numbers.analysed_duration(F.col("duration"), F.col("total_frames"), F.col("fps"))).alias("analysed"),
        numbers.positive_fraction(F.concat(key % 4, F.lit("/"), key % 3)).alias("rate"),
    )
