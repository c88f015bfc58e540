"""The queries of the training-data operators: operator N as ``opN_<name>``, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, fim, langid, licenses, linededup, mixing, mpeg, ngramjoin, quality, toxicity, whitening, wrappers
from .common import held_out, label_table, table


def op1_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    return chat.digest(chat.prefix_target_examples(turns.unionByName(extra)))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.overlaps(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


_OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
dp AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
bp AS (SELECT item_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM b WHERE len(w) >= 4),
hits AS (
  SELECT doc_id, item_id, dp.p - bp.p AS diagonal FROM dp JOIN bp USING (x) GROUP BY ALL HAVING count(*) >= 4
), equal AS (
  SELECT h.*, least(10, greatest(4, CAST(ceil(0.75 * len(b.w)) AS INT))) AS need,
    list_filter(range(greatest(1, 1 - diagonal), least(len(b.w), len(d.w) - diagonal) + 1), lambda k: d.w[diagonal + k] = b.w[k]) AS places
  FROM hits h JOIN b USING (item_id) JOIN d USING (doc_id)
), ends AS (
  SELECT *, unnest(range(1, len(places) + 1)) AS j FROM equal WHERE len(places) >= need
), stretches AS (
  SELECT *, unnest(range(1, j - need + 2)) AS i FROM ends WHERE j >= need
), best AS (
  SELECT doc_id, item_id, diagonal, j - i + 1 AS n, places[j] - places[i] + 1 AS words, places[i] - 1 AS start FROM stretches
  WHERE 4 * (j - i + 1) >= 3 * (places[j] - places[i] + 1)
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY n DESC, words, start) = 1
)
SELECT doc_id, item_id, CAST(diagonal + start AS BIGINT) AS doc_start, CAST(words AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_matches
FROM best QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, diagonal + start, words) = 1
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = label_table(table(spark, sf_dir, "labels"), "toxic").where(~held_out(F.col("doc_id"), 3, 1))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("toxic_spans").alias("n_spans"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """All documents with size, source_size, target and taken; each belongs to the one source it names."""
    sized = docs.select("doc_id", F.array("source").alias("sources"), mixing.words(F.col("text")).alias("size"))
    out, sources = mixing.mix(sized)
    # one row per source, which the mix has already held on the driver
    known = docs.sparkSession.createDataFrame([(s, *x) for s, x in sources.items()], "source string, source_size long, target double")
    known = F.broadcast(known) if len(sources) <= mixing.BROADCAST_ROWS else known
    out = out.withColumn("source", F.element_at("sources", 1))
    return out.join(known, out["source"].eqNullSafe(known["source"])).select("doc_id", "size", "source_size", "target", "taken")


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("_lines").cast("long").alias("n_lines"), F.col("_gone").cast("long").alias("n_removed"))


_OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents
), bare AS (
  SELECT *, regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g') AS x FROM lines
), seq AS (
  SELECT doc_id, n, x, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i, len(regexp_extract_all(x, '[^ 	-
]+')) AS w
  FROM bare WHERE x <> ''
), cum AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS c FROM seq
), runs AS (
  SELECT a.doc_id, a.i AS a, min(b.i) AS b FROM cum a JOIN cum b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.c - a.c + a.w >= 50 GROUP BY ALL
  UNION
  SELECT a.doc_id, max(a.i) AS a, b.i AS b FROM cum a JOIN cum b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.c - a.c + a.w >= 50 GROUP BY a.doc_id, b.i
), keyed AS (
  SELECT r.doc_id, r.a, r.b, string_agg(c.x, chr(10) ORDER BY c.i) AS k
  FROM runs r JOIN cum c ON c.doc_id = r.doc_id AND c.i BETWEEN r.a AND r.b GROUP BY ALL
), later AS (
  SELECT doc_id, b, row_number() OVER w > 1 AS again,
    CASE WHEN first_value(doc_id) OVER w = doc_id THEN greatest(a, first_value(b) OVER w + 1) ELSE a END AS a
  FROM keyed WINDOW w AS (PARTITION BY k ORDER BY doc_id, a)
), gone AS (
  SELECT DISTINCT c.doc_id, c.n FROM later l JOIN cum c ON c.doc_id = l.doc_id AND c.i BETWEEN l.a AND l.b WHERE l.again
), rest AS (
  SELECT b.doc_id, string_agg(b.line, chr(10) ORDER BY b.n) FILTER (WHERE g.n IS NULL) AS text,
    count(*) FILTER (WHERE x <> '') AS n_lines, count(g.n) AS n_removed
  FROM bare b LEFT JOIN gone g USING (doc_id, n) GROUP BY b.doc_id
)
SELECT doc_id, CASE WHEN n_removed = 0 THEN d.text WHEN n_removed = n_lines THEN '' ELSE rest.text END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN rest USING (doc_id)
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = label_table(table(spark, sf_dir, "labels"), "quality").where(~held_out(F.col("doc_id"), 5, 0))
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wrappers.main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op9_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg.stored_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    out = langid.label(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    out = whitening.by_component(
        whitening.apply(vectors, model), model, "vec_id", F.lit(model.n if model else 0).cast("long").alias("n"), F.col("deviation").try_cast("long").alias("deviation")
    )
    return out.withColumn("identity_error", F.lit(whitening.identity_error(vectors, model)).cast("double"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("licenses", lambda x: x["label"].isin(*[label for label, _ in licenses.BASE]))
    places = F.transform(base, lambda x: x["place"])

    def said(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")

    words = F.array_max(F.transform("licenses", lambda x: x["words"]))
    return out.select(
        "doc_id",
        F.col("license_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        said(base).alias("base_labels"),
        said(F.col("licenses")).alias("labels"),
        # grows with the verified words of the best template
        F.coalesce(words / (words + 2.0), F.lit(0.0)).alias("score"),
    )


_OP12_SQL = licenses.oracle()


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return out.select(
        "doc_id",
        F.col("fim_units").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        digest(F.col("fim_text")).alias("output_sha256"),
        digest(fim.restored(F.col("fim_text"), F.col("fim_form"))).alias("restored_sha256"),
    )


_OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), cut AS (
  SELECT *, list_transform(regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), lambda u: length(u)) AS units,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), placed AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT *, CAST(coalesce(list_sum(units[1:lo]), 0) AS BIGINT) AS a, CAST(coalesce(list_sum(units[1:hi]), 0) AS BIGINT) AS b FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


#: formatted_chars follows from the template: 4 + role + 1 code points before a reply, 11 + role + 1 before others, 4 or 12 behind.
_OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(role) + (length(role) - length(replace(role, '\', ''))) + 1
    + length(text) + (length(text) - length(replace(text, '\', '')))
    + 2 * len(regexp_extract_all(role || '|' || text, '</?s>|\[/?INST\]|<</?SYS>>'))
    + CASE WHEN role = 'assistant' THEN 3 + 4 ELSE 10 + 12 END AS chars
  FROM rows
), placed AS (
  SELECT *, sum(chars) OVER w AS upto,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS final
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR final) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_examples": op1_chat_examples,
        "op2_decontamination": op2_decontamination,
        "op3_toxicity": op3_toxicity,
        "op4_mix": op4_mix,
        "op5_line_dedup": op5_line_dedup,
        "op6_quality": op6_quality,
        "op7_ngram_join": op7_ngram_join,
        "op8_html_text": op8_html_text,
        "op9_mpeg_audio": op9_mpeg_audio,
        "op10_language": op10_language,
        "op11_whitening": op11_whitening,
        "op12_licenses": op12_licenses,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_examples": _OP1_SQL, "op2_decontamination": _OP2_SQL, "op5_line_dedup": _OP5_SQL, "op12_licenses": _OP12_SQL, "op13_fill_in_middle": _OP13_SQL}
