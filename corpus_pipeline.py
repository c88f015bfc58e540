"""The corpus pipeline: documents through five of the training-data operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.llm import decontam, linededup, ngramjoin, toxicity
from cliploom.llm.common import label_table, staged, table
from cliploom.llm.queries import mixed

#: A document with this score or more is rejected as toxic.
TOXIC = 0.7


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the tagger, fitted on all labelled rows, scores as toxic.

    Null and empty texts have no toxic word and stay (unless the labels mark nothing but toxic documents); repeated ids and
    rows are scored each; a very long text is scored whole; an empty table, or one without labels, stays as it is; all
    columns pass through, whatever their names.
    """
    labels = label_table(table(spark, sf_dir, "labels"), "toxic")
    # fitted on the unfiltered table: the first stage's input need not hold the labelled documents
    model = toxicity.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    out = toxicity.score(docs, model)
    return out.where(F.col(out.columns[-2]) < TOXIC).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later copies of line runs; a document that consists of them goes. n_chars follows the text where it changed.

    Null and empty texts stay; rows equal in id and text are one document, rows that share an id alone are not; a null id
    comes before all others, so its copy is the first; a very long text is one sequence; an empty table stays empty; all
    columns pass through.
    """
    out = linededup.remove_repeats(docs)
    lines, gone = (F.col(c) for c in out.columns[-2:])
    out = out.where((gone == 0) | (gone < lines))
    size = F.when(gone > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size).select(*docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked ones, that with the smallest id; unlinked ones stay.

    Null texts and texts without a word are linked with nothing and stay; a null id is the smallest; rows that share an id
    stay or go together; a very long text is one set; an empty table stays empty; all columns pass through.
    """
    linked = ngramjoin.components(docs.select("doc_id", "text"))
    gone = staged(linked.where("not (doc_id <=> component_id)").select(F.col("doc_id").alias("_gone")).distinct(), "dropped")
    few = gone.limit(ngramjoin.BROADCAST_IDS + 1).count() <= ngramjoin.BROADCAST_IDS
    gone = F.broadcast(gone) if few else gone
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that overlap with a benchmark item.

    Null and empty texts overlap with nothing and stay; rows that share an id, null ones too, stay or go together; a very long
    text is searched whole; with an empty benchmark all stay; an empty table stays empty; all columns pass through.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document that is left: doc_id, size, source_size, target, taken.

    Null and empty texts have size 0 and take nothing; a null source is one of its own, the last; repeated ids and rows are
    documents of their own; a very long text is a size like others; an empty table gives no rows; other columns go.
    """
    return mixed(docs.select("doc_id", "text", "source"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The toxicity model is trained, which SQL cannot express; tests/llm hold every stage against planted cases, and run()
#: against a plain second implementation of all stages.
ORACLE_SQL = None
