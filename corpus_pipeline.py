"""The corpus pipeline: drops toxic documents and near copies, decontaminates, redacts personal data and packs.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before has kept. All but the last return
the columns of `documents`, whatever further columns came in. Null and empty texts are documents like any other; of
repeated rows one stays, as of any group of copies. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.llm import decontamination, ngram_join, packing, personal_data, toxicity
from checkmart.llm.queries import tokenizer_path
from checkmart.llm.tables import documents, ship_package, text_key, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents_only(docs: DataFrame) -> DataFrame:
    """The columns of `documents`, found by their exact names."""
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return numbered.select(*(F.col(f"c{docs.columns.index(name)}").alias(name) for name in COLUMNS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the cut-off. Learns from the labelled rows outside the held-out fold."""
    labels = documents(spark, sf_dir, "labels").filter(toxicity.fold("doc_id", 3) != 1)
    docs = _documents_only(docs)
    model = toxicity.learn_toxicity(docs, labels)
    scored = toxicity.with_score(docs, model, F.col("text"), COLUMNS)
    return scored.filter(F.col("score") < toxicity.CUTOFF).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of copies and near copies. Documents without words are one group."""
    ship_package(spark)
    docs = _documents_only(docs)
    classes = ngram_join.jaccard_classes(docs)
    chosen = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_key")))
    chosen = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("text_key").alias("chosen_key")).distinct()
    rows = docs.withColumn("own_key", text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("own_key") == F.col("chosen_key"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "own_key"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no window of a benchmark item."""
    docs = _documents_only(docs)
    found = decontamination.contamination(docs, documents(spark, sf_dir, "benchmark")).filter("n_hit > 0")
    found = written(found.select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key")).distinct(), "hits")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (text_key(F.col("text")) == F.col("hit_key"))
    return docs.join(decontamination.small(found), same, "left_anti")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and n_chars counted anew where the text changed."""
    redacted = personal_data.redacted(_documents_only(docs))
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all documents, one row per piece."""
    ship_package(spark)
    return packing.packed(_documents_only(docs), tokenizer_path("word_bpe_49k.json"), frugal=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: The first stage is a learned model, which SQL cannot express; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
