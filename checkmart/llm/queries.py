"""The operators of this subpackage as queries over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.llm import (
    collocations,
    decontamination,
    fingerprints,
    hard_negatives,
    ngram_join,
    packing,
    personal_data,
    quality,
    secrets,
    simhash_trie,
    substring_dedup,
    token_files,
    toxicity,
)
from checkmart.llm.tables import documents
from checkmart.session import scratch_path


def _joined(spans: Column) -> Column:
    """kind:start:end, joined by commas in the given order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.fingerprints(documents(spark, sf_dir))
    lanes = {c: fingerprints.signed_lanes(F.col(c)).alias(f"{c}_lanes") for c in ("packed", "edited_packed", "next_packed")}
    rows = rows.select("*", *lanes.values())
    near = {
        c: fingerprints.likeness(F.col("packed_lanes"), F.col(f"{c}_lanes"), F.col("packed") == F.col(c))
        for c in ("edited_packed", "next_packed")
    }
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.text_of(F.col("packed")).alias("fingerprint"),
        fingerprints.text_of(F.col("edited_packed")).alias("edited_fingerprint"),
        near["edited_packed"].alias("near_edited"),
        near["next_packed"].alias("near_next"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(documents(spark, sf_dir)).drop("text_key", "class_key")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.fold("doc_id", 4) == 2
    labels = documents(spark, sf_dir, "labels").filter(~held_out)
    scored = quality.quality_scores(documents(spark, sf_dir), labels)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.CUTOFF).cast("int").alias("predicted")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.fold("doc_id", 3) == 1
    docs = documents(spark, sf_dir)
    model = toxicity.learn_toxicity(docs, documents(spark, sf_dir, "labels").filter(~held_out))
    scored = toxicity.with_score(docs, model, F.col("text"), ["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.CUTOFF).cast("int").alias("predicted")
    )


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(personal_data.KINDS))
    return found.select(
        "doc_id",
        *(_count(kind) for kind in personal_data.KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(documents(spark, sf_dir), path, tokenizer_path("byte_bpe_50k.json"))
    return token_files.token_digests(token_files.read_tokens(spark, path))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), with_ids=False).drop("ids")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per kind and a digest of the base spans, and all spans, of every whole text."""
    found = secrets.secret_spans(documents(spark, sf_dir))
    kinds = [rule.kind for rule in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *(_count(kind) for kind in kinds),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language, from all texts."""
    return collocations.collocations(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor; each seventh row counts with the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(documents(spark, sf_dir, "embeddings"), label)


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the component of every document."""
    return simhash_trie.near_duplicates(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_personal_data": op5_personal_data,
    "op6_token_id_output": op6_token_id_output,
    "op7_packing": op7_packing,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_secret_scans": op10_secret_scans,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}
