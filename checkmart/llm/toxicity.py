"""Operator 9, toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, of word beginnings (inflected forms share them), of word pairs and of pairs around one
skipped word, hashed to 2**`BITS` coordinates. One
task learns from a bounded sample of labelled documents (`MAX_TRAINING_DOCS`, the smallest hashes of their ids); per-
coordinate rates and L1 leave few weights, which are sent to all tasks and score every document in one pass, without a
shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checkmart.llm.words import ALPHANUMERIC, beginnings, chunks, giving_back, mixed, words_of

BITS = 20
#: Bytes of a word's beginning that count as features of their own.
BEGINNINGS = (4, 5)
MAX_TRAINING_DOCS = 16_384
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 8.0, 1.0
CUTOFF = 0.7


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all texts in a row, with repeats, and the text of each."""
    words = words_of(texts, ALPHANUMERIC, fold_case=True)
    h = words.hashes
    doc = np.repeat(np.arange(len(texts)), words.counts())
    pairs = mixed(h[:-1] * np.uint64(3) + h[1:])[doc[:-1] == doc[1:]]
    skips = mixed(h[:-2] * np.uint64(5) + h[2:])[doc[:-2] == doc[2:]]
    begun = [beginnings(words, size, fold_case=True) for size in BEGINNINGS]
    coordinates = np.concatenate([h, *begun, pairs, skips]) >> np.uint64(64 - bits)
    alone = [doc] * (1 + len(begun))
    owners = np.concatenate([*alone, doc[:-1][doc[:-1] == doc[1:]], doc[:-2][doc[:-2] == doc[2:]]])
    return coordinates.astype(np.int32), owners


def fit_ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias from (distinct coordinates, label) rows, one online update per row and epoch."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = 0.0
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, label = rows[k]
            zs, ns = z[at], n[at]
            w = _weights(zs, ns)
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[at] = zs + g - sigma * w
            n[at] = ns + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
    return _weights(z, n), float(-bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _learn(bits: int):
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
            ids, labels = batch["id"].to_pylist(), batch["label"].to_pylist()
            for part in chunks(texts):
                at, owner = features(texts[part], bits)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(part.stop - part.start + 1))
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    rows.append((ids[part.start + i], labels[part.start + i], np.unique(at[order[a:b]])))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        weights, bias = fit_ftrl([(at, label) for _, label, at in rows], bits)
        kept = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *kept], pa.int32()), pa.array([bias, *weights[kept]], pa.float64())], names=["at", "weight"]
        )

    return run


def sample_of(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """At most `most` labelled ids, as (id, label): those of the smallest hash, so the choice does not depend on order.

    An id with different labels teaches nothing.
    """
    rows = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    agreed = rows.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other")
    return agreed.select("id", "label").orderBy(F.xxhash64("id"), "id").limit(most)


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    bits: int = BITS,
    most: int = MAX_TRAINING_DOCS,
) -> tuple[np.ndarray, float]:
    """Weights and bias from at most `most` labelled documents. Rows without id or label are left out.

    Of rows that share an id the smallest text is learned, once; an id with different labels is left out. Without any
    labelled row all weights are 0 and every score is 0.5.
    """
    chosen = F.broadcast(sample_of(labels, id_col, label_col, most))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(chosen, "id")
    rows = rows.groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("label").alias("label"))
    found = rows.repartition(1).mapInArrow(_learn(bits), "at int, weight double").toArrow()
    weights, bias = np.zeros(1 << bits, np.float32), 0.0
    at, values = found["at"].to_numpy(), found["weight"].to_numpy()
    weights[at[at >= 0]] = values[at >= 0]
    return weights, float(values[at < 0].sum())


def _score(bits: int, model):
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = model.value
        weights = np.zeros(1 << bits, np.float32)
        weights[at] = values
        for batch in batches:
            texts = [t or b"" for t in batch["__text"].cast(pa.binary()).to_pylist()]
            out = np.full(len(texts), bias, np.float64)
            for part in chunks(texts):
                coordinates, owner = features(texts[part], bits)
                hit = np.flatnonzero(weights[coordinates])
                pairs = np.unique(owner[hit].astype(np.int64) << bits | coordinates[hit])
                own, w = pairs >> bits, weights[pairs & ((1 << bits) - 1)]
                out[part] += np.bincount(own, weights=w, minlength=part.stop - part.start)
            score = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            others = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in others), pa.array(score)], names=[*others, "score"])

    return run


def with_score(
    docs: DataFrame, model: tuple[np.ndarray, float], text: Column, keep: list[str], bits: int = BITS
) -> DataFrame:
    """The columns `keep` and `score`, for every row. Null and empty texts get the score of the bias."""
    weights, bias = model
    at = np.flatnonzero(weights).astype(np.int32)
    sent = docs.sparkSession.sparkContext.broadcast((at, weights[at], bias))
    rows = docs.select(*keep, text.alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(_score(bits, sent), f"{fields}, score double")


def fold(id_col: str, parts: int) -> Column:
    """The part of a row: crc32 of its id as text; 0 without id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts, F.lit(0))
