"""Operator 4, quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Every word has a sparse random index vector, drawn from its hash; the vector of a word is the sum of the index vectors of
its neighbours over the whole corpus. Words share `BUCKETS` vectors by hash; next to each word its shape (the kinds of
characters that follow each other) counts as a word of its own. A document is the mean and the spread of its words'
vectors and its length. A two-layer numpy network learns from a bounded sample of labelled documents
(`MAX_TRAINING_DOCS`); a temperature fitted on a part of the sample calibrates its probabilities.

Plan. One pass sums context vectors in tasks, which send `BUCKETS` x `DIMS` numbers each, summed as they stream in; a
second pass pools. The table of vectors is a few MB at any corpus size and is broadcast. Texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checkmart.llm.tables import partitions, written
from checkmart.llm.toxicity import sample_of
from checkmart.llm.words import SPACED, chunks, mixed, words_of

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
DIMS = 32
_RANGES = 32
MAX_TRAINING_DOCS = 20_000
HIDDEN = 32
EPOCHS = 60
CUTOFF = 0.7
N_FEATURES = 3 * DIMS + 1


def _character_kinds() -> np.ndarray:
    """Lower case and beyond ASCII, upper case, digits, and one kind per other byte."""
    kinds = np.arange(256)
    kinds[0x61:0x7B] = kinds[0x80:] = 1
    kinds[0x41:0x5B] = 2
    kinds[0x30:0x3A] = 3
    return kinds


_KINDS = _character_kinds()
_STEPS = mixed(np.arange(1, 257 * 256 + 1, dtype=np.uint64)).reshape(257, 256)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words and of their shapes, and the first word of each text (one more at the end)."""
    words = words_of(texts, SPACED)
    kinds = _KINDS[words.data]
    before = np.empty_like(kinds)
    before[0] = 256
    before[1:] = kinds[:-1]
    before[words.starts] = 256
    steps = np.where(before == kinds, np.uint64(0), _STEPS[before, kinds])
    sums = np.zeros(len(steps) + 1, np.uint64)
    np.cumsum(steps, out=sums[1:])
    shapes = mixed(sums[words.ends] - sums[words.starts])
    shift = np.uint64(64 - BUCKET_BITS)
    return (words.hashes >> shift).astype(np.int64), (shapes >> shift).astype(np.int64), words.firsts


def _index_vectors(buckets: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """Two non-zero places of each bucket's index vector, with their signs."""
    h = mixed(buckets.astype(np.uint64) + np.uint64(1 << 40))
    return tuple(
        (((h >> np.uint64(s)) % np.uint64(DIMS)).astype(np.int64), (((h >> np.uint64(s + 20)) & np.uint64(1)).astype(np.int64) * 2 - 1))
        for s in (0, 30)
    )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The context vectors summed over a task, in blocks of buckets."""
    total = np.zeros(BUCKETS * DIMS, np.int64)
    places, signs = zip(*_index_vectors(np.arange(BUCKETS)), strict=True)
    for batch in batches:
        texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
        for part in chunks(texts):
            words, shapes, firsts = tokens(texts[part])
            doc = np.repeat(np.arange(part.stop - part.start), np.diff(firsts))
            near = np.flatnonzero(doc[:-1] == doc[1:])
            for of in (words, shapes):
                for own, other in ((of[near], of[near + 1]), (of[near + 1], of[near])):
                    for place, sign in zip(places, signs, strict=True):
                        np.add.at(total, own * DIMS + place[other], sign[other])
    blocks = total.reshape(_RANGES, -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(_RANGES), pa.int32()), pa.array([b.astype("<i8").tobytes() for b in blocks], pa.binary())],
        names=["block", "sums"],
    )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, sums in zip(batch["block"].to_pylist(), batch["sums"], strict=True):
            values = np.frombuffer(sums.as_py(), "<i8")
            held[block] = held[block] + values if block in held else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([v.astype("<i8").tobytes() for v in held.values()], pa.binary())],
        names=["block", "sums"],
    )


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vectors of all buckets over the whole corpus, at unit length; `BUCKETS` x `DIMS` at any size."""
    summed = docs.select(F.col(text_col).alias("text")).mapInArrow(_contexts, "block int, sums binary")
    n = min(_RANGES, partitions(docs.sparkSession))
    found = summed.repartitionById(n, F.col("block") % n).mapInArrow(_add_up, "block int, sums binary").toArrow()
    table = np.zeros((_RANGES, BUCKETS * DIMS // _RANGES))
    for block, sums in zip(found["block"].to_pylist(), found["sums"].to_pylist(), strict=True):
        table[block] = np.frombuffer(sums, "<i8")
    table = table.reshape(BUCKETS, DIMS)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """One row of `N_FEATURES` per text; a text without words is all zero."""
    words, shapes, firsts = tokens(texts)
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    counts = np.diff(firsts)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    begins, n = firsts[some], counts[some][:, None]
    values = vectors[words]
    mean = np.add.reduceat(values, begins, axis=0) / n
    spread = np.add.reduceat(values * values, begins, axis=0) / n - mean * mean
    out[some, :DIMS] = mean
    out[some, DIMS : 2 * DIMS] = np.sqrt(np.maximum(spread, 0))
    out[some, 2 * DIMS : 3 * DIMS] = np.add.reduceat(vectors[shapes], begins, axis=0) / n
    out[some, -1] = np.log1p(counts[some])
    return out


def _pool(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch["__text"].cast(pa.binary()).to_pylist()]
            others = [n for n in batch.schema.names if n != "__text"]
            for part in chunks(texts, 1 << 19):
                rows = pooled(texts[part], vectors.value)
                packed = pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary())
                kept = [batch[n].slice(part.start, part.stop - part.start) for n in others]
                yield pa.RecordBatch.from_arrays([*kept, packed], names=[*others, "features"])

    return run


class Network:
    """features -> tanh(HIDDEN) -> probability, on standardised features, divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS):
        rng = np.random.default_rng(7)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.temperature = 1.0
        held = np.arange(len(y)) % 5 == 4  # for the temperature only
        p = [
            rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        self.p, m, v, step = p, [0.0] * 4, [0.0] * 4, 0
        xs, ys = (x[~held] - self.mean) / self.scale, y[~held]
        for _ in range(epochs):
            order = rng.permutation(len(ys))
            for a in range(0, len(order), 256):
                bx, by = xs[order[a : a + 256]], ys[order[a : a + 256]]
                hidden = np.tanh(bx @ p[0] + p[1])
                d = (1 / (1 + np.exp(-(hidden @ p[2] + p[3]))) - by) / len(by)
                back = np.outer(d, p[2]) * (1 - hidden**2)
                grads = [bx.T @ back + 1e-4 * p[0], back.sum(axis=0), hidden.T @ d + 1e-4 * p[2], d.sum(keepdims=True)]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] -= 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        if held.any():
            logits, target = self.logits(x[held]), y[held]
            choices = np.geomspace(0.25, 8, 61)
            losses = [np.mean(np.logaddexp(0, logits / t) - target * logits / t) for t in choices]
            self.temperature = float(choices[int(np.argmin(losses))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


def _apply(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch["features"].to_pylist()), "<f4").reshape(-1, N_FEATURES)
            score = model.value.probabilities(x) if model.value else np.full(len(x), 0.5)
            others = [n for n in batch.schema.names if n != "features"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in others), pa.array(score, pa.float64())], names=[*others, "score"]
            )

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most: int = MAX_TRAINING_DOCS,
) -> DataFrame:
    """(doc_id, score) for every row; `labels` holds the rows to learn from.

    Null and empty texts are pooled as zeros and scored like any other. Rows without id or label teach nothing, nor do ids
    with different labels; of rows that share an id the smallest features are learned, once. Without any labelled row
    every score is 0.5.
    """
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs, text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    pooled_rows = written(rows.mapInArrow(_pool(vectors), f"doc_id {id_type}, features binary"), "pooled")
    chosen = F.broadcast(sample_of(labels, id_col, label_col, most))
    joined = pooled_rows.join(chosen, pooled_rows["doc_id"] == chosen["id"])
    sample = joined.groupBy("id").agg(F.min("label").alias("label"), F.min("features").alias("features")).toArrow()
    model = None
    if sample.num_rows:
        sample = sample.sort_by([("id", "ascending"), ("features", "ascending")])
        x = np.frombuffer(b"".join(sample["features"].to_pylist()), "<f4").reshape(-1, N_FEATURES)
        order = np.random.default_rng(3).permutation(len(x))
        model = Network(x[order].astype(np.float64), sample["label"].to_numpy().astype(np.float64)[order])
    return pooled_rows.mapInArrow(_apply(context.broadcast(model)), f"doc_id {id_type}, score double")
