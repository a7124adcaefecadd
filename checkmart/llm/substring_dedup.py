"""Operator 1, substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

Every window of `width` consecutive words of every text is hashed. A window is removed where its words also start in a
document with a smaller doc_id, and removed windows merge into maximal intervals of words.

Plan. Tasks hash the windows of a chunk of texts; of windows that repeat inside the chunk only those of its smallest
doc_id go on, so a passage in a third of all documents reaches a reducer once per chunk. Windows travel in blocks, one per
chunk and hash range, to the task of their hash range, which compares doc_ids. Removed positions travel back, grouped by
document, and become intervals: one row per touched document.

Hashes have 64 bits: among n windows about n * n / 2**65 pairs of different windows are taken for equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checkmart.llm.tables import partitions, text_key
from checkmart.llm.words import chunks, from_planar, mixed, planar, windows, words_of

WIDTH = 50
_BLOCK = pa.schema(
    [
        ("bucket", pa.int32()),
        ("removed", pa.bool_()),
        ("docs", pa.binary()),
        ("counts", pa.binary()),
        ("positions", pa.binary()),
        ("hashes", pa.binary()),
    ]
)
_BLOCK_DDL = "bucket int, removed boolean, docs binary, counts binary, positions binary, hashes binary"
_INTERVALS = pa.schema(
    [("id", pa.int64()), ("text_key", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]
)
_INTERVALS_DDL = "id long, text_key long, starts array<int>, ends array<int>"


def _segments(keys: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal values."""
    if not len(keys):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _block(bucket: int, removed: bool, table: np.ndarray, doc: np.ndarray, at: np.ndarray, hashes: bytes) -> dict:
    """One block; `table` has (id, text_key) by document number, `doc` is ascending."""
    cuts = _segments(doc)
    return {
        "bucket": bucket,
        "removed": removed,
        "docs": table[doc[[a for a, _ in cuts]]].tobytes(),
        "counts": np.array([b - a for a, b in cuts], "<i4").tobytes(),
        "positions": planar(at),
        "hashes": hashes,
    }


def _spread(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _group(ids: np.ndarray, buckets: int) -> np.ndarray:
    """Documents are gathered by a hash of their id."""
    return _spread(mixed(ids.astype(np.uint64)), buckets)


def _least_id(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each entry the smallest id among the entries of its hash."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    begins = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    least = np.empty(len(ids), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], begins), np.diff([*begins, len(ids)]))
    return least


def _removed_blocks(table: np.ndarray, doc: np.ndarray, at: np.ndarray, buckets: int) -> list[dict]:
    """Removed positions, one block per group of documents. `doc` counts the rows of `table`, ascending."""
    group = _group(table[doc, 0], buckets)
    order = np.argsort(group, kind="stable")
    group, doc, at = group[order], doc[order], at[order]
    return [_block(int(group[a]), True, table, doc[a:b], at[a:b], b"") for a, b in _segments(group)]


def _chunk_blocks(texts: list[bytes], table: np.ndarray, buckets: int, width: int) -> list[dict]:
    words = words_of(texts)
    hashes, first = windows(words.hashes, words.firsts, width)
    if not len(hashes):
        return []
    doc = np.searchsorted(words.firsts, first, side="right") - 1
    at = first - words.firsts[doc]
    ids = table[doc, 0]
    later = ids > _least_id(hashes, ids)
    out = _removed_blocks(table, doc[later], at[later], buckets)
    hashes, doc, at = hashes[~later], doc[~later], at[~later]
    bucket = _spread(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, hashes, doc, at = bucket[order], hashes[order], doc[order], at[order]
    for a, b in _segments(bucket):
        out.append(_block(int(bucket[a]), False, table, doc[a:b], at[a:b], hashes[a:b].tobytes()))
    return out


def _hash_windows(buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            table = np.stack([batch["id"].to_numpy(), batch["text_key"].to_numpy()], axis=1)
            for part in chunks(texts):
                if rows := _chunk_blocks(texts[part], table[part], buckets, width):
                    yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK)

    return run


def _entries(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, text_key), position and hash of every entry of some blocks."""
    docs, at, hashes = [np.empty((0, 2), np.int64)], [np.empty(0, np.uint32)], [np.empty(0, np.uint64)]
    for batch in batches:
        for row in batch.to_pylist():
            table = np.frombuffer(row["docs"], "<i8").reshape(-1, 2)
            docs.append(np.repeat(table, np.frombuffer(row["counts"], "<i4"), axis=0))
            at.append(from_planar(row["positions"]))
            hashes.append(np.frombuffer(row["hashes"], "<u8"))
    return np.concatenate(docs), np.concatenate(at), np.concatenate(hashes)


def _compare(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of one hash range that also start in a document with a smaller id."""
        held = []
        for batch in batches:
            if (passed := batch.filter(batch["removed"])).num_rows:
                yield passed
            held.append(batch.filter(pc.invert(batch["removed"])))
        docs, at, hashes = _entries(held)
        del held
        if len(docs):
            gone = docs[:, 0] > _least_id(hashes, docs[:, 0])
            docs, at = docs[gone], at[gone]
            order = np.lexsort((at, docs[:, 1], docs[:, 0]))
            docs, at = docs[order], at[order]
            fresh = np.ones(len(docs), bool)
            fresh[1:] = (docs[1:] != docs[:-1]).any(axis=1)
            if rows := _removed_blocks(docs[fresh], np.cumsum(fresh) - 1, at, buckets):
                yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK)

    return run


def _merge(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The removed windows of a group of documents as maximal intervals of words, one row per document."""
        docs, at, _ = _entries(list(batches))
        if not len(docs):
            return
        order = np.lexsort((at, docs[:, 1], docs[:, 0]))
        docs, at = docs[order], at[order].astype(np.int64)
        new_doc = np.ones(len(docs), bool)
        new_doc[1:] = (docs[1:] != docs[:-1]).any(axis=1)
        opens = new_doc.copy()
        opens[1:] |= at[1:] > at[:-1] + width
        first = np.flatnonzero(opens)
        ends = at[np.concatenate([first[1:] - 1, [len(at) - 1]])] + width
        offsets = np.searchsorted(first, [*np.flatnonzero(new_doc), len(at)])
        lists = [
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int32())) for v in (at[first], ends)
        ]
        yield from pa.Table.from_arrays(
            [pa.array(docs[new_doc, 0]), pa.array(docs[new_doc, 1]), *lists], schema=_INTERVALS
        ).to_batches(max_chunksize=4096)

    return run


def removal_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The word intervals to remove, one row (id, text_key, starts, ends) per document that has any.

    A row without id is neither smaller nor larger than another: it loses nothing and causes no loss. A null or short
    text has no window. Rows that share an id keep each other's words.
    """
    n = partitions(docs.sparkSession)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("text_key"), text.alias("text"))
    rows = rows.filter("id IS NOT NULL AND text IS NOT NULL")
    blocks = rows.mapInArrow(_hash_windows(n, width), _BLOCK_DDL).repartitionById(n, "bucket")
    removed = blocks.mapInArrow(_compare(n), _BLOCK_DDL).repartitionById(n, "bucket")
    return removed.mapInArrow(_merge(width), _INTERVALS_DDL)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "n_removed", "kept"]
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for text, starts, ends in zip(
            batch["__text"].cast(pa.binary()), batch["__starts"], batch["__ends"], strict=True
        ):
            words = (text.as_py() or b"").split()
            left = words
            if (cuts := starts.as_py()) is not None:
                left, done = [], 0
                for a, b in zip(cuts, ends.as_py(), strict=True):
                    left += words[done:a]
                    done = b
                left += words[done:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
        others = [c for c in batch.schema.names if not c.startswith("__")]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), *columns], names=[*others, *names])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Every row as (id, n_words, n_removed, kept): the kept words joined by one space.

    A null text counts as empty. Other columns of the input are not read, so their names cannot clash.
    """
    cuts = removal_intervals(docs, id_col, text_col, width)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("__text"), text_key(text).alias("key"))
    joined = rows.join(cuts, (F.col("doc_id") == cuts["id"]) & (F.col("key") == cuts["text_key"]), "left")
    joined = joined.select("doc_id", "__text", F.col("starts").alias("__starts"), F.col("ends").alias("__ends"))
    id_type = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"doc_id {id_type}, n_words long, n_removed long, kept string")
