"""Operator 6, token-id output: ORC files of token ids, sorted by document id.

Documents are dealt by ranges of ids and sorted; tasks encode them and write ORC: integers run-length encoded in stripes,
row indexes every `INDEX_STRIDE` rows and a Bloom filter on the document id. Ranges of files and stripes do not overlap, so
that a lookup by id skips all others by their statistics, and stripes are read in parallel. A row carries its range and its
first id's place there; the place in the whole corpus follows from the ranges' totals, which are read from the files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.llm import tokens
from checkmart.llm.tables import partitions

END_ID = 2
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1_000
_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = tokens.encoder(path, False, end_id).steps
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece, ids, ends in steps(batch["text"]):
                sizes = np.diff(ends, prepend=0)
                lists = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(piece.start, piece.stop - piece.start),
                        pa.array(np.full(len(sizes), part), pa.int32()),
                        pa.array(start + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        lists,
                    ],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> None:
    """Writes the token ids of every row as ORC, in ascending order of id, then text.

    `tokenizer` is a byte-level file that every executor can open. Null texts count as empty and have the end id only.
    Rows without id come first; repeated rows are written as often as they occur.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sorted_rows = rows.repartitionByRange(partitions(docs.sparkSession), "id").sortWithinPartitions("id", "text")
    (
        sorted_rows.mapInArrow(_encode(tokenizer, end_id), _SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", INDEX_STRIDE)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all rows before. Filters on doc_id reach the files."""
    files = spark.read.schema(_SCHEMA).orc(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row per range
    bases = np.cumsum([0, *(r["n"] for r in totals)])
    base = spark.createDataFrame([(r["part"], int(b)) for r, b in zip(totals, bases, strict=False)], "part int, base long")
    placed = files.join(F.broadcast(base), "part")
    return placed.select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def _checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["ids"]
        values = lists.values.to_numpy().astype("<u4")
        cuts = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        others = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[n] for n in others), pa.array(sums, pa.int64())], names=[*others, "ids_crc32"]
        )


def token_digests(rows: DataFrame) -> DataFrame:
    """The checksum of every row's ids, as little-endian unsigned 32-bit integers, in place of the ids."""
    kept = [f for f in rows.schema if f.name != "ids"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.select(*(f.name for f in kept), "ids").mapInArrow(_checksum, f"{fields}, ids_crc32 long")
