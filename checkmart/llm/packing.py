"""Operator 7, packing: hierarchical multi-length packing of token sequences.

A document gives full windows of the longest tier and one rest. The rest goes to the tier of the smallest context that
holds it. Tiers are packed from the longest down: each rest opens a window of its tier, and the gap is filled with the
largest rests of shorter tiers that fit; where none fits, one is cut. Windows of the shortest tier are filled in a row.
What is left when nothing can fill a gap any more goes, cut freely, into windows of the longest tier, of which the last
one may stay short. Sequences are dealt to step groups so that every group has the same mix of tiers.

Tasks pack blocks of `BLOCK_TOKENS` ids; documents are not shuffled, and a block leaves one short window at most.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checkmart.llm import tokens
from checkmart.llm.words import giving_back

TIERS = (256, 512, 1024, 2048)
END_ID = 1
BLOCK_TOKENS = 1 << 22
#: With `frugal`: ids of a block, rows of a batch out and in, and distinct chunks remembered by a task.
FRUGAL_BLOCK, FRUGAL_ROWS, FRUGAL_KEPT = 1 << 20, 256, 1 << 15
#: Ids in a step group, about.
STEP_TOKENS = 1 << 18


class Piece(NamedTuple):
    """A run of ids of a document of the block. Pieces sort by length."""

    length: int
    doc: int
    start: int


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """(tier, pieces) of every sequence of a block of documents."""
    longest = tiers[-1]
    sequences: list[tuple[int, list[Piece]]] = []
    pools: dict[int, list[Piece]] = {t: [] for t in tiers}

    def tier_of(length: int) -> int:
        return next(t for t in tiers if length <= t)

    for doc, n in enumerate(lengths):
        full = n // longest
        sequences += [(longest, [Piece(longest, doc, k * longest)]) for k in range(full)]
        if rest := n - full * longest:
            pools[tier_of(rest)].append(Piece(rest, doc, full * longest))
    for pool in pools.values():
        pool.sort()
    left: list[Piece] = []
    for k in range(len(tiers) - 1, 0, -1):
        own, shorter = pools[tiers[k]], tiers[:k]
        while own:
            window = [own.pop()]
            gap = tiers[k] - window[0].length
            while gap and (piece := _filling(pools, shorter, gap)):
                if piece.length > gap:  # cut
                    rest = Piece(piece.length - gap, piece.doc, piece.start + gap)
                    insort(pools[tier_of(rest.length)], rest)
                    piece = Piece(gap, piece.doc, piece.start)
                window.append(piece)
                gap -= piece.length
            if gap:
                left += window
            else:
                sequences.append((tiers[k], window))
    full, rest = _in_a_row(pools[tiers[0]], tiers[0])
    sequences += [(tiers[0], w) for w in full]
    full, rest = _in_a_row(left + rest, longest)
    return sequences + [(longest, w) for w in full] + ([(longest, rest)] if rest else [])


def _filling(pools: dict[int, list[Piece]], shorter: tuple[int, ...], gap: int) -> Piece | None:
    """The largest piece up to the gap, or else the smallest one, to be cut."""
    for tier in reversed(shorter):
        if at := bisect_right(pools[tier], (gap, 1 << 62, 1 << 62)):
            return pools[tier].pop(at - 1)
    for tier in shorter:
        if pools[tier]:
            return pools[tier].pop(0)
    return None


def _in_a_row(pieces: list[Piece], size: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of the pieces one after the other, cut at window ends, and the pieces of the last, short window."""
    windows, window, gap = [], [], size
    for piece in pieces:
        while piece.length:
            head = min(gap, piece.length)
            window.append(Piece(head, piece.doc, piece.start))
            piece = Piece(piece.length - head, piece.doc, piece.start + head)
            gap -= head
            if not gap:
                windows.append(window)
                window, gap = [], size
    return windows, window


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "ids"]
_FIELDS = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long,"
    " ids array<int>"
)


def _packed_block(doc_ids: list, ids: np.ndarray, ends: np.ndarray, tiers: tuple[int, ...], base: int, with_ids: bool):
    begins = np.concatenate([[0], ends[:-1]])
    lengths = (ends - begins).tolist()
    sequences = pack(lengths, tiers)
    groups = max(1, round(len(ids) / STEP_TOKENS))
    order = sorted(range(len(sequences)), key=lambda k: (-sequences[k][0], len(sequences[k][1]), k))
    group = {k: i % groups for i, k in enumerate(order)}
    columns: list[list] = [[] for _ in _NAMES]
    for number, (tier, window) in enumerate(sequences):
        offset = 0
        for piece in window:
            at = int(begins[piece.doc]) + piece.start
            run = ids[at : at + piece.length]
            row = (
                doc_ids[piece.doc],
                piece.start,
                piece.length,
                zlib.crc32(run.astype("<u4").tobytes()),
                lengths[piece.doc],
                base + number,
                offset,
                tier,
                base + group[number],
                run if with_ids else None,
            )
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += piece.length
    return columns, len(sequences)


def _pack_rows(path: str, end_id: int, tiers: tuple[int, ...], id_type: pa.DataType, with_ids: bool, frugal: bool):
    kinds = [id_type, *[pa.int64()] * 6, pa.int32(), pa.int64(), pa.list_(pa.int32())]

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, True, end_id)
        # a frugal task has its own encoder, which goes with it
        steps = (tokens.Encoder(*key, FRUGAL_KEPT) if frugal else tokens.encoder(*key)).steps
        block, rows_out = (FRUGAL_BLOCK, FRUGAL_ROWS) if frugal else (BLOCK_TOKENS, 10_000)
        done = TaskContext.get().partitionId() << 36
        held_docs: list = []
        held_ids: list[np.ndarray] = []
        held_ends: list[np.ndarray] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, total
            if held_docs:
                columns, n = _packed_block(
                    held_docs, np.concatenate(held_ids), np.concatenate(held_ends), tiers, done, with_ids
                )
                done += n
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield from pa.Table.from_arrays(arrays, names=_NAMES).to_batches(max_chunksize=rows_out)
            held_docs.clear()
            held_ids.clear()
            held_ends.clear()
            total = 0

        step = FRUGAL_ROWS if frugal else 10_000
        for batch in (whole.slice(i, step) for whole in batches for i in range(0, whole.num_rows, step)):
            docs = batch["doc_id"].to_pylist()
            for part, ids, ends in steps(batch["text"].fill_null("")):
                held_docs += docs[part]
                held_ids.append(ids.astype(np.uint16 if ids.max(initial=0) < 1 << 16 else np.int32))
                held_ends.append(ends + total)
                total += int(ends[-1])
                if total >= block:
                    yield from flush()
        yield from flush()

    return run


def packed(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    tiers: tuple[int, ...] = TIERS,
    with_ids: bool = True,
    frugal: bool = False,
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, ids).

    `tokenizer` is a lower-casing word file that every executor can open. Null texts count as empty and consist of the end
    id. Rows without id and repeated rows are documents of their own. Without `with_ids` the ids are null.
    `frugal` takes smaller blocks and remembers less, for jobs whose workers hold other things too; sequences then differ.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _pack_rows(tokenizer, end_id, tuple(sorted(tiers)), pa.int64(), with_ids, frugal), f"doc_id long, {_FIELDS}"
    )
