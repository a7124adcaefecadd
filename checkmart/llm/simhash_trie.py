"""Operator 13, SimHash near-duplicates: a self-join of the binary trie of fingerprints.

A text is lower-cased (A-Z) and split into words `[^\\x20\\x09-\\x0D]+`. Its features are the XXH64 (seed 42) of its shingles of three
words, repeats included; a shorter text has one feature, all its words. A bit of the fingerprint is one if it is set in more
than half of the features. Fingerprints link at `BUDGET` or fewer differing bits; components are those of all links.

Plan. Equal fingerprints collapse to one. Pairs of trie nodes are traversed together from the root, adding up the differing
bits of their paths and dropping a pair beyond the budget. The upper part is a Spark table of node pairs with their sizes: a
pair of more than `PAIR_SIZE` fingerprints descends by four bits, a smaller one becomes a task that goes down to the leaves,
so a dense corner of the trie is cut as far as it needs. Tasks return a spanning forest of their links, which loses no
component, and the forests are joined by alternating star steps on written tables.

Nulls: a null or empty text, or one without words, has the fingerprint zero and is linked like any other. Rows that share a
doc_id are rows like others; a null doc_id gets a component, but is the smallest of none unless all are null. An empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checkmart.llm.tables import components, written

WIDTH = 3
SEED = 42
BITS = 64
BUDGET = 2
#: Fingerprints of the two nodes of a task, together.
PAIR_SIZE = 1 << 15
#: Bits by which a large node pair descends at once.
STEP = 4
#: Node pairs held at once by a task's traversal, and shingles summed at once.
_FRONTIER = 1 << 17
_SLAB = 1 << 16
#: Node pairs of at most this many fingerprint pairs are compared directly.
_LEAF_PAIRS = 8


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint of a text; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    begins = [0]
    for word in words:
        begins.append(begins[-1] + len(word) + 1)
    count = max(1, len(words) - width + 1)
    ends = begins[min(width, len(words)) :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, count, _SLAB):
        some = slice(i, min(i + _SLAB, count))
        hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in zip(begins[some], ends[some], strict=True)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch["text"]], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(values)], names=["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): the fingerprint of every row, as a signed 64-bit number with the same bits."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(_fingerprints, f"doc_id {kind}, print long")


def _split(zeros: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    # rows of a node are sorted, so those with a zero bit come first
    return lo + zeros[hi] - zeros[lo]


def _unite(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Joins the trees of linked rows; every row points at the smallest row of its tree afterwards."""
    while True:
        x, y = parent[x], parent[y]
        apart = x != y
        if not apart.any():
            return
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent[:] = above


def linked(a: np.ndarray, b: np.ndarray | None, depth: int, diff: int, budget: int = BUDGET) -> np.ndarray:
    """The tree of every row of two nodes (or one) of sorted, distinct fingerprints: the smallest row linked to it.

    Nodes share their depth, and their paths differ by `diff` bits. Rows of `b` are numbered after those of `a`.
    """
    other = a if b is None else b
    shift = 0 if b is None else len(a)
    parent = np.arange(len(a) + (0 if b is None else len(b)))
    zeros = {}

    def counted(level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in zeros:
            bit = np.uint64(BITS - 1 - level)
            zeros[level] = tuple(
                np.concatenate([[0], np.cumsum(1 - (side >> bit & np.uint64(1)).astype(np.int64))]) for side in (a, other)
            )
        return zeros[level]

    first = [np.array([v]) for v in (0, len(a), 0, len(other), diff)]
    stack = [(depth, first)]
    while stack:
        level, (alo, ahi, blo, bhi, apart) = stack.pop()
        small = (ahi - alo) * (bhi - blo) <= _LEAF_PAIRS
        if level == BITS:
            small[:] = True
        if small.any():
            _compare(parent, a, other, shift, b is None, *(v[small] for v in (alo, ahi, blo, bhi)), budget)
            alo, ahi, blo, bhi, apart = (v[~small] for v in (alo, ahi, blo, bhi, apart))
        if not len(alo):
            continue
        of_a, of_b = counted(level)
        amid, bmid = _split(of_a, alo, ahi), _split(of_b, blo, bhi)
        same = (alo == blo) & (b is None)
        children = [
            (alo, amid, blo, bmid, apart, None),
            (amid, ahi, bmid, bhi, apart, None),
            (alo, amid, bmid, bhi, apart + 1, None),
            # of a node paired with itself, the two mixed pairs are one
            (amid, ahi, blo, bmid, apart + 1, ~same),
        ]
        kept: list[list[np.ndarray]] = []
        for lo, mid, lo2, mid2, d, wanted in children:
            alive = (mid > lo) & (mid2 > lo2) & (d <= budget)
            if wanted is not None:
                alive &= wanted
            kept.append([v[alive] for v in (lo, mid, lo2, mid2, d)])
        merged = [np.concatenate(v) for v in zip(*kept, strict=True)]
        for i in range(0, len(merged[0]), _FRONTIER):
            stack.append((level + 1, [v[i : i + _FRONTIER] for v in merged]))
    return parent


def _compare(parent, a, other, shift, alone, alo, ahi, blo, bhi, budget: int) -> None:
    """Compares all rows of small node pairs: pair `k` of each is row k // width with row k % width."""
    width = bhi - blo
    sizes = (ahi - alo) * width
    pair = np.repeat(np.arange(len(sizes)), sizes)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x, y = alo[pair] + k // width[pair], blo[pair] + k % width[pair]
    if alone:
        x, y = x[x < y], y[x < y]
    near = np.bitwise_count(a[x] ^ other[y]) <= budget
    _unite(parent, x[near], y[near] + shift)


def _forest(budget: int) -> Callable:
    def forest(table: pa.Table) -> pa.Table:
        prints = table["print"].to_numpy().view(np.uint64)
        left = table["left_side"].to_numpy(zero_copy_only=False)
        a = np.sort(prints[left])
        b = None if left.all() else np.sort(prints[~left])
        depth, diff = table["depth"][0].as_py(), table["diff"][0].as_py()
        rows = a if b is None else np.concatenate([a, b])
        parent = linked(a, b, depth, diff, budget)
        joined = np.flatnonzero(parent != np.arange(len(parent)))
        return pa.table({"a": rows[joined].view(np.int64), "b": rows[parent[joined]].view(np.int64)})

    return forest


def _node(value: Column, depth: int) -> Column:
    """The first `depth` bits of a fingerprint. The root has none."""
    return F.shiftrightunsigned(value, BITS - depth) if depth else F.lit(0).cast("long")


def _pairs(prints: DataFrame, total: int, pair_size: int, budget: int) -> DataFrame:
    """Node pairs that are small enough for a task and may hold links: (pair, depth, a, b, diff)."""
    spark = prints.sparkSession
    frontier = spark.createDataFrame([(0, 0, 0, total, total)], "a long, b long, diff int, n_a long, n_b long")
    ready, depth = [], 0
    while True:
        size = F.when(F.col("a") == F.col("b"), F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b"))
        small = (size <= pair_size) | F.lit(depth == BITS)
        ready.append(frontier.filter(small).select(F.lit(depth).alias("depth"), "a", "b", "diff"))
        frontier = frontier.filter(~small)
        if depth == BITS or frontier.isEmpty():
            break
        depth += STEP
        nodes = prints.groupBy(_node(F.col("print"), depth).alias("node")).agg(F.count("*").alias("n"))
        nodes = nodes.withColumn("parent", F.shiftrightunsigned("node", STEP))
        left = nodes.select(F.col("parent").alias("a"), F.col("node").alias("child_a"), F.col("n").alias("m_a"))
        right = nodes.select(F.col("parent").alias("b"), F.col("node").alias("child_b"), F.col("n").alias("m_b"))
        apart = F.col("diff") + F.bit_count(F.col("child_a").bitwiseXOR(F.col("child_b")).bitwiseAND(F.lit((1 << STEP) - 1)))
        once = (F.col("a") != F.col("b")) | (F.col("child_a") <= F.col("child_b"))
        children = frontier.drop("n_a", "n_b").join(left, "a").join(right, "b").withColumn("apart", apart).filter(once & (F.col("apart") <= budget))
        frontier = written(
            children.select(F.col("child_a").alias("a"), F.col("child_b").alias("b"), F.col("apart").cast("int").alias("diff"), F.col("m_a").alias("n_a"), F.col("m_b").alias("n_b")),
            "node-pairs",
        )
    pairs = ready[0]
    for more in ready[1:]:
        pairs = pairs.union(more)
    return pairs


def print_components(prints: DataFrame, budget: int = BUDGET, pair_size: int = PAIR_SIZE) -> DataFrame:
    """(node, component) of the distinct fingerprints in the stored column `print`; one without a link is left out."""
    total = prints.count()
    pairs = _pairs(prints, total, pair_size, budget)
    depths = sorted(row[0] for row in pairs.select("depth").distinct().collect())
    sides = pairs.select(
        "depth", "a", "b", "diff", F.explode(F.array(F.lit(True), F.lit(False))).alias("left_side")
    ).filter(F.col("left_side") | (F.col("a") != F.col("b")))
    sides = sides.withColumn("node", F.when(F.col("left_side"), F.col("a")).otherwise(F.col("b")))
    at = F.array(*(F.struct(F.lit(d).alias("depth"), _node(F.col("print"), d).alias("node")) for d in depths))
    placed = prints.select("print", F.explode(at).alias("at")).select("print", "at.*") if depths else None
    if placed is None:
        return prints.select(F.col("print").alias("node"), F.col("print").alias("component")).limit(0)
    rows = placed.join(sides, ["depth", "node"]).select("depth", "a", "b", "diff", "left_side", "print")
    edges = rows.groupBy("depth", "a", "b").applyInArrow(_forest(budget), "a long, b long")
    return components(edges, "print-links")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, pair_size: int = PAIR_SIZE) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row; the component is the smallest doc_id reachable over links."""
    marks = written(fingerprints(docs), "prints")
    prints = written(marks.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    joined = print_components(prints.select("print"), budget, pair_size)
    of_print = prints.join(joined, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    least = of_print.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_print.join(least, "component").select(F.col("print").alias("known"), "component_id")
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return marks.join(named, F.col("print") == F.col("known")).select("doc_id", hexed, "component_id")
