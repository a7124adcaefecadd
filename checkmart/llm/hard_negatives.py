"""Operator 12, hard negatives: cover trees over norm-augmented candidates, searched best-first.

Rows are vectors of whole numbers, floor(256 x). Anchors are the rows whose id is divisible by 100; scores are inner products.
An anchor's positives are its best other rows of the same label; the hard negatives of a positive are the best rows of
another label whose score lies in the window from 30 to 90 percent of the positive's. Ties go to the smaller id.

Plan. All rows are dealt into trees of at most `TREE_ROWS` by a hash of the id, and trees are stored once, as rows. Candidates
get one more coordinate that gives all of a tree the same norm, which turns inner products into distances; a cover tree
(each level's centres lie further apart than the radius below them, and cover all their points) knows a radius per node.
For a node of centre c and radius r all scores lie within |q| r of q.c: a node whose interval misses all windows, or lies below
the tenth best so far, is skipped; the others are opened best bound first, and points are verified with exact
whole-number products. The anchors, one row in a hundred, meet the trees in blocks: `TREES_PER_SITE` trees and all anchors a
task, one batch at a time. Tasks return the best few of each anchor and tree, and a ranking over them gives the result.

Nulls: a row takes no part if its id, label or vector is null, or a component is null, infinite or not a number. Of rows that
share an id the one with the smallest label, then vector, takes part. Vectors of several lengths are filled up with zeros.
An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checkmart.llm.tables import partitions, written

GRAIN = 256
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90
TREE_ROWS = 8192
TREES_PER_SITE = 16
#: Nodes of at most this many points are not divided further.
LEAF = 512
#: A child's radius is its parent's divided by this.
SHRINK = 1.3


_ANY = (-(2**63), 2**63 - 1)


class Tree(NamedTuple):
    """A cover tree. Node 0 is the root; the children of a node are a range of nodes, its own points a range of rows."""

    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    centers: np.ndarray
    radii: np.ndarray
    children: np.ndarray
    points: np.ndarray


def augmented(vectors: np.ndarray) -> np.ndarray:
    """The vectors with one more coordinate, so that all have the norm of the longest."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))])


def cover_tree(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF, shrink: float = SHRINK) -> Tree:
    """Builds a tree, level by level. Centres of a level are chosen farthest first until they cover their node's points."""
    lifted = augmented(vectors.astype(np.float64))
    order: list[np.ndarray] = []
    centers, radii, children, points = [], [], [], []
    placed = 0
    queue: list[tuple[int, np.ndarray]] = [(0, np.arange(len(ids)))] if len(ids) else []
    done = 0
    while done < len(queue):
        center, rows = queue[done]
        done += 1
        away = np.linalg.norm(lifted[rows] - lifted[center], axis=1)
        centers.append(center)
        radii.append(away.max())
        alone, begin = rows, len(queue)
        if len(rows) > leaf and away.max() > 0:
            owner, chosen = np.zeros(len(rows), np.int64), [center]
            while away.max() > radii[-1] / shrink:
                far = int(away.argmax())
                near = np.linalg.norm(lifted[rows] - lifted[rows[far]], axis=1)
                closer = near < away
                away[closer], owner[closer] = near[closer], len(chosen)
                chosen.append(rows[far])
            sizes = np.bincount(owner, minlength=len(chosen))
            alone = rows[sizes[owner] == 1]
            queue.extend((chosen[i], rows[owner == i]) for i in np.flatnonzero(sizes > 1))
        children.append((begin, len(queue)))
        points.append((placed, placed + len(alone)))
        order.append(alone)
        placed += len(alone)
    place = np.concatenate(order) if order else np.empty(0, np.int64)
    at = np.empty(len(place), np.int64)
    at[place] = np.arange(len(place))
    return Tree(
        vectors[place],
        ids[place],
        labels[place],
        at[np.array(centers, np.int64)],
        np.array(radii, np.float64),
        np.array(children, np.int64).reshape(-1, 2),
        np.array(points, np.int64).reshape(-1, 2),
    )


def exact(vectors: np.ndarray, query: np.ndarray) -> type:
    """The type whose products are exact: floats up to 2**53, whole numbers up to 2**63. Larger scores are refused."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(vectors.shape[1], 1)
    if most >= 2**63:
        raise OverflowError("scores of these vectors may pass 64 bits")
    return np.float64 if most < 2**53 else np.int64


class Best:
    """The best `size` rows of a window of scores, ties by smaller id."""

    def __init__(self, low: int, high: int, size: int):
        self.low, self.high, self.size = low, high, size
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def wants(self, low: float, high: float) -> bool:
        """Whether a node whose scores lie between these bounds may hold one of the best."""
        return low <= self.high and high >= self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        if not inside.any():
            return
        scores, ids = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.ids, ids[inside]])
        order = np.lexsort((ids, -scores))[: self.size]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.size:  # a tie with the last one still counts: its id may be smaller
            self.low = max(self.low, int(self.scores[-1]))


def search(tree: Tree, query: np.ndarray, label: int, same: bool, skip: int, windows: list[Best], middles: np.ndarray | None = None) -> int:
    """Fills the windows with the tree's rows of the same label, or of others, without the row of the id `skip`.

    `tree.vectors` and the query are of a type whose products are exact; `middles` are the scores of the nodes' centres.
    Returns the number of verified rows.
    """
    if not len(tree.radii):
        return 0
    length = math.sqrt(float(np.dot(query.astype(np.float64), query.astype(np.float64))))
    longest = float(np.linalg.norm(tree.vectors[tree.centers[0]].astype(np.float64))) + tree.radii[0]
    # a little more than the radius, for the rounding of floats
    reach = (length * (tree.radii + 1e-9 * longest) + 1e-6).tolist()
    middle = (tree.vectors[tree.centers] @ query if middles is None else middles).tolist()
    heap = [(-(middle[0] + reach[0]), 0)]
    verified = 0
    while heap:
        upper, node = heapq.heappop(heap)
        low, high = min(w.low for w in windows), max(w.high for w in windows)
        if -upper < low:
            break
        first, last = tree.points[node]
        if last > first:
            verified += int(last - first)
            scores = tree.vectors[first:last] @ query
            inside = (scores >= low) & (scores <= high) & ((tree.labels[first:last] == label) == same)
            usable = np.flatnonzero(inside & (tree.ids[first:last] != skip))
            if len(usable):
                scores, ids = scores[usable].astype(np.int64), tree.ids[first:last][usable]
                for window in windows:
                    window.add(scores, ids)
        for child in range(*tree.children[node]):
            below, above = middle[child] - reach[child], middle[child] + reach[child]
            if any(w.wants(below, above) for w in windows):
                heapq.heappush(heap, (-above, child))
    return verified


def window_of(positive: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """The scores s with lowest * positive <= 100 * s <= highest * positive, as whole numbers."""
    return -(-lowest * positive // 100), highest * positive // 100


def prepared(vectors: DataFrame, label: Column | None = None, grain: int = GRAIN) -> DataFrame:
    """(vec_id, label, vector of whole numbers) of the rows that take part. `label` may replace the label."""
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).filter(good)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~bad).select(
        "vec_id",
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x * F.lit(float(grain))).cast("double")).alias("vector"),
    )
    one = F.min(F.struct("label", "vector")).alias("row")
    return rows.groupBy("vec_id").agg(one).select("vec_id", "row.label", "row.vector")


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for i, row in enumerate(lists):
        if not row.is_valid:
            continue
        values = row.values.to_numpy(zero_copy_only=False)
        out[i, : len(values)] = values
    return out


def _plant(width: int) -> Callable:
    def plant(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table["vector"].chunk(0) if table["vector"].num_chunks else pa.array([], table["vector"].type)
        tree = cover_tree(_matrix(lists, width), table["vec_id"].to_numpy(), table["label"].to_numpy())
        parts = [np.ascontiguousarray(part).tobytes() for part in tree]
        return pa.table({"tree": [table["tree"][0].as_py()], "parts": [parts]}, schema=pa.schema([("tree", pa.int64()), ("parts", pa.list_(pa.binary()))]))

    return plant


def _tree(parts: list[bytes], width: int) -> Tree:
    kinds = [np.float64, np.int64, np.int64, np.int64, np.float64, np.int64, np.int64]
    vectors, ids, labels, centers, radii, children, points = (np.frombuffer(p, k) for p, k in zip(parts, kinds, strict=True))
    return Tree(vectors.reshape(len(ids), width), ids, labels, centers, radii, children.reshape(-1, 2), points.reshape(-1, 2))


_FOUND = "anchor_id long, positive_id long, positive_score long, found_id long, found_score long"


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows with equal keys."""
    changes = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if len(keys[0]) else []
    edges = [0, *changes, len(keys[0])] if len(keys[0]) else [0]
    return list(itertools.pairwise(edges))


def _answers(trees: list[Tree], asked: pa.RecordBatch, vectors: np.ndarray, size: int) -> list[tuple]:
    """The best rows of every tree for every anchor of a batch."""
    rows: list[tuple] = []
    anchors = list(zip(*(asked[n].to_pylist() for n in ("vec_id", "label", "positives", "scores")), strict=True))
    for tree in trees:
        kind = exact(tree.vectors, vectors)
        tree, queries = tree._replace(vectors=tree.vectors.astype(kind, copy=False)), vectors.astype(kind, copy=False)
        middles = queries @ tree.vectors[tree.centers].T
        for (anchor, label, ids, scores), query, middle in zip(anchors, queries, middles, strict=True):
            limits = [_ANY] if ids is None else [window_of(s) for s in scores]
            # positives with equal scores share a window
            windows = {limit: Best(*limit, size) for limit in limits if limit[0] <= limit[1]}
            if windows:
                search(tree, query, label, ids is None, anchor, list(windows.values()), middle)
            for n, limit in enumerate(limits):
                own = (None, None) if ids is None else (ids[n], scores[n])
                best = windows.get(limit)
                if best:
                    rows.extend((anchor, *own, f, s) for f, s in zip(best.ids.tolist(), best.scores.tolist(), strict=True))
    return rows


def _searched(width: int, size: int) -> Callable:
    """Searches positives for anchors that come without them, and negatives for those that bring theirs along."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor_id", "positive_id", "positive_score", "found_id", "found_score"]
        trees: list[Tree] = []
        site = None
        for batch in batches:
            at, turns = batch["site"].to_numpy(), batch["turn"].to_numpy()
            for begin, end in _runs(at, turns):
                if at[begin] != site:
                    site, trees = at[begin], []
                part = batch.slice(begin, end - begin)
                if turns[begin] == 0:
                    trees.extend(_tree(parts.as_py(), width) for parts in part["parts"])
                    continue
                rows = _answers(trees, part, _matrix(part["vector"], width), size)
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    return searched


def forest(rows: DataFrame, total: int, width: int, tree_rows: int = TREE_ROWS) -> DataFrame:
    """All rows as stored trees: (tree, parts)."""
    trees = max(1, math.ceil(total / tree_rows))
    dealt = rows.withColumn("tree", F.pmod(F.xxhash64("vec_id"), F.lit(trees)))
    return written(dealt.groupBy("tree").applyInArrow(_plant(width), "tree long, parts array<binary>"), "cover-trees")


def _meet(trees: DataFrame, anchors: DataFrame, sites: int, width: int, size: int) -> DataFrame:
    """Every anchor searched in every tree, a site's trees and the anchors in one task."""
    placed = trees.select(
        F.pmod("tree", F.lit(sites)).cast("long").alias("site"),
        F.lit(0).alias("turn"),
        "parts",
        *(F.lit(None).cast(t).alias(n) for n, t in (("vec_id", "long"), ("label", "long"), ("vector", "array<double>"), ("positives", "array<long>"), ("scores", "array<long>"))),
    )
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sites - 1).cast("long"))).alias("site"),
        F.lit(1).alias("turn"),
        F.lit(None).cast("array<binary>").alias("parts"),
        "vec_id",
        "label",
        "vector",
        "positives",
        "scores",
    )
    # a site is a task: hashing would put several into one
    meeting = placed.union(asked).repartitionById(sites, F.col("site").cast("int")).sortWithinPartitions("site", "turn")
    return meeting.mapInArrow(_searched(width, size), _FOUND)


def hard_negatives(vectors: DataFrame, label: Column | None = None, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), the first `negatives` of each pair."""
    spark = vectors.sparkSession
    rows = written(prepared(vectors, label), "vectors")
    total, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    trees = forest(rows, total, width, tree_rows)
    n_trees = max(1, math.ceil(total / tree_rows))
    sites = max(min(n_trees, partitions(spark)), math.ceil(n_trees / TREES_PER_SITE))
    asked = rows.filter((F.col("vec_id") % 100 == 0) if is_anchor is None else is_anchor)
    none = F.lit(None).cast("array<long>")
    first = _meet(trees, asked.select("*", none.alias("positives"), none.alias("scores")), sites, width, positives)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("found_score"), "found_id")
    chosen = first.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    pairs = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "found_id", "found_score"))).alias("found"))
    paired = written(
        asked.join(pairs, F.col("vec_id") == F.col("anchor_id")).select(
            "vec_id", "label", "vector", F.col("found.found_id").alias("positives"), F.col("found.found_score").alias("scores")
        ),
        "anchors",
    )
    second = _meet(trees, paired, sites, width, negatives)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("found_score"), "found_id")
    ranked = second.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("found_score").alias("negative_score"))
