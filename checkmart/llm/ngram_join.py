"""Operator 3, n-gram Jaccard join: MinHash banding, then verification on full n-gram sets.

Texts become sets of `width`-word shingles; texts with equal sets are one class. Band and row counts follow from the
threshold and the target recall. Classes that share a band hash are linked to the band's smallest class, and the
connected components of these links are the candidate groups. Every pair of classes inside a candidate group is compared
on its full shingle sets, so a link is missed only where two classes share no band and no chain of bands.

Plan. Band hashes and class keys alone are shuffled, one row per class and band. Shingle sets travel once, to the task of
their group. A group above `CHUNK_SHINGLES` is cut into chunks of classes and every pair of chunks is verified alone; smaller
groups are verified in bundles of about as many shingles, so the number of bundles grows with the data, not their size.
No pair becomes a row: tasks return link counts per class and a spanning tree of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checkmart.llm.tables import components, partitions, text_key, written
from checkmart.llm.words import chunks, giving_back, mixed, shingles, words_of

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 80
#: Shingles in a chunk of a candidate group; two chunks meet in a task.
CHUNK_SHINGLES = 1 << 18
#: Above this many index steps a task multiplies incidence matrices instead.
_DENSE_FROM = 1 << 27
_DENSE_CELLS = 1 << 25


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, hence fewest false candidates, that reach the recall at the threshold."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def _set_keys(values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key and the size of each set; equal sets have equal keys in any order."""
    n = len(firsts) - 1
    doc = np.repeat(np.arange(n), np.diff(firsts))
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    values, doc = values[fresh], doc[fresh]
    sizes = np.bincount(doc, minlength=n)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    ends = np.cumsum(sizes)
    keys = mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64))
    return keys.view(np.int64), sizes


def _sign(width: int, bands: int, rows: int, schema: pa.Schema):
    multipliers = mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64)).reshape(2, -1) | np.uint64(1)

    def signatures(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """One hash per text and band; texts without shingles get zeros."""
        out = np.zeros((len(firsts) - 1, bands), np.uint64)
        some = np.flatnonzero(np.diff(firsts))
        if not len(some):
            return out.view(np.int64)
        begins = firsts[some]
        for band in range(bands):
            joined = np.full(len(some), band + 1, np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                low = np.minimum.reduceat(values * multipliers[0, k] + multipliers[1, k], begins)
                joined = mixed(joined + low)
            out[some, band] = joined
        return out.view(np.int64)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
            for part in chunks(texts):
                values, firsts = shingles(words_of(texts[part]), width)
                keys, sizes = _set_keys(values, firsts)
                signed = signatures(values, firsts)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, signed.size + 1, bands), pa.int32()), pa.array(signed.ravel())
                )
                rows_in = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [rows_in["id"], rows_in["text_key"], pa.array(keys), pa.array(sizes, pa.int64()), lists],
                    names=schema,
                )

    return run


def _shingle_sets(width: int, names: list[str]):
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
            kept = [batch[n] for n in names]
            for part in chunks(texts):
                values, firsts = shingles(words_of(texts[part]), width)
                sets = [np.unique(values[a:b]).tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                columns = [c.slice(part.start, part.stop - part.start) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], names=[*names, "set"])

    return run


def _overlaps(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For ranges of sets, from the given first one on, the sizes of their intersections with every set."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    n, width = len(sets), int(column.max()) + 1 if len(column) else 0
    uses = np.bincount(column, minlength=width)
    if int(np.sum(uses.astype(np.int64) ** 2)) > _DENSE_FROM:
        yield from _dense_overlaps(owner, column, n, width)
        return
    by_column = owner[np.argsort(column, kind="stable")]
    begins = np.cumsum(uses) - uses
    firsts = np.searchsorted(owner, np.arange(n + 1))
    for i in range(n):
        own = column[firsts[i] : firsts[i + 1]]
        if len(own):
            met = np.concatenate([by_column[a : a + k] for a, k in zip(begins[own], uses[own], strict=True)])
            yield i, np.bincount(met, minlength=n)[None, :]
        else:
            yield i, np.zeros((1, n), np.int64)


def _dense_overlaps(owner: np.ndarray, column: np.ndarray, n: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The same by products of incidence matrices, in slices of bounded size."""
    rows = max(1, min(n, _DENSE_CELLS // max(1, 2 * n)))
    step = max(1, _DENSE_CELLS // n)
    slices = []
    for a in range(0, width, step):
        inside = (column >= a) & (column < a + step)
        slices.append((a, min(step, width - a), owner[inside], column[inside] - a))
    for i in range(0, n, rows):
        out = np.zeros((min(rows, n - i), n), np.float32)
        for _, cells, own, col in slices:
            all_rows = np.zeros((n, cells), np.float32)
            all_rows[own, col] = 1
            out += all_rows[i : i + rows] @ all_rows.T
        yield i, out


def _cell_links(
    keys: np.ndarray, chunk: np.ndarray, sets: list[np.ndarray], threshold: float, mixed_only: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Links per class and a spanning forest of the links, for the pairs of a cell.

    A cell holds one chunk, or two whose mixed pairs alone are its own.
    """
    n = len(keys)
    sizes = np.array([len(s) for s in sets])
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = np.zeros(n, np.int64)
    for first, common in _overlaps(sets):
        for offset, row in enumerate(common):
            i = first + offset
            union = sizes[i] + sizes - row
            near = (row >= threshold * union - 1e-9) & (union > 0)
            near[i] = False
            if mixed_only:
                near &= chunk != chunk[i]
            links[i] = int(near.sum())
            later = np.flatnonzero(near[i + 1 :]) + i + 1
            for j in later[parent[later] != parent[i]]:
                a, b = root(i), root(int(j))
                parent[max(a, b)] = min(a, b)
                parent[j] = parent[i] = min(a, b)
    return links, keys[[root(i) for i in range(n)]]


_LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        """All cells of a group, one after the other."""
        table = table.combine_chunks().sort_by([("component", "ascending"), ("row", "ascending"), ("col", "ascending"), ("node", "ascending")])
        cell = np.stack([table[c].to_numpy() for c in ("component", "row", "col")], axis=1)
        nodes, chunk = table["node"].to_numpy(), table["chunk"].to_numpy()
        cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1).tolist(), len(cell)] if len(cell) else [0]
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            sets = [np.frombuffer(s, "<u8") for s in table["set"].slice(a, b - a).to_pylist()]
            links, roots = _cell_links(nodes[a:b], chunk[a:b], sets, threshold, cell[a, 1] != cell[a, 2])
            out.append(pa.table([nodes[a:b], links, roots], schema=_LINKS))
        return pa.concat_tables(out) if out else _LINKS.empty_table()

    return run


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of `docs`: (doc_id, class_id, n_links, n_copies, text_key, class_key).

    Links join different shingle sets of a Jaccard similarity of `threshold` or more. class_id is the smallest doc_id of
    the documents connected by links and equal sets, n_links the number of other sets linked to the document's own, and
    n_copies the number of rows with its set; class_key tells which row of class_id stands for the class, should several rows
    share that id. A text of fewer words than a shingle is one shingle of all its words.
    Null and wordless texts have an empty set and form one class without links. A null id is no class id unless its whole
    class lacks ids. Repeated rows are copies of each other.
    """
    bands, rows = banding(threshold, recall)
    n = partitions(docs.sparkSession)
    text = F.col(text_col)
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("text_key"), text.alias("text"))
    signed = written(
        source.mapInArrow(
            _sign(width, bands, rows, ["id", "text_key", "node", "size", "bands"]),
            "id long, text_key long, node long, size long, bands array<long>",
        ),
        "signatures",
    )
    classes = signed.groupBy("node").agg(
        F.max("size").alias("size"),
        F.count("*").alias("n_copies"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("least"),
        *(F.min(F.col("bands")[k]).alias(f"b{k}") for k in range(bands)),
    )
    classes = written(classes, "classes")

    # candidate groups: every class of a band is tied to the band's smallest class
    banded = classes.filter("size > 0").select(
        "node", F.posexplode(F.array(*(f"b{k}" for k in range(bands)))).alias("band", "hash")
    )
    buckets = banded.groupBy("band", "hash").agg(F.min("node").alias("low"), F.count("*").alias("k")).filter("k > 1")
    ties = banded.join(buckets, ["band", "hash"]).select(F.col("node").alias("a"), F.col("low").alias("b"))
    groups = components(ties, "ties")
    members = groups.join(classes.select("node", "size", "least"), "node")
    weights = members.groupBy("component").agg(F.ceil(F.sum("size") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    members = members.join(weights, "component").select(
        "node",
        "component",
        "chunks",
        F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"),
        F.col("least.id").alias("least_id"),
        F.col("least.text_key").alias("least_key"),
    )
    members = written(members, "members")

    # one text stands for each class of a group; its shingle set goes to the cells of its chunk
    columns = ["node", "component", "chunks", "chunk"]
    texts = source.hint("merge").join(  # the same plan at every size
        members, source["id"].eqNullSafe(members["least_id"]) & (source["text_key"] == members["least_key"])
    ).select(*columns, "text")
    # rows that repeat id and text give the same set twice; verification needs it once
    sets = texts.mapInArrow(
        _shingle_sets(width, columns), "node long, component long, chunks int, chunk int, set binary"
    )
    cells = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "node",
        "component",
        "chunks",
        "chunk",
        "set",
        F.least("chunk", "other").alias("row"),
        F.greatest("chunk", "other").alias("col"),
    )
    shingles_of_all = classes.agg(F.sum("size")).first()[0] or 0
    bundles = max(4 * n, math.ceil(shingles_of_all / CHUNK_SHINGLES))
    small = F.pmod(F.xxhash64("component"), F.lit(bundles))
    group = F.when(F.col("chunks") > 1, F.col("component")).otherwise(small)
    linked = written(
        cells.groupBy(group.alias("bundle"), "row", "col").applyInArrow(
            _deduplicated(_verify(threshold)), "node long, links long, root long"
        ),
        "links",
    )
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    merged = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), "roots")
    labels = (
        classes.select("node", "n_copies", "least")
        .join(counts, "node", "left")
        .join(merged, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    first = labels.groupBy("component").agg(F.min("least").alias("first"))
    labels = labels.join(first, "component").select(
        "node",
        F.col("first.id").alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        "n_copies",
        F.col("first.text_key").alias("class_key"),
    )
    return signed.join(labels, "node").select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies", "text_key", "class_key"
    )


def _deduplicated(verify):
    def run(table: pa.Table) -> pa.Table:
        keys = np.stack([table[c].to_numpy() for c in ("component", "row", "col", "node")], axis=1)
        if not len(keys):
            return verify(table)
        _, first = np.unique(keys, axis=0, return_index=True)
        return verify(table if len(first) == len(keys) else table.take(pa.array(np.sort(first))))

    return run
