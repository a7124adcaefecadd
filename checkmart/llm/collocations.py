"""Operator 11, phrase collocations: mergeable Misra-Gries summaries, then exact counts of what they keep.

Texts are lower-cased (A-Z), split into pieces at `[.,;:!?\\x0A-\\x0D]` and into words `[^\\x20\\x09]+`. All n-grams of one to
`LONGEST` words inside a piece are counted per language.

First pass. Every chunk of text counts its own n-grams and sends (hash, count) to the hash partition of the n-gram. The
receiver merges them into a Misra-Gries summary whose capacity exceeds the partition's mass divided by the threshold, so an
n-gram that occurs `threshold` times cannot be lost; the summary's error tells which entries may reach the threshold.
A count above the threshold is sent as the threshold, which keeps the guarantee and keeps a hot n-gram light.

Second pass. The survivors' hashes become a bit table of at most 2**MOST_BITS bits, whatever the input; tasks count the n-grams
that hit it, by their words, and one aggregate with map-side combine adds the counts up. Hashes only ever choose what is
counted: a collision or a full bit table costs time, and no result depends on it.

Nulls: a null text is empty, a null language is `und`. Repeated rows count as often as they occur. A table without phrases
that are frequent enough gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checkmart.llm.tables import written
from checkmart.llm.words import from_planar, mixed, planar

LONGEST = 4
THRESHOLD = 30
COVERED = 80
PER_LANG = 2000
SCALE = 2_000_000
#: Bytes of text whose n-grams are counted together in a task; a longer text is cut at a piece's end, or stands alone.
CHUNK_BYTES = 1 << 21
#: Bytes of text a hash partition of the first pass stands for.
PART_BYTES = 1 << 25
#: Capacity of a summary, in multiples of mass / threshold. More than one makes the survivors fewer.
SLACK = 4
#: The bit table of the second pass has at most this power of two bits (64 MB).
MOST_BITS = 29
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\n" * 10)
_FIRST = np.uint64(0x9E3779B97F4A7C15)


class Grams(NamedTuple):
    """The distinct n-grams of `size` words of a chunk: occurrences, hashes and the word at which the first one starts."""

    size: int
    counts: np.ndarray
    hashes: np.ndarray
    begins: np.ndarray


class Chunk(NamedTuple):
    """The words of some texts joined by single spaces, where each begins there (one more at the end), and the n-grams."""

    joined: bytes
    begins: np.ndarray
    grams: list[Grams]


def chunk_of(texts: Iterable[bytes], seed: int, longest: int = LONGEST) -> Chunk:
    """Counts the n-grams of some texts. N-grams are told apart by their words, not by their hashes."""
    data = b"\n".join(texts).lower().translate(_BREAKS)
    words = data.split()
    codes = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(codes) + 1, np.int8)
    inside[1:] = (codes != 0x20) & (codes != 0x09) & (codes != 0x0A)
    starts = np.flatnonzero(np.diff(inside) == 1)
    piece = np.cumsum(codes == 0x0A, dtype=np.int64)[starts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.zeros(len(words) + 1, np.int64)
    np.cumsum(lengths + 1, out=begins[1:])
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    numbers = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    own = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in ids), np.uint64, len(ids))
    word_hashes = own[numbers] if len(words) else own
    grams, current, hashes = [], numbers, word_hashes
    at = np.arange(len(words))
    for size in range(1, longest + 1):
        if size > 1:
            # an n-gram is its first n-1 words, numbered by the step before, and its last word
            last = at + size - 1
            fits = last < len(words)
            at, current, hashes, last = at[fits], current[fits], hashes[fits], last[fits]
            fits = piece[at] == piece[last]
            at, current, hashes, last = at[fits], current[fits], hashes[fits], last[fits]
            current = current << 32 | numbers[last]
            hashes = mixed(hashes * _FIRST + word_hashes[last])
        _, first, current, counts = np.unique(current, return_index=True, return_inverse=True, return_counts=True)
        grams.append(Grams(size, counts, hashes[first], at[first]))
    return Chunk(b" ".join(words), begins, grams)


class Summary:
    """A Misra-Gries summary of weighted keys. `error` bounds by how much any key's count may be too low."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Takes in another summary's entries; they are merged when as many wait as the capacity holds."""
        self._waiting.append((keys, counts))
        self._held += len(keys)
        if self._held > self.capacity:
            self.merge()

    def merge(self) -> None:
        """Adds up equal keys; beyond the capacity, all counts fall by the largest count that has no place."""
        parts = [(self.keys, self.counts), *self._waiting]
        self._waiting, self._held = [], 0
        keys = np.concatenate([k for k, _ in parts])
        weights = np.concatenate([c for _, c in parts])
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
        begins = np.flatnonzero(np.diff(keys, prepend=~keys[:1])) if len(keys) else np.empty(0, np.int64)
        keys, counts = keys[begins], np.add.reduceat(weights, begins) if len(begins) else weights
        if len(keys) > self.capacity:
            place = len(keys) - self.capacity - 1
            cut = int(np.partition(counts, place)[place])
            self.error += cut
            kept = counts > cut
            keys, counts = keys[kept], counts[kept] - cut
        self.keys, self.counts = keys, counts

    def reaching(self, threshold: int) -> np.ndarray:
        """The keys whose true count may reach the threshold."""
        self.merge()
        return self.keys[self.counts + self.error >= threshold]


def _chunks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a batch by language, in chunks of about `size` bytes; a longer text is cut at piece ends."""
    waiting: dict[str, tuple[list[bytes], int]] = {}
    for lang, text in zip(batch["lang"], batch["text"], strict=True):
        lang, text = lang.as_py(), text.as_py()
        held, total = waiting.get(lang, ([], 0))
        for part in _cut(text, size):
            if total and total + len(part) > size:
                yield lang, held
                held, total = [], 0
            held.append(part)
            total += len(part)
        waiting[lang] = held, total
    yield from ((lang, held) for lang, (held, _) in waiting.items())


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    while len(text) > size:
        end = max(text.rfind(c, 0, size) for c in b".,;:!?\n\x0b\x0c\r") + 1
        if not end:
            end = min((i for c in b".,;:!?\n\x0b\x0c\r" if (i := text.find(c)) >= 0), default=len(text) - 1) + 1
        yield text[:end]
        text = text[end:]
    yield text


def _batch(columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


_BLOCK = "part int, mass long, keys binary, counts binary"


def _blocks(part_bits: int, threshold: int, longest: int, size: int) -> Callable:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
        for batch in batches:
            for lang, texts in _chunks(batch, size):
                grams = chunk_of(texts, _seed(lang), longest).grams
                hashes = np.concatenate([g.hashes for g in grams])
                counts = np.minimum(np.concatenate([g.counts for g in grams]), threshold).astype(np.uint8)
                if not len(hashes):
                    continue
                order = np.argsort(hashes)
                hashes, counts = hashes[order], counts[order]
                parts = (hashes >> np.uint64(63 - part_bits)) >> np.uint64(1)
                keys = ((hashes << np.uint64(part_bits)) >> np.uint64(32)).astype(np.uint32)
                present, begins = np.unique(parts, return_index=True)
                rows = [
                    # keys are sorted, so their differences are small
                    (int(part), int(counts[a:b].sum()), planar(np.diff(keys[a:b], prepend=np.uint32(0))), counts[a:b].tobytes())
                    for part, a, b in zip(present, begins, [*begins[1:], len(parts)], strict=True)
                ]
                # the masses come alone too: they sort before the blocks and set the capacity
                rows += [(part, mass, None, None) for part, mass, _, _ in rows]
                yield _batch(zip(*rows, strict=True), schema)

    return blocks


def _survivors(threshold: int, slack: int) -> Callable:
    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("n_keys", pa.int64()), ("keys", pa.binary())])

        def result(part: int, summary: Summary) -> pa.RecordBatch:
            keys = summary.reaching(threshold)
            return _batch(([part], [len(keys)], [keys.astype("<u4").tobytes()]), schema)

        part, mass, summary = None, 0, None
        for batch in batches:
            for at, weight, keys, counts in zip(*(batch.column(i) for i in range(4)), strict=True):
                if at.as_py() != part:
                    if summary:
                        yield result(part, summary)
                    part, mass, summary = at.as_py(), 0, None
                if not keys.is_valid:
                    mass += weight.as_py()
                    continue
                if summary is None:
                    summary = Summary(slack * mass // threshold + 1)
                values = np.cumsum(from_planar(keys.as_py()), dtype=np.uint32)
                summary.add(values, np.frombuffer(counts.as_py(), np.uint8).astype(np.int64))
        if summary:
            yield result(part, summary)

    return survivors


def frequent_keys(texts: DataFrame, part_bits: int, threshold: int, longest: int, slack: int = SLACK, size: int = CHUNK_BYTES) -> DataFrame:
    """First pass: for every hash partition the 32-bit keys of n-grams that may occur `threshold` times, none left out."""
    blocks = texts.mapInArrow(_blocks(part_bits, threshold, longest, size), _BLOCK)
    # one summary a task: as many tasks as the volume asks for, of bounded size
    by_part = blocks.repartitionById(1 << part_bits, "part").sortWithinPartitions("part", F.col("keys").isNotNull())
    return by_part.mapInArrow(_survivors(threshold, slack), "part int, n_keys long, keys binary")


def _bit_slices(part_bits: int, bits: int) -> Callable:
    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])
        for batch in batches:
            for part, keys in zip(batch["part"], batch["keys"], strict=True):
                flags = np.zeros(1 << (bits - part_bits), bool)
                flags[np.frombuffer(keys.as_py(), "<u4") >> np.uint32(32 - (bits - part_bits))] = True
                yield _batch(([part.as_py()], [np.packbits(flags, bitorder="little").tobytes()]), schema)

    return slices


def _counted(table, bits: int, longest: int, size: int) -> Callable:
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("size", pa.int32()), ("occurrences", pa.int64())])
    rows_at_once = 1 << 16

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            for lang, texts in _chunks(batch, size):
                chunk = chunk_of(texts, _seed(lang), longest)
                yield _batch(([lang], [b""], [0], [len(chunk.begins) - 1]), schema)
                for grams in chunk.grams:
                    place = grams.hashes >> np.uint64(64 - bits)
                    hit = np.flatnonzero(flags[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    for i in range(0, len(hit), rows_at_once):
                        some = hit[i : i + rows_at_once]
                        begins = chunk.begins[grams.begins[some]].tolist()
                        ends = (chunk.begins[grams.begins[some] + grams.size] - 1).tolist()
                        phrases = [chunk.joined[a:b] for a, b in zip(begins, ends, strict=True)]
                        sizes = np.full(len(some), grams.size, np.int32)
                        yield _batch(([lang] * len(some), phrases, sizes, grams.counts[some]), schema)

    return counted


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, occurrences) of every n-gram that occurs at least `threshold` times in its language.

    A row with the empty phrase and size 0 holds the number of words of the language. The result is stored.
    """
    spark = docs.sparkSession
    if not 1 <= threshold <= 255:
        raise ValueError("the threshold is sent as one byte: 1 to 255")
    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = min(20, max(3, int(volume // PART_BYTES).bit_length()))
    found = written(frequent_keys(texts, part_bits, threshold, longest), "frequent-keys")
    n_keys = found.agg(F.sum("n_keys")).first()[0] or 0
    # 32 bits a survivor, and a bound of its own
    bits = min(MOST_BITS, max(part_bits + 3, int(32 * n_keys).bit_length()))
    flags = bytearray(1 << (bits - 3))
    width = 1 << (bits - 3 - part_bits)
    for row in found.mapInArrow(_bit_slices(part_bits, bits), "part int, bits binary").toLocalIterator():
        flags[row["part"] * width : (row["part"] + 1) * width] = row["bits"]
    table = spark.sparkContext.broadcast(bytes(flags))
    rows = texts.mapInArrow(
        _counted(table, bits, longest, CHUNK_BYTES), "lang string, phrase binary, size int, occurrences long"
    )
    sums = rows.groupBy("lang", "phrase", "size").agg(F.sum("occurrences").alias("occurrences"))
    frequent = sums.filter((F.col("size") == 0) | (F.col("occurrences") >= threshold))
    return written(frequent.withColumn("phrase", F.col("phrase").cast("string")), "phrase-counts")


def _part(words: str, begin, length) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def cut_scores(counts: DataFrame) -> DataFrame:
    """Every phrase of two words or more at its lowest-scoring cut: a, l, r, score. Decimals, so products cannot overflow."""
    phrases = counts.filter("size >= 2").withColumn("words", F.split("phrase", " "))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang",
        "phrase",
        "size",
        F.col("occurrences").alias("a"),
        "cut",
        _part("words", F.lit(1), F.col("cut")).alias("left_part"),
        _part("words", F.col("cut") + 1, F.col("size") - F.col("cut")).alias("right_part"),
    )
    of_left = counts.filter("size > 0").select("lang", F.col("phrase").alias("left_part"), F.col("occurrences").alias("l"))
    of_right = of_left.withColumnsRenamed({"left_part": "right_part", "l": "r"})
    joined = cuts.join(of_left, ["lang", "left_part"]).join(of_right, ["lang", "right_part"])
    score = F.expr(
        f"(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)))"
        " div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    )
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return joined.groupBy("lang", "phrase", "size", "a").agg(best).select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score")


def uncovered(scored: DataFrame, covered: int = COVERED) -> DataFrame:
    """Phrases without a longer phrase that contains them and occurs at least `covered` percent as often."""
    longer = scored.filter("size >= 3").select("lang", "size", "a", F.split("phrase", " ").alias("words"))
    inner = longer.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inner = inner.select("lang", _part("words", F.col("begin"), F.col("length")).alias("phrase"), F.col("a").alias("around"))
    most = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    # a count times 100 fits 64 bits up to 9e16 occurrences
    open_ = F.col("around").isNull() | (100 * F.col("around") < covered * F.col("a"))
    return scored.join(most, ["lang", "phrase"], "left").filter(open_).drop("around")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, per_lang: int = PER_LANG, covered: int = COVERED) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Ordered by score, then occurrences, both descending, then phrase in byte order; `per_lang` is the size of the report.
    """
    counts = phrase_counts(docs, threshold, longest)
    phrases = uncovered(cut_scores(counts), covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_lang)
    totals = counts.filter("size = 0").select("lang", F.col("occurrences").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
