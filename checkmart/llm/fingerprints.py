"""Operator 2, document fingerprints: a homomorphic multiset hash over paragraphs.

Every paragraph (text up to a line break or a sentence end) is hashed to a wide vector: `WIDE` numbers modulo
2**`WIDE_BITS`, `LANES` signs, and the number 1. A fingerprint is the sum of its paragraphs' vectors: it does not depend on
order, equal multisets have equal fingerprints, and paragraphs are inserted and deleted by adding and subtracting their
vectors. The wide sums tell multisets apart, the cosine of the signed sums estimates their likeness. DataFrame
expressions only; signs lie two to a 64-bit number.

A vector counts, per lane, the paragraphs whose hash has that bit; with the number of paragraphs n, the signed sum of a
lane is 2 * count - n. No text has so many paragraphs that a count reaches 2**`LANE_BITS`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checkmart.llm.tables import partitions

LANES = 128
LANE_BITS = 30
WIDE = 4
WIDE_BITS = 62
PARAGRAPH_END = r"\n+|(?<=[.!?])\s+"
_ONES = 0x0000000100000001
_KEEP = 0x3FFFFFFF3FFFFFFF
_BORROW = 0x4000000040000000
_WIDE_KEEP = (1 << WIDE_BITS) - 1
_MODULUS = 1 << LANE_BITS


def paragraphs(text: Column) -> Column:
    """The non-empty paragraphs of a text; a null or empty text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END), "")


def _hashes(items: Column, seed: int) -> Column:
    return F.transform(items, lambda p: F.xxhash64(F.lit(seed), p))


def _lane_counts(hashes: Column, bit: int) -> Column:
    """Two lanes: how many hashes have the bits `bit` and `bit` + 32."""
    return F.aggregate(
        hashes,
        F.lit(0).cast("long"),
        lambda total, h: (total + F.shiftrightunsigned(h, bit).bitwiseAND(F.lit(_ONES))).bitwiseAND(F.lit(_KEEP)),
    )


def _wide_sum(hashes: Column) -> Column:
    """The sum of the hashes' upper `WIDE_BITS` bits, modulo 2**`WIDE_BITS`."""
    return F.aggregate(
        hashes,
        F.lit(0).cast("long"),
        lambda total, h: (total + F.shiftrightunsigned(h, 64 - WIDE_BITS)).bitwiseAND(F.lit(_WIDE_KEEP)),
    )


def with_vector(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Adds the packed sums of a text: the lanes, two to a number, the count of its paragraphs, and the wide sums.

    Paragraphs and hashes are columns of their own, so that each is computed once.
    """
    seeds, wide = range(LANES // 64), range(LANES // 64, LANES // 64 + WIDE)
    df = df.withColumn("__paragraphs", paragraphs(F.col(text_col)))
    df = df.withColumns({f"__hashes{seed}": _hashes(F.col("__paragraphs"), seed) for seed in seeds})
    packed = [_lane_counts(F.col(f"__hashes{seed}"), bit) for seed in seeds for bit in range(32)]
    sums = [_wide_sum(_hashes(F.col("__paragraphs"), seed)) for seed in wide]
    df = df.withColumn(name, F.array(*packed, F.size("__paragraphs").cast("long"), *sums))
    return df.drop("__paragraphs", *(f"__hashes{seed}" for seed in seeds))


def _parts(packed: Column) -> tuple[Column, Column]:
    """The lanes with the count, and the wide sums."""
    return F.slice(packed, 1, LANES // 2 + 1), F.slice(packed, LANES // 2 + 2, WIDE)


def inserted(one: Column, other: Column) -> Column:
    """The fingerprint of the union of two multisets."""
    (lanes, wide), (more, widen) = _parts(one), _parts(other)
    return F.concat(
        F.zip_with(lanes, more, lambda a, b: (a + b).bitwiseAND(F.lit(_KEEP))),
        F.zip_with(wide, widen, lambda a, b: (a + b).bitwiseAND(F.lit(_WIDE_KEEP))),
    )


def deleted(one: Column, other: Column) -> Column:
    """The fingerprint of `one` without the paragraphs of `other`."""
    (lanes, wide), (less, narrow) = _parts(one), _parts(other)
    return F.concat(
        F.zip_with(lanes, less, lambda a, b: ((a + F.lit(_BORROW)) - b).bitwiseAND(F.lit(_KEEP))),
        F.zip_with(wide, narrow, lambda a, b: ((a + F.lit(1 << WIDE_BITS)) - b).bitwiseAND(F.lit(_WIDE_KEEP))),
    )


def text_of(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def signed_lanes(packed: Column) -> Column:
    """The signed sums of all lanes."""
    n = F.element_at(packed, LANES // 2 + 1)
    counts = F.flatten(
        F.transform(
            F.slice(packed, 1, LANES // 2),
            lambda x: F.array(x.bitwiseAND(F.lit(_MODULUS - 1)), F.shiftrightunsigned(x, 32)),
        )
    )
    return F.transform(counts, lambda c: 2 * c - n)


def _dot(one: Column, other: Column) -> Column:
    products = F.zip_with(one, other, lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def likeness(one: Column, other: Column, equal: Column) -> Column:
    """The cosine of two signed lane arrays, cut to 0..1; equal fingerprints have 1, an empty and another one 0."""
    norm = F.sqrt(_dot(one, one) * _dot(other, other))
    cosine = F.when(norm > 0, _dot(one, other) / norm).otherwise(F.lit(0.0))
    return F.when(equal, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _range_of(value: Column, cuts: list, first: int = 0) -> Column:
    """The number of cuts up to the value, by bisection."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value < F.lit(cuts[middle]), _range_of(value, cuts[:middle], first)).otherwise(
        _range_of(value, cuts[middle + 1 :], first + middle + 1)
    )


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Adds next_<column> for each carried column: its value in the next row by (id, text), after the last the first.

    Rows are grouped by ranges of ids, cut at quantiles; every range also gets the rows of the next range's smallest id.
    The only shuffle is by range. Rows without id come first and share a range.
    """
    n = 4 * partitions(docs.sparkSession)
    cuts = docs.approxQuantile("id", [k / n for k in range(1, n)], 1 / (4 * n)) if n > 1 else []
    cuts = sorted({int(c) for c in cuts})
    ranged = docs.withColumn("range", F.when(F.col("id").isNull(), F.lit(-1)).otherwise(_range_of(F.col("id"), cuts)))
    least = {r["range"]: r["id"] for r in ranged.groupBy("range").agg(F.min("id").alias("id")).collect()}
    order = sorted(least)
    follows = [(order[k - 1], least[r]) for k, r in enumerate(order)]  # at most n + 1 rows
    if not order:
        follows = []
    small = docs.sparkSession.createDataFrame(follows, "to_range int, first_id long")
    ghosts = docs.join(F.broadcast(small), docs["id"].eqNullSafe(small["first_id"]))
    ghosts = ghosts.select(*docs.columns, F.col("to_range").alias("range"), F.lit(True).alias("ghost"))
    both = ranged.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    window = Window.partitionBy("range").orderBy("ghost", "id", "text")
    shifted = both.select("*", *(F.lead(c).over(window).alias(f"next_{c}") for c in carried))
    return shifted.filter(~F.col("ghost")).drop("range", "ghost")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: (doc_id, text, packed, edited, edited_packed, next_packed).

    Null texts count as empty. The edited text is the text with its last half (rounded down, in code points) replaced by as
    many first code points of the next text. Rows that share an id follow each other by text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    rows = with_vector(rows, "text", "packed")
    rows = with_next(rows, ["text", "packed"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", 1, n - half), F.substring("next_text", 1, half))
    rows = rows.select(F.col("id").alias("doc_id"), "text", "packed", "next_packed", edited.alias("edited"))
    return with_vector(rows, "edited", "edited_packed")
