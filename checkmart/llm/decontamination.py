"""Operator 8, benchmark decontamination: a positional inverted index of the corpus, searched for benchmark windows.

An item occurs where `WIDTH` of its consecutive words stand in a text (all its words, if it has fewer). DataFrame
operations only:

1. Count the benchmark's words over the whole corpus.
2. For every window of an item take its two rarest words as anchors and store the corpus postings (term, row, position)
   of all anchors. The posting of the end mark holds the length of a text.
3. Shift the postings of the rarest anchors by their place in the item and intersect them with those of the second ones:
   the result is places (row, item, shift) where the item may lie.
4. For the rows left, intersect the places with the postings of all words of the item; runs of `WIDTH` or more
   consecutive words are matches.

The benchmark's word list is broadcast while it has at most `BROADCAST_ROWS` rows, by count; beyond that all joins are
shuffled. Text is never shuffled while the rows left are within that bound either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checkmart.llm.tables import text_key, written

WIDTH = 10
BROADCAST_ROWS = 200_000
#: Stands for the end of a text in the index; it is never a word.
END = " "
_ROW = ["id", "key"]


def words(text: Column) -> Column:
    """Lower-cases A-Z and splits into `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`; null texts have no words."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def small(df: DataFrame) -> DataFrame:
    """`df`, a stored table, marked for broadcast if it has at most `BROADCAST_ROWS` rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), text_key(text).alias("key"), text.alias("text"))


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, n, p, term): every word of every item. `item` tells rows apart that share an id."""
    text = F.col(text_col)
    rows = items.select(
        F.xxhash64(F.col(id_col), text).alias("item"), F.col(id_col).alias("item_id"), words(text).alias("ws")
    ).dropDuplicates(["item"])
    split = rows.select("item", "item_id", F.size("ws").alias("n"), F.posexplode("ws").alias("p", "term"))
    return written(split, "items")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of `terms` (term) stands in the corpus; terms that never do are left out."""
    found = docs.select(F.explode(words(F.col("text"))).alias("term")).join(terms, "term")
    return written(found.groupBy("term").agg(F.count("*").alias("df")), "terms")


def anchors(wanted: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """(item, p1, term1, p2, term2): the two rarest words of each window all of whose words occur in the corpus."""
    last_start = F.greatest(F.col("n") - width, F.lit(0))
    starts = F.sequence(F.greatest(F.col("p") - width + 1, F.lit(0)), F.least("p", last_start))
    inside = wanted.join(counts, "term", "left").withColumn("start", F.explode(starts))
    by_window = Window.partitionBy("item", "start")
    ranked = inside.withColumn("absent", F.max(F.col("df").isNull()).over(by_window)).withColumn(
        "rank", F.row_number().over(by_window.orderBy("df", "p"))
    )
    pairs = (
        ranked.filter("rank <= 2 AND NOT absent")
        .groupBy("item", "start")
        .agg(F.min_by(F.struct("p", "term"), "rank").alias("a"), F.max_by(F.struct("p", "term"), "rank").alias("b"))
    )
    found = pairs.select(
        "item",
        F.col("a.p").alias("p1"),
        F.col("a.term").alias("term1"),
        F.col("b.p").alias("p2"),
        F.col("b.term").alias("term2"),
    )
    return written(found.distinct(), "anchors")


def postings(docs: DataFrame, terms: DataFrame, end_marks: bool = True) -> DataFrame:
    """(id, key, position, term) of the terms; with `end_marks` every text ends with `END`."""
    marked = words(F.col("text"))
    if end_marks:
        marked = F.concat(marked, F.array(F.lit(END)))
    return docs.select(*_ROW, F.posexplode(marked).alias("position", "term")).join(terms, "term")


def _aligned(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join of rows; rows without id match each other too."""
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    return left.join(renamed, same, how).drop(*(f"__{c}" for c in on))


def occurrences(docs: DataFrame, items: DataFrame, width: int = WIDTH, proximity: int = 0) -> tuple[DataFrame, DataFrame]:
    """(matches, lengths) of `docs` (id, key, text) and `items` from `item_words`.

    matches: (id, key, item, item_id, first, last), the maximal runs of words that a text shares with an item, of at
    least `width` words or the whole item; positions count words from 0. lengths: (id, key, n_words), one row per
    distinct row. With `proximity` above 0, matches are instead the rows where the two rarest words of a window stand at
    most so many words away from their distance in the item, first and last being the places of these words.
    """
    vocabulary = small(written(items.select("term").distinct(), "vocabulary"))
    counts = term_counts(docs, vocabulary)
    pairs = anchors(items, counts, width)
    end_mark = pairs.sparkSession.createDataFrame([(END,)], "term string")
    sought = pairs.select(F.col("term1").alias("term")).union(pairs.select("term2")).union(end_mark).distinct()
    index = written(postings(docs, small(written(sought, "sought"))).distinct(), "index")
    lengths = index.filter(F.col("term") == END).select(*_ROW, F.col("position").alias("n_words"))
    first = index.join(small(pairs), F.col("term") == F.col("term1")).select(
        *_ROW, "item", (F.col("position") - F.col("p1")).alias("shift"), "p1", "p2", F.col("term2").alias("term")
    )
    if proximity:
        second = index.select(*_ROW, "term", F.col("position").alias("at"))
        near = _aligned(first, second, [*_ROW, "term"]).filter(
            F.abs(F.col("at") - F.col("shift") - F.col("p2")) <= proximity
        )
        here = F.col("shift") + F.col("p1")
        places = near.select(*_ROW, "item", F.least(here, "at").alias("first"), F.greatest(here, "at").alias("last"))
        return places.distinct().join(items.select("item", "item_id").distinct(), "item"), lengths
    first = first.withColumn("position", F.col("shift") + F.col("p2"))
    places = _aligned(first, index, [*_ROW, "term", "position"]).select(*_ROW, "item", "shift").distinct()
    places = written(places, "places")
    left = written(places.select(*_ROW).distinct(), "left")
    texts = _aligned(docs, small(left), _ROW)
    full = postings(texts, vocabulary, end_marks=False).distinct()
    expected = places.join(items, "item").withColumn("position", F.col("shift") + F.col("p"))
    found = _aligned(expected, full, [*_ROW, "position", "term"])
    place = Window.partitionBy(*_ROW, "item", "shift").orderBy("p")
    runs = (
        found.withColumn("run", F.col("p") - F.row_number().over(place))
        .groupBy(*_ROW, "item", "shift", "run")
        .agg(
            F.first("item_id").alias("item_id"),
            F.min("position").alias("first"),
            F.max("position").alias("last"),
            F.count("*").alias("k"),
            F.first("n").alias("n"),
        )
    )
    matches = runs.filter(F.col("k") >= F.least(F.lit(width), "n"))
    return matches.select(*_ROW, "item", "item_id", "first", "last"), lengths


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """One row per row of `docs`: (doc_id, key, n_words, n_hit, item_ids), item_ids ascending as strings.

    n_hit counts the words inside any match. Null and empty texts have no words; items without words never occur; an item
    without id marks words but is not listed. Rows without id and repeated rows get their own result.
    """
    rows = _rows(docs, id_col, text_col)
    matches, lengths = occurrences(rows, item_words(items, item_id_col, item_text_col), width)
    matches = written(matches, "matches")
    covered = matches.select(*_ROW, F.explode(F.sequence("first", "last")).alias("position")).distinct()
    hits = covered.groupBy(*_ROW).agg(F.count("*").alias("n_hit"))
    named = matches.select(*_ROW, F.col("item_id").cast("string").alias("item_id")).dropna(subset=["item_id"]).distinct()
    listed = named.groupBy(*_ROW).agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    report = lengths
    for extra in (hits, listed):
        report = _aligned(report, extra, _ROW, "left")
    keys = rows.select(*_ROW)
    result = _aligned(keys, report, _ROW)
    return result.select(
        F.col("id").alias("doc_id"),
        "key",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
