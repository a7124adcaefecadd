"""Operator 5, personal data: base expressions, then bootstrapped contextual extraction.

Base spans come from one expression per kind. They are the seeds of a bootstrap over the whole corpus: the words before an
identifier-like token (one with a digit or an @) are its patterns; patterns and token values form a graph of distinct
pairs. In each round a pattern gets the share of its values that are trusted, and a value the chance that at least one of
its confident patterns is right. Tokens outside the base spans that follow a confident pattern, and whose value is
confident, become spans of the kind `<kind>_like`.

DataFrame operations only. Positions come from cutting a text at marks set by `regexp_replace` and summing the lengths of
the pieces in a window per text. Only texts with a digit or an @ take part, and only lengths, matches and a few words
before them are shuffled. A pattern in a third of all rows is a hot join key, not a hot group: sums over it are
pre-aggregated, and joins on it can be split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checkmart.llm.tables import text_key, written

ROUNDS = 3
MIN_SUPPORT = 3.0
MIN_PATTERN = 0.6
MIN_VALUE = 0.8
#: Up to so many spans are sent to all tasks for redaction; more are joined by a shuffle.
BROADCAST_SPANS = 200_000

_OPEN, _CLOSE = "\x01", "\x02"
# The kinds' expressions. A match may begin where a run of its first class begins or where the last match
# ended, which is where the leftmost match begins anyway, and keeps long runs linear.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
KINDS = list(BASE)
_TOKEN = r"(?<!\S)(?=\S*[0-9@])\S++"
_ROW = ["id", "key"]


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut before and after every match: pieces at odd places are the matches."""
    marked = F.regexp_replace(text, f"({pattern})", f"{_OPEN}$1{_CLOSE}")
    return F.split(marked, f"[{_OPEN}{_CLOSE}]")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits, at most 19, have a valid check digit."""

    def weighed(i: Column) -> Column:
        digit = F.substring(digits, -(i + 1), F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda total, x: total + x) % 10 == 0


def _part_fits(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return F.when(F.length(short) <= 3, F.coalesce(short.try_cast("int"), F.lit(0)) <= 255).otherwise(F.lit(False))


def _accepted(kind: Column, value: Column) -> Column:
    """Whether a match of a kind is kept."""
    digits = _digits(value)
    n = F.length(digits)
    return (
        F.when(kind == "ip", F.forall(F.split(value, r"\."), _part_fits))
        .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(F.lit(True))
    )


def _last_words(text: Column) -> Column:
    """The last two words of a text, whole, and the white space around them, read backwards."""
    return F.regexp_extract(F.reverse(text), r"^\s*+(?:\S++\s*+){0,2}+", 0)


def _located(rows: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """(id, key, kind, start, end, value, before): every match of every expression, and the words before it, backwards."""
    marked = F.array(*(F.struct(F.lit(k).alias("kind"), _pieces(F.col("text"), p).alias("pieces")) for k, p in expressions.items()))
    cut = rows.select(*_ROW, F.explode(marked).alias("cut")).filter(F.size("cut.pieces") > 1)
    pieces = cut.select(*_ROW, F.col("cut.kind").alias("kind"), F.posexplode("cut.pieces").alias("i", "piece"))
    odd = F.col("i") % 2 == 1
    slim = pieces.select(
        *_ROW,
        "kind",
        "i",
        F.length("piece").alias("n"),
        F.when(odd, F.col("piece")).otherwise(_last_words(F.col("piece"))).alias("piece"),
    )
    by_text = Window.partitionBy(*_ROW, "kind").orderBy("i")
    placed = slim.withColumn("end", F.sum("n").over(by_text).cast("int")).withColumn(
        "before", F.lag("piece").over(by_text)
    )
    return placed.filter(odd).select(
        *_ROW, "kind", (F.col("end") - F.col("n")).alias("start"), "end", F.col("piece").alias("value"), "before"
    )


def _candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text) of the distinct texts that can hold anything, without the marks used here."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text_key(text).alias("key"), text.alias("text"))
    rows = rows.filter(F.col("text").rlike("[0-9@]"))
    return rows.withColumn("text", F.translate("text", _OPEN + _CLOSE, "\x03\x03"))


def _patterns(before: Column) -> Column:
    """The last word and the last two words before a token, in lower case and with digits as 0, from `_last_words`."""
    plain = F.regexp_replace(F.lower(before), "[0-9]", "0")
    found = [F.regexp_extract(plain, r"^\s*+(\S++)", 1), F.regexp_extract(plain, r"^\s*+(\S++\s++\S++)", 1)]
    return F.array_distinct(F.array_remove(F.array(*(F.reverse(f) for f in found)), ""))


def _overlapping(tokens: DataFrame, base: DataFrame) -> DataFrame:
    """Tokens with the kind of a base span that they touch (null: none), the first kind of several."""
    spans = base.groupBy(*(F.col(c).alias(f"b_{c}") for c in _ROW)).agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("spans")
    )
    joined = tokens.join(spans, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in _ROW], "left")
    touching = F.filter("spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    return joined.withColumn("seed", F.get(F.transform(touching, lambda s: s["kind"]), 0)).drop(
        "spans", *(f"b_{c}" for c in _ROW)
    )


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores patterns and values over the distinct `edges` (pattern, value, seed).

    Returns (pattern, kind, trust) of the confident patterns and (value, kind, trust) of the values they vouch for. A
    value's own kind is trusted fully. A pattern's trust is the trusted weight of its values over their number plus one;
    it counts from `MIN_SUPPORT` weight and a share of `MIN_PATTERN` on.
    """
    edges = written(edges, "edges")
    sizes = written(edges.groupBy("pattern").agg(F.count("*").alias("n")), "pattern_sizes")
    seeds = edges.filter("seed IS NOT NULL").select("value", F.col("seed").alias("kind")).distinct()
    values = seeds.withColumn("trust", F.lit(1.0))
    patterns = None
    for k in range(rounds):
        weight = edges.join(values, "value").groupBy("pattern", "kind").agg(F.sum("trust").alias("weight"))
        scored = weight.join(sizes, "pattern").withColumn("trust", F.col("weight") / (F.col("n") + 1))
        patterns = scored.filter((F.col("weight") >= MIN_SUPPORT) & (F.col("trust") >= MIN_PATTERN))
        patterns = written(patterns.select("pattern", "kind", "trust"), f"patterns{k}")
        vouched = (
            edges.filter("seed IS NULL")
            .join(patterns, "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("trust"))
        )
        values = written(seeds.withColumn("trust", F.lit(1.0)).unionByName(vouched), f"values{k}")
    return patterns, values


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(id, key, kind, start, end): the spans of the distinct (id, text) pairs of `docs`, base and found.

    Positions count code points, the end is exclusive. Null and empty texts have none. Spans of different kinds may
    overlap.
    """
    rows = _candidates(docs, id_col, text_col).dropDuplicates(_ROW)
    located = written(_located(rows, BASE | {"token": _TOKEN}), "located")
    base = located.filter(F.col("kind") != "token").filter(_accepted(F.col("kind"), F.col("value")))
    base = written(base.select(*_ROW, "kind", "start", "end"), "base")
    bare = F.regexp_replace("value", r"^[^\p{L}\p{N}@+]+|[^\p{L}\p{N}@]+$", "")
    lead = F.length(F.regexp_extract("value", r"^[^\p{L}\p{N}@+]+", 0))
    tokens = located.filter(F.col("kind") == "token").select(
        *_ROW,
        (F.col("start") + lead).alias("start"),
        (F.col("start") + lead + F.length(bare)).cast("int").alias("end"),
        bare.alias("value"),
        _patterns(F.col("before")).alias("patterns"),
    )
    marked = _overlapping(tokens.filter(F.col("value").rlike("[0-9@]")), base)
    marked = written(marked.withColumn("pattern", F.explode("patterns")).drop("patterns"), "tokens")
    patterns, values = bootstrap(marked.select("pattern", "value", "seed").distinct(), rounds)
    confident = values.filter(F.col("trust") >= MIN_VALUE).select("value", "kind")
    found = (
        marked.filter("seed IS NULL")
        .join(patterns.select("pattern", "kind"), "pattern")
        .join(confident, ["value", "kind"])
        .select(*_ROW, F.concat("kind", F.lit("_like")).alias("kind"), "start", "end")
        .distinct()
    )
    return base.unionByName(found)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs`: (doc_id, key, spans), spans (rank, start, end, kind) by kind as listed, then start.

    The kinds found by context come after the base kinds, in the same order. Repeated rows get the same spans; rows
    without id are rows like any other.
    """
    order = [*KINDS, *(f"{k}_like" for k in KINDS)]
    rank = reduce(lambda c, k: c.when(F.col("kind") == k, order.index(k)), order[1:], F.when(F.col("kind") == order[0], 0))
    spans = personal_spans(docs, id_col, text_col, rounds)
    listed = spans.groupBy(*(F.col(c).alias(f"s_{c}") for c in _ROW)).agg(
        F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind"))).alias("spans")
    )
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text_key(text).alias("key"))
    joined = rows.join(listed, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in _ROW], "left")
    empty = F.array().cast("array<struct<rank: int, start: int, end: int, kind: string>>")
    return joined.select(F.col("id").alias("doc_id"), "key", F.coalesce("spans", empty).alias("spans"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every span in the text replaced by its kind in brackets; other columns stay.

    Overlapping spans are replaced together, by the kind of the first. Null texts stay null.
    """
    spans = personal_spans(docs, id_col, text_col)
    by_start = Window.partitionBy(*_ROW).orderBy("start", F.desc("end"), "kind")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.coalesce((F.col("start") >= before).cast("int"), F.lit(1)))
    joined = opened.withColumn("part", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = joined.groupBy(*_ROW, "part").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", -F.col("end"))).alias("kind")
    )
    merged = written(merged, "redactions")
    cuts = merged.groupBy(*(F.col(c).alias(f"__{c}") for c in _ROW)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("__cuts")
    )
    if merged.limit(BROADCAST_SPANS + 1).count() <= BROADCAST_SPANS:
        cuts = F.broadcast(cuts)
    text = F.col(text_col)
    rows = docs.withColumn("__text_key", text_key(text))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    replaced = F.aggregate(
        "__cuts",
        start,
        lambda s, c: F.struct(
            F.concat(s["out"], F.substring(text, s["at"] + 1, c["start"] - s["at"]), F.lit("["), c["kind"], F.lit("]")).alias("out"),
            c["end"].alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    out = rows.join(cuts, same, "left").withColumn(text_col, F.when(F.col("__cuts").isNull(), text).otherwise(replaced))
    return out.select(*docs.columns)
