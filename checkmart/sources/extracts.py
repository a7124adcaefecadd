"""Extract files (CSV or Parquet) as canonical, typed check lines and plan rows."""

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checkmart.functions.numbers import to_number
from checkmart.functions.text import clean_text
from checkmart.functions.times import to_day, to_ts
from checkmart.schemas import RAW_PLAN
from checkmart.session import written
from checkmart.vocabulary import CHECK_SOURCE_SYSTEM, FACT_HEADERS, PLAN_HEADERS

ROW_NUMBER = "source_row_number"
# Share of unreadable dates from which on an extract is refused; a few summary lines are usual.
MOST_UNREADABLE = 0.1
DATES = ("accounting_date", "open_ts", "close_ts")
WHOLE = {"check_id": "bigint", "open_hour": "int", "close_hour": "int", "guest_count": "int"}


def read_table_file(spark: SparkSession, path: str, file_format: Literal["csv", "parquet"] = "csv") -> DataFrame:
    """An extract folder or file: Parquet, or CSV with a header line, every column as text."""
    if file_format == "parquet":
        return spark.read.parquet(path)
    # the header of every part file must agree with the first one
    return spark.read.csv(path, header=True, enforceSchema=False, multiLine=False)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Source headers to canonical names."""
    return df.withColumnsRenamed(dict(mapping))


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "extract") -> DataFrame:
    """`df` itself, or an error that lists the missing columns in order."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df


def drop_unkeyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.dropna(subset=list(keys))


class DateText(NamedTuple):
    """How dates are written in an extract, besides ISO: datetime patterns, and spreadsheet serials or not."""

    formats: Sequence[str] = ()
    serials: bool = False


def _filled(column: str) -> Column:
    cell = F.trim(F.col(column).cast("string"))
    return cell.isNotNull() & (cell != "")


def require_readable(df: DataFrame, columns: Sequence[str], dates: DateText, most: float, what: str) -> dict[str, int]:
    """Raise if more than the share `most` of the non-empty cells of a date column is unreadable. One pass over all.

    Returns the number of unreadable cells of every column that has some, and warns of them.
    """
    unreadable = {c: _filled(c) & to_ts(F.col(c), *dates).isNull() for c in columns}
    counts = df.agg(
        *[F.count_if(_filled(c)).alias(f"filled_{c}") for c in columns],
        *[F.count_if(unreadable[c]).alias(c) for c in columns],
    ).first()
    for c in columns:
        if counts[c] > most * counts[f"filled_{c}"]:
            raise ValueError(
                f"{what}: {counts[c]} of {counts[f'filled_{c}']} cells of {c} are no dates; pass their formats"
            )
    found = {c: counts[c] for c in columns if counts[c]}
    if found:
        warnings.warn(f"{what}: unreadable dates, taken as missing: {found}", stacklevel=3)
    return found


def coerce_fact(df: DataFrame, dates: DateText = DateText()) -> DataFrame:
    """Text columns of a fact extract in their canonical types; unreadable values become NULL.

    Whole-number columns fail the query on a fraction.
    """
    converted = {
        "accounting_date": to_day(F.col("accounting_date"), *dates),
        **{c: to_ts(F.col(c), *dates) for c in ("open_ts", "close_ts")},
        **{c: to_number(F.col(c), as_int=True).cast(t) for c, t in WHOLE.items()},
        **{c: to_number(F.col(c)) for c in ("qty", "amount_discount_rub")},
        **{c: clean_text(F.col(c)) for c in ("dish_name", "dish_category", "order_type")},
    }
    return df.withColumns(converted)


def with_lineage(
    df: DataFrame, period: str, sheet: str, file: str | None = None, system: str = CHECK_SOURCE_SYSTEM
) -> DataFrame:
    """Lineage columns. The row number must already be a column: files carry no order that survives a split."""
    return require_columns(df, [ROW_NUMBER], f"period {period}").withColumns(
        {
            "source_system": F.lit(system),
            "source_file": F.lit(file) if file else F.col("_metadata.file_name"),
            "source_sheet": F.lit(sheet),
            "source_period": F.lit(period),
            ROW_NUMBER: F.col(ROW_NUMBER).cast("bigint"),
        }
    )


def read_fact_extract(
    spark: SparkSession,
    path: str,
    period: str,
    sheet: str | None = None,
    headers: Mapping[str, str] = FACT_HEADERS,
    file_format: Literal["csv", "parquet"] = "csv",
    dates: DateText = DateText(),
    most_unreadable: float = MOST_UNREADABLE,
) -> DataFrame:
    """One period's check lines: canonical columns, coerced, rows without date or check dropped, with lineage.

    Fails if more than the share `most_unreadable` of the filled cells of a date column (accounting, opening, closing)
    cannot be read, and warns of fewer. `split_fact_extract` keeps every refused line with its reasons instead.
    """
    renamed, lineage = _text_lines(spark, path, period, sheet, headers, file_format)
    require_readable(renamed, DATES, dates, most_unreadable, path)
    typed = coerce_fact(renamed.select(*headers.values(), *lineage), dates)
    return drop_unkeyed(typed, ["accounting_date", "check_id"])


def _text_lines(
    spark: SparkSession, path: str, period: str, sheet: str | None, headers: Mapping[str, str], file_format: str
) -> tuple[DataFrame, list[str]]:
    extract = with_lineage(read_table_file(spark, path, file_format), period, sheet or period)
    renamed = require_columns(rename_columns(extract, headers), list(headers.values()), path)
    return renamed, ["source_system", "source_file", "source_sheet", "source_period", ROW_NUMBER]


def refusals(dates: DateText = DateText()) -> Column:
    """Why a line of text cells cannot be loaded, as an array; empty for a good line."""
    reasons = []
    for c in DATES:
        reasons.append(F.when(_filled(c) & to_ts(F.col(c), *dates).isNull(), F.lit(f"{c} is no date")))
    for c in WHOLE:
        value = to_number(F.col(c))
        reasons.append(F.when(value != F.floor(value), F.lit(f"{c} is no whole number")))
    # a key that is there but unreadable counts as missing
    reasons.append(F.when(~F.coalesce(_filled("accounting_date"), F.lit(False)), F.lit("accounting_date is missing")))
    reasons.append(F.when(to_number(F.col("check_id")).isNull(), F.lit("check_id is missing")))
    return F.array_compact(F.array(*reasons))


class FactExtract(NamedTuple):
    """The lines of an extract that can be loaded, and those that cannot: their cells as text, with the reasons."""

    lines: DataFrame
    refused: DataFrame


def split_fact_extract(
    spark: SparkSession,
    path: str,
    period: str,
    sheet: str | None = None,
    headers: Mapping[str, str] = FACT_HEADERS,
    file_format: Literal["csv", "parquet"] = "csv",
    dates: DateText = DateText(),
) -> FactExtract:
    """One period's check lines and the refused ones; every line of the extract is in exactly one of the two.

    Nothing stops the load: a line with an unreadable date, a fraction in a whole-number cell, or without date or check is
    refused with its reasons, which a caller stores and counts.
    """
    renamed, lineage = _text_lines(spark, path, period, sheet, headers, file_format)
    judged = renamed.select(*headers.values(), *lineage, refusals(dates).alias("reasons"))
    good = judged.where(F.size("reasons") == 0).drop("reasons")
    refused = judged.where(F.size("reasons") > 0).withColumn("reasons", F.array_join("reasons", ", "))
    return FactExtract(coerce_fact(good, dates), refused)


def plan_positions(
    cells: Sequence[str | None], headers: Mapping[tuple[str, int], str] = PLAN_HEADERS
) -> dict[str, int]:
    """Position of every plan column: headers repeat, so a column is bound by header and occurrence."""
    found: dict[tuple[str, int], int] = {}
    seen: dict[str, int] = {}
    for position, cell in enumerate(cells):
        name = (cell or "").strip()
        found[(name, seen.get(name, 0))] = position
        seen[name] = seen.get(name, 0) + 1
    missing = sorted(f"{name} #{nth + 1}" for name, nth in headers if (name, nth) not in found)
    if missing:
        raise ValueError(f"plan extract lacks the columns {missing}")
    return {column: found[key] for key, column in headers.items()}


def read_plan_extract(
    spark: SparkSession,
    path: str,
    sheet: str,
    headers: Mapping[tuple[str, int], str] = PLAN_HEADERS,
    dates: DateText = DateText(),
    most_unreadable: float = MOST_UNREADABLE,
) -> DataFrame:
    """The daily plan from CSV whose first line holds group headers and whose second line holds column headers.

    The header line is found by its date header, and both header lines drop out because they carry no date. Fails if
    more than the share `most_unreadable` of the other dates that are filled in cannot be read.
    """
    cells = spark.read.csv(path, header=False)
    date_header = next(name for (name, _), column in headers.items() if column == "plan_date")
    is_header = F.exists(F.array(*[F.trim(F.col(c)) for c in cells.columns]), lambda cell: cell == date_header)
    header = cells.where(is_header).first()
    if header is None:
        raise ValueError(f"plan extract {path} has no header line with {date_header!r}")
    positions = plan_positions(list(header), headers)
    numbers = [name for name in positions if name != "plan_date"]

    def cell(name: str):
        return F.col(cells.columns[positions[name]])

    plan_days = cells.where(~is_header).select(cell("plan_date").alias("plan_date"))
    require_readable(plan_days, ["plan_date"], dates, most_unreadable, path)
    typed = cells.select(
        to_day(cell("plan_date"), *dates).alias("plan_date"),
        *[to_number(cell(name)).alias(name) for name in numbers],
        F.col("_metadata.file_name").alias("source_file"),
        F.lit(sheet).alias("source_sheet"),
        F.localtimestamp().alias("loaded_at"),
    )
    return drop_unkeyed(typed, ["plan_date"]).select(*RAW_PLAN.names)


def union_periods(periods: Sequence[DataFrame]) -> DataFrame:
    """All periods as one table, matched by column name."""
    return reduce(DataFrame.unionByName, periods)


def assign_row_ids(df: DataFrame, order: Sequence[str], start: int = 1, column: str = "source_row_id") -> DataFrame:
    """Dense ids from `start` in the order of the given columns, which must identify a row.

    One range shuffle puts the rows into ordered partitions. The sorted result is stored, because a recomputed range
    shuffle may cut elsewhere; then every partition's rows are numbered from the count of the partitions before it.
    Only those counts, one row per partition, are broadcast.
    """
    place = "_place"
    stored = written(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        # high bits: partition number; low 33 bits: position inside the partition
        .withColumn(place, F.monotonically_increasing_id()),
        "row-order",
    )
    part = F.shiftright(place, 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_size")).collect()
    before, offsets = start, []
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before))
        before += row["_size"]
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _first bigint")
    position = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select((F.col("_first") + position).alias(column), *df.columns)
    )


def period_stats(df: DataFrame) -> DataFrame:
    """Rows and distinct checks of every period, in period order."""
    return (
        df.groupBy("source_period")
        .agg(F.count("*").alias("rows_count"), F.count_distinct("check_id").alias("checks_count"))
        .orderBy("source_period")
    )


def build_source(extracts: Sequence[DataFrame], periods_order: Sequence[str]) -> DataFrame:
    """All extracts as the numbered source table: ids run through the periods in list order, then row order."""
    all_lines = union_periods(extracts)
    rank = F.array_position(F.lit(list(periods_order)), F.col("source_period"))
    numbered = assign_row_ids(all_lines.withColumn("_period_rank", rank), ["_period_rank", ROW_NUMBER])
    return numbered.drop("_period_rank").withColumn("source_loaded_at", F.localtimestamp())


def _line_key() -> Column:
    """One value for a line's place in its period and its content."""
    place = ["source_system", "source_period", ROW_NUMBER]
    return F.sha2(F.to_json(F.struct(*place, *FACT_HEADERS.values())), 256)


def changed_source(
    stored: DataFrame, extracts: Sequence[DataFrame], periods_order: Sequence[str], first_id: int
) -> tuple[DataFrame, DataFrame]:
    """The numbered source after extracts were sent again, and (source_row_id, check_id) of lines it no longer holds.

    A line is the same if its place (period and row number) and its content are; equal lines at one place are told apart
    by their number. Lines that are the same keep id and load time, the others get ids from `first_id` in period order.
    """
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0)))
    old = stored.withColumn("_key", _line_key()).withColumn("_nth", nth)
    old = old.select("_key", "_nth", "source_row_id", "source_loaded_at", "check_id")
    lines = union_periods(extracts)
    new = lines.withColumn("_key", _line_key()).withColumn("_nth", nth)
    matched = written(new.join(old.drop("check_id"), ["_key", "_nth"], "left"), "matched-lines")
    same = F.col("source_row_id").isNotNull()
    names = ["source_row_id", *lines.columns, "source_loaded_at"]
    rank = F.array_position(F.lit(list(periods_order)), F.col("source_period"))
    fresh = matched.where(~same).select(*lines.columns, rank.alias("_period_rank"))
    fresh = assign_row_ids(fresh, ["_period_rank", ROW_NUMBER], first_id).withColumn("source_loaded_at", F.localtimestamp())
    gone = old.join(matched.where(same).select("source_row_id"), "source_row_id", "left_anti")
    return matched.where(same).select(*names).unionByName(fresh.select(*names)), gone.select("source_row_id", "check_id")
