"""Tables stored as runs: sorted additions, rows that a later run takes back, and merges by size.

A run is one folder: its rows, and the keys whose rows in earlier runs no longer count. Rows carry the number of the run that
brought them, so merged runs keep their order and a reader needs no more than `rows` without those taken back later. After
every addition the last runs are merged as long as the run before them is no larger than all of them together: sizes then
halve from run to run, there are as many runs as the logarithm of the rows, and a row is written that many times at most.

Rows are sorted, so a filter on ranges of the sort columns reads the pages it needs. `covering_ranges` turns any set of ids
into a bounded number of such ranges.
"""

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checkmart.sources.tables import Parts, version_folder

RUN = "run_no"
# Ranges that a filter on scattered ids may have, and cells of the id space looked at to find them.
MOST_RANGES = 64
CELLS = 4096
# Rows of a Parquet page: the least that a filter on the sort columns reads.
PAGE_ROWS = 4096

Ranges = list[tuple[int, int]]


class RunTable(NamedTuple):
    """A table of runs: rows are taken back by `key` and sorted by `order`; `gone` is the schema of what is taken back."""

    name: str
    schema: T.StructType
    key: str
    order: Sequence[str]
    gone: T.StructType
    # whether the keys taken back are remembered after their rows have been merged away
    remember: bool = False


class Run(NamedTuple):
    """First and last addition in the run, stored rows, stored keys taken back, and rows merged away so far."""

    first: int
    last: int
    rows: int
    gone: int
    merged: int
    folder: str

    @property
    def part(self) -> str:
        return f"{self.first:09d}-{self.last:09d}-{self.rows}-{self.gone}-{self.merged}"


def runs_of(parts: Parts) -> list[Run]:
    """The runs of a table, oldest first."""
    return sorted(Run(*map(int, part.split("-")), folder) for part, folder in parts.items())


def next_number(parts: Parts) -> int:
    """The number of the next addition."""
    runs = runs_of(parts)
    return runs[-1].last + 1 if runs else 1


def live_rows(parts: Parts) -> int:
    """Stored rows without those taken back, for tables whose keys name one row each."""
    runs = runs_of(parts)
    return sum(r.rows for r in runs) - sum(r.gone for r in runs) + sum(r.merged for r in runs)


def _with_run(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RUN, T.LongType())])


def _read(spark: SparkSession, root: str, runs: Iterable[Run], kind: str, schema: T.StructType) -> DataFrame:
    folders = [f"{root}/{run.folder}/{kind}" for run in runs if kind == "rows" or run.gone]
    if not folders:
        return spark.createDataFrame([], _with_run(schema))
    return spark.read.schema(_with_run(schema)).parquet(*folders)


def read_stored(spark: SparkSession, root: str, table: RunTable, parts: Parts) -> DataFrame:
    """All stored rows with their run, also those taken back."""
    return _read(spark, root, runs_of(parts), "rows", table.schema)


def read_gone(spark: SparkSession, root: str, table: RunTable, parts: Parts, after: int = 0) -> DataFrame:
    """Keys taken back by additions after a number, with that number."""
    runs = [run for run in runs_of(parts) if run.last > after]
    return _read(spark, root, runs, "gone", table.gone).where(F.col(RUN) > after)


def _without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    taken = gone.select(F.col(key).alias("_key"), F.col(RUN).alias("_by"))
    return rows.join(taken, rows[key].eqNullSafe(F.col("_key")) & (rows[RUN] < F.col("_by")), "left_anti")


def read_runs(
    spark: SparkSession,
    root: str,
    table: RunTable,
    parts: Parts,
    where: Column | None = None,
    after: int = 0,
    with_run: bool = False,
) -> DataFrame:
    """The rows that count: all, or those of additions after a number and those that a filter on the scan leaves."""
    runs = runs_of(parts)
    rows = _read(spark, root, [run for run in runs if run.last > after], "rows", table.schema)
    if after:
        rows = rows.where(F.col(RUN) > after)
    if where is not None:
        rows = rows.where(where)
    # only what came after the first of the rows can take them back
    newer = [run for run in runs if run.last > after and run.gone]
    if newer:
        rows = _without(rows, _read(spark, root, newer, "gone", table.gone), table.key)
    return rows if with_run else rows.drop(RUN)


def _count(spark: SparkSession, path: str) -> int:
    # answered from the footers of the files just written
    return spark.read.parquet(path).count()


def _write(df: DataFrame, path: str) -> None:
    df.write.option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)


def stage_run(
    spark: SparkSession,
    root: str,
    table: RunTable,
    number: int,
    rows: DataFrame,
    gone: DataFrame | None = None,
    sorted_input: bool = False,
) -> Run:
    """Write an addition to a new, unpublished folder. With `sorted_input` rows stay in the partitions they come in."""
    folder = version_folder(table.name)
    numbered = rows.select(*table.schema.names, F.lit(number).cast("bigint").alias(RUN))
    if not sorted_input:
        numbered = numbered.repartitionByRange(*table.order)
    _write(numbered.sortWithinPartitions(*table.order), f"{root}/{folder}/rows")
    n_gone = 0
    if gone is not None:
        _write(gone.select(*table.gone.names, F.lit(number).cast("bigint").alias(RUN)), f"{root}/{folder}/gone")
        n_gone = _count(spark, f"{root}/{folder}/gone")
    return Run(number, number, _count(spark, f"{root}/{folder}/rows"), n_gone, 0, folder)


def due(runs: Sequence[Run]) -> list[Run]:
    """The last runs that are to be merged: the run before them must be larger than all of them together."""
    total, begin = 0, len(runs)
    while begin and (begin == len(runs) or runs[begin - 1].rows + runs[begin - 1].gone <= total):
        begin -= 1
        total += runs[begin].rows + runs[begin].gone
    return list(runs[begin:]) if len(runs) - begin > 1 else []


def merged(spark: SparkSession, root: str, table: RunTable, parts: Parts) -> tuple[Run, list[Run]] | None:
    """Stage the merge that is due, if any: the new run and those that it replaces."""
    runs = runs_of(parts)
    old = due(runs)
    if not old:
        return None
    chosen = {run.part: run.folder for run in old}
    folder = version_folder(table.name)
    rows = read_runs(spark, root, table, chosen, with_run=True)
    _write(rows.repartitionByRange(*table.order).sortWithinPartitions(*table.order), f"{root}/{folder}/rows")
    n_rows = _count(spark, f"{root}/{folder}/rows")
    n_gone = 0
    # without an older run nothing is left to take back
    if any(run.gone for run in old) and (table.remember or old[0] != runs[0]):
        _write(_read(spark, root, old, "gone", table.gone).coalesce(1 + len(old)), f"{root}/{folder}/gone")
        n_gone = sum(run.gone for run in old)
    away = sum(run.rows for run in old) - n_rows + sum(run.merged for run in old)
    return Run(old[0].first, old[-1].last, n_rows, n_gone, away, folder), old


def merged_ranges(ranges: Iterable[tuple[int, int]], most: int = MOST_RANGES) -> Ranges:
    """Ranges that cover the given ones, adjacent ones joined, at most `most`: the closest are joined first."""
    out: Ranges = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    if len(out) > most:
        spaces = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1], reverse=True)
        starts = [0, *sorted(spaces[: most - 1]), len(out)]
        out = [(out[a][0], out[b - 1][1]) for a, b in zip(starts, starts[1:], strict=False)]
    return out


def covering_ranges(ids: DataFrame, column: str, most: int = MOST_RANGES, cells: int = CELLS) -> Ranges:
    """At most `most` ranges that contain every id of a column. The driver gets one row per occupied cell of the id space."""
    low, high = ids.agg(F.min(column), F.max(column)).first()
    if low is None:
        return []
    width = (high - low) // cells + 1
    cell = F.expr(f"(CAST({column} AS DECIMAL(20,0)) - CAST({low} AS DECIMAL(20,0))) div {width}")
    found = ids.where(F.col(column).isNotNull()).groupBy(cell.alias("cell")).agg(F.min(column), F.max(column)).collect()
    return merged_ranges([(row[1], row[2]) for row in found], most)


def within(column: str, ranges: Iterable[tuple]) -> Column:
    """Whether a column lies in one of some ranges."""
    out = F.lit(False)
    for low, high in ranges:
        out = out | F.col(column).between(F.lit(low), F.lit(high))
    return out
