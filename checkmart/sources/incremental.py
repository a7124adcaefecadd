"""Incremental loading by high-water mark and unseen ranges of ids.

The raw table is stored as runs, one per load, merged by size. A load publishes its run together with the new mark: a run
that dies before has loaded nothing, one that is repeated afterwards finds nothing that was not loaded.
"""

from collections.abc import Collection
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.schemas import CHECKPOINTS, RAW_CHECKS, SOURCE_CHECKS, UNSEEN_RANGES, WITHDRAWN
from checkmart.session import scratch, written
from checkmart.sources.runs import (
    MOST_RANGES,
    RUN,
    Ranges,
    RunTable,
    covering_ranges,
    live_rows,
    merged,
    merged_ranges,
    next_number,
    read_gone,
    read_runs,
    read_stored,
    stage_run,
    within,
)
from checkmart.sources.tables import (
    Parts,
    State,
    current_state,
    discard,
    publish,
    read_snapshot,
    retried,
    stage_snapshot,
)
from checkmart.vocabulary import CHECK_SOURCE_NAME

RAW_CHECKS_TABLE = "raw/stg_raw_checks"
CHECKPOINT_TABLE = "raw/etl_checkpoints"
UNSEEN_TABLE = "raw/unseen_ranges"
RAW = RunTable(RAW_CHECKS_TABLE, RAW_CHECKS, "source_row_id", ["source_row_id"], WITHDRAWN, remember=True)


def read_source(
    spark: SparkSession,
    location: str,
    kind: Literal["path", "table", "published"] = "path",
    root: str | None = None,
) -> DataFrame:
    """The numbered source: a plain Parquet path, a catalog table, or a published table under a root."""
    if kind == "published":
        if root is None:
            raise ValueError("a published source needs its root")
        return read_snapshot(spark, root, location, SOURCE_CHECKS)
    if kind == "table":
        return spark.table(location)
    return spark.read.schema(SOURCE_CHECKS).parquet(location)


def read_watermark(checkpoints: DataFrame, name: str) -> DataFrame:
    """Last loaded row id of a source, zero if there is none, as one row."""
    return checkpoints.where(F.col("source_name") == name).agg(
        F.coalesce(F.max("watermark"), F.lit(0).cast("bigint")).alias("watermark")
    )


def source_watermark(source: DataFrame) -> DataFrame:
    """Highest row id of the source, zero if it is empty, as one row."""
    return source.agg(F.coalesce(F.max("source_row_id"), F.lit(0).cast("bigint")).alias("watermark"))


def incremental_extract(source: DataFrame, watermark: int, upto: int | None = None) -> DataFrame:
    """Source rows above the watermark, stamped with the extraction time.

    With `upto`, rows above that mark wait for the next run. A run reads the upper mark first and passes it here, so
    rows that arrive meanwhile are neither skipped nor loaded twice.
    """
    rows = source.where(F.col("source_row_id") > watermark)
    if upto is not None:
        rows = rows.where(F.col("source_row_id") <= upto)
    return rows.withColumn("extracted_at", F.localtimestamp())


def upsert_checkpoint(checkpoints: DataFrame, updates: DataFrame) -> DataFrame:
    """Checkpoints with the updates merged in by source name. A watermark never moves backwards."""
    old = checkpoints.select(
        "source_name", F.col("watermark").alias("_old_mark"), F.col("updated_at").alias("_old_time")
    )
    merged = old.join(updates, "source_name", "full_outer")
    return merged.select(
        "source_name",
        F.greatest("_old_mark", "watermark").alias("watermark"),
        F.coalesce("updated_at", "_old_time").alias("updated_at"),
    )


def raw_parts(state: State) -> Parts:
    """The runs of the raw table."""
    return state.tables.get(RAW_CHECKS_TABLE, {})


def read_raw_checks(
    spark: SparkSession, root: str, state: State | None = None, where: Column | None = None, after_load: int = 0
) -> DataFrame:
    """Raw rows without withdrawn ones: all, those of later loads, or those that a filter on ranges of ids leaves."""
    return read_runs(spark, root, RAW, raw_parts(state or current_state(spark, root)), where, after_load)


def read_withdrawn(spark: SparkSession, root: str, state: State, after_load: int = 0) -> DataFrame:
    """(source_row_id, check_id) of raw rows withdrawn by later loads."""
    return read_gone(spark, root, RAW, raw_parts(state), after_load).drop(RUN)


def last_load(state: State) -> int:
    """The number of the last load; zero before the first."""
    return next_number(raw_parts(state)) - 1


def stored_watermark(spark: SparkSession, root: str, name: str, state: State | None = None) -> int:
    """The stored mark of a source under the root."""
    checkpoints = read_snapshot(spark, root, CHECKPOINT_TABLE, CHECKPOINTS, state)
    return read_watermark(checkpoints, name).first()["watermark"]


def advanced_checkpoints(
    spark: SparkSession, root: str, state: State, name: str, mark: int, forget: Collection[str] = ()
) -> DataFrame:
    """The checkpoints of a state with the mark of one source merged in; marks in `forget` go first, so they may fall."""
    checkpoints = read_snapshot(spark, root, CHECKPOINT_TABLE, CHECKPOINTS, state)
    if forget:
        checkpoints = checkpoints.where(~F.col("source_name").isin(*forget))
    now = spark.range(1).select(
        F.lit(name).alias("source_name"),
        F.lit(mark).cast("bigint").alias("watermark"),
        F.localtimestamp().alias("updated_at"),
    )
    return upsert_checkpoint(checkpoints, now)


def unseen_ranges(ids: DataFrame, pieces: Ranges, most: int = MOST_RANGES, cells: int = 1024) -> Ranges:
    """Ranges that contain every id of the pieces that is not among `ids`; at most `most`, so they may hold seen ids too.

    Every piece is looked at in cells; the driver gets the count and the bounds of each cell.
    """
    if not pieces:
        return []
    widths = [(high - low) // cells + 1 for low, high in pieces]
    # the last column of a piece's cells is the id itself, counted once
    place = F.coalesce(
        *[
            F.when(
                F.col("source_row_id").between(low, high),
                F.struct(F.lit(i).alias("piece"), F.expr(f"(source_row_id - {low}L) div {width}").alias("cell")),
            )
            for i, ((low, high), width) in enumerate(zip(pieces, widths, strict=True))
        ]
    )
    found = (
        ids.select("source_row_id", place.alias("at"))
        .where(F.col("at").isNotNull())
        .groupBy("at.piece", "at.cell")
        .agg(F.count_distinct("source_row_id"), F.min("source_row_id"), F.max("source_row_id"))
        .collect()
    )
    seen = {(row[0], row[1]): row[2:] for row in found}
    unseen = []
    for i, ((low, high), width) in enumerate(zip(pieces, widths, strict=True)):
        for cell, begin in enumerate(range(low, high + 1, width)):
            end = min(begin + width - 1, high)
            count, first, last = seen.get((i, cell), (0, 0, 0))
            if not count or count != last - first + 1:
                unseen.append((begin, end))
            else:
                unseen += [(a, b) for a, b in ((begin, first - 1), (last + 1, end)) if a <= b]
    return merged_ranges(unseen, most)


def stored_unseen(spark: SparkSession, root: str, name: str, state: State) -> Ranges:
    """Ranges at or below the mark of a source that may hold ids which were never loaded."""
    rows = read_snapshot(spark, root, UNSEEN_TABLE, UNSEEN_RANGES, state).where(F.col("source_name") == name).collect()
    return sorted((row["first_id"], row["last_id"]) for row in rows)


def _stage_unseen(spark: SparkSession, root: str, state: State, name: str, ranges: Ranges) -> Parts:
    others = read_snapshot(spark, root, UNSEEN_TABLE, UNSEEN_RANGES, state).where(F.col("source_name") != name)
    own = spark.createDataFrame([(name, *r) for r in ranges], UNSEEN_RANGES)
    return stage_snapshot(others.unionByName(own).coalesce(1), root, UNSEEN_TABLE)


def not_loaded(
    spark: SparkSession, root: str, state: State, source: DataFrame, low: int, high: int, unseen: Ranges
) -> DataFrame:
    """Source rows above the mark and those below it whose ids were never loaded.

    Both are filters on the scan of the source. Below the mark only the unseen ranges are read; as they may hold loaded
    ids too, those are left out by the ids stored in the same ranges.
    """
    rows = incremental_extract(source, low, high)
    if unseen:
        parts = raw_parts(state)
        late = source.where(within("source_row_id", unseen)).withColumn("extracted_at", F.localtimestamp())
        stored = read_stored(spark, root, RAW, parts).where(within("source_row_id", unseen)).select("source_row_id")
        taken = read_gone(spark, root, RAW, parts).select("source_row_id")
        rows = rows.unionByName(late.join(stored.union(taken), "source_row_id", "left_anti").select(*rows.columns))
    return rows.select(*RAW_CHECKS.names)


def run_extract(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    full_refresh: bool = False,
    name: str = CHECK_SOURCE_NAME,
    dependants: Collection[str] = (),
    withdrawn: DataFrame | None = None,
) -> dict[str, int]:
    """Copy the source rows that were never loaded into the raw table and advance the mark, in one step.

    Rows above the mark are new; below it, ranges of ids that may be missing are kept with the mark, so rows that arrive
    in any order are loaded once each. `withdrawn` holds (source_row_id, check_id) of lines that the source no longer
    contains; their raw rows are taken back. Returns the previous and the new mark and the numbers of rows loaded and
    stored. With `full_refresh` the raw table is replaced from the first row, and the marks of `dependants` are forgotten.
    """
    counts: dict[str, int] = {}

    def build(state: State) -> State:
        old = raw_parts(state)
        low = 0 if full_refresh else stored_watermark(spark, root, name, state)
        unseen = [] if full_refresh else stored_unseen(spark, root, name, state)
        high = max(source_watermark(source).first()["watermark"], low)
        staged: list[str] = []
        try:
            parts = {} if full_refresh else dict(old)
            loaded = 0
            if high > low or unseen or full_refresh or withdrawn is not None:
                number = next_number(old)
                gone = None
                if withdrawn is not None and not full_refresh:
                    # only rows that were loaded, and only once
                    ids = written(withdrawn.select("source_row_id", "check_id").distinct(), "withdrawn")
                    there = within("source_row_id", covering_ranges(ids, "source_row_id"))
                    known = read_runs(spark, root, RAW, old, there).select("source_row_id")
                    gone = ids.join(known, "source_row_id", "left_semi")
                rows = not_loaded(spark, root, state, source, low, high, unseen)
                run = stage_run(spark, root, RAW, number, rows, gone, sorted_input=True)
                staged.append(run.folder)
                loaded = run.rows
                if run.rows or run.gone or full_refresh:
                    parts[run.part] = run.folder
                if run.rows:
                    pieces = merged_ranges([*unseen, (low + 1, high)] if high > low else unseen, len(unseen) + 1)
                    seen = [t.select("source_row_id") for t in (read_stored(spark, root, RAW, parts), read_gone(spark, root, RAW, parts))]
                    unseen = unseen_ranges(seen[0].union(seen[1]).where(within("source_row_id", pieces)), pieces)
                merge = merged(spark, root, RAW, parts)
                if merge:
                    new, replaced = merge
                    staged.append(new.folder)
                    parts = {p: f for p, f in parts.items() if f not in {r.folder for r in replaced}} | {new.part: new.folder}
            forget = {name, *dependants} if full_refresh else ()
            marks = stage_snapshot(
                advanced_checkpoints(spark, root, state, name, high, forget), root, CHECKPOINT_TABLE
            )
            staged.append(marks[""])
            ranges = _stage_unseen(spark, root, state, name, unseen)
            staged.append(ranges[""])
            published = publish(
                spark, root, state, {RAW_CHECKS_TABLE: parts, CHECKPOINT_TABLE: marks, UNSEEN_TABLE: ranges}
            )
        except Exception:
            discard(spark, root, staged)
            raise
        # an addition that was merged at once, or was empty
        discard(spark, root, [f for f in staged[:-2] if f not in parts.values()])
        counts.update(previous=low, current=high, rows=loaded, total=live_rows(parts))
        return published

    with scratch(spark):
        retried(spark, root, build)
    return counts
