"""Stored tables: Parquet folders listed in published states, layer materialisation and mart scans.

Nothing published is ever changed in place. A table is one Parquet folder, or several parts (buckets, months, loads) with a
folder each. New content goes to new folders; it becomes visible when the next state, a small JSON file that names the
folders of all tables, appears under the root. State n + 1 is created from state n by a rename that fails if it is there
already, so of two runs that build on the same state one gets a `Conflict` and has to build anew.
"""

import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from checkmart.schemas import MART_SCHEMAS

STATES = "published_states"
PLAN_TABLE = "raw/stg_plan_daily"
LAYERS = ("staging", "dwh", "mart")
# States whose folders are kept for readers that started on them.
KEEP_STATES = 10
# Seconds after which a folder that no state names belongs to a dead run.
SWEEP_AGE = 7 * 24 * 3600.0
# Attempts of a whole-table replacement that meets other writers.
TRIES = 20

Parts = dict[str, str]


class Conflict(RuntimeError):
    """Another run has published meanwhile."""


class State(NamedTuple):
    """Folders under the root by table and part; a table without parts has the part ''."""

    number: int
    tables: dict[str, Parts]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can list the path."""
    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty Parquet table with the schema unless something is there."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def _file_system(spark: SparkSession, path: str):
    # the file system of the path, with the path as its own object; driver-side, for small files and listings only
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, location = _file_system(spark, folder)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def _state_numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in _names(spark, f"{root}/{STATES}") if name[0].isdigit()]


def _state_path(root: str, number: int) -> str:
    return f"{root}/{STATES}/{number:012d}.json"


def _read_state(spark: SparkSession, root: str, number: int) -> State:
    text = spark.read.text(_state_path(root, number), wholetext=True).first()[0]
    return State(number, json.loads(text))


def current_state(spark: SparkSession, root: str) -> State:
    """The last published state; number 0 before the first one."""
    numbers = _state_numbers(spark, root)
    return _read_state(spark, root, numbers[-1]) if numbers else State(0, {})


def publish(
    spark: SparkSession,
    root: str,
    base: State,
    replaced: Mapping[str, Parts],
    updated: Mapping[str, Mapping[str, str | None]] | None = None,
) -> State:
    """Make staged folders visible, all at once, as the state after `base`.

    Tables in `replaced` consist of the given parts alone; in `updated` the given parts change, and a None removes one.
    Raises `Conflict`, and changes nothing, if the state after `base` exists.
    """
    tables = {**base.tables, **replaced}
    for table, parts in (updated or {}).items():
        merged = {**tables.get(table, {}), **parts}
        tables[table] = {part: folder for part, folder in merged.items() if folder}
    state = State(base.number + 1, tables)
    files, draft = _file_system(spark, f"{root}/{STATES}/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(tables, sort_keys=True), "utf-8"))
    stream.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    _, target = _file_system(spark, _state_path(root, state.number))
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE  # do not overwrite
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), options)
    except Exception:
        files.delete(draft, False)
        if files.exists(target):
            raise Conflict(f"state {state.number} under {root} was published by another run") from None
        raise
    return state


def version_folder(table: str) -> str:
    """A new folder of a table, relative to the root."""
    return f"{table}/version-{uuid.uuid4().hex}"


def stage_snapshot(df: DataFrame, root: str, table: str, by: str | None = None) -> Parts:
    """Write `df` to a new, unpublished folder of the table; with `by` one part per value of that column.

    The column itself is not stored: it names the parts.
    """
    folder = version_folder(table)
    if not by:
        df.write.parquet(f"{root}/{folder}")
        return {"": folder}
    df.write.partitionBy(by).parquet(f"{root}/{folder}")
    names = [n for n in _names(df.sparkSession, f"{root}/{folder}") if n.startswith(f"{by}=")]
    return {name.partition("=")[2]: f"{folder}/{name}" for name in names}


def _delete(spark: SparkSession, root: str, folders: Iterable[str]) -> None:
    for folder in folders:
        files, location = _file_system(spark, f"{root}/{folder}")
        files.delete(location, True)


def discard(spark: SparkSession, root: str, staged: Iterable[str]) -> None:
    """Delete the versions that staged folders belong to, which will not be published."""
    _delete(spark, root, {re.sub("(/version-[^/]*).*", r"\1", folder) for folder in staged})


def delete_old(spark: SparkSession, root: str, keep: int = KEEP_STATES) -> list[str]:
    """Delete states before the last `keep`, and the folders that only they name; returns the folders."""
    numbers = _state_numbers(spark, root)
    old, kept = numbers[:-keep], numbers[-keep:]

    def folders(which: Sequence[int]) -> set[str]:
        return {f for n in which for parts in _read_state(spark, root, n).tables.values() for f in parts.values()}

    unused = sorted(folders(old) - folders(kept)) if old else []
    _delete(spark, root, unused)
    for number in old:
        files, location = _file_system(spark, _state_path(root, number))
        files.delete(location, False)
    return unused


def sweep(spark: SparkSession, root: str, older_than: float = SWEEP_AGE) -> list[str]:
    """Delete version folders that no kept state names and nobody has touched for `older_than` seconds; returns them.

    A driver that is killed cannot delete what it wrote. The age protects runs in progress: a run may not last longer.
    """
    known = {f for n in _state_numbers(spark, root) for parts in _read_state(spark, root, n).tables.values() for f in parts.values()}
    known = {re.sub("(/version-[^/]*).*", r"\1", folder) for folder in known}
    gone = []
    tables = [f"{layer}/{name}" for layer in _names(spark, root) if layer != STATES for name in _names(spark, f"{root}/{layer}")]
    for table in tables:
        files, location = _file_system(spark, f"{root}/{table}")
        if not files.getFileStatus(location).isDirectory():
            continue
        for version in _names(spark, f"{root}/{table}"):
            folder = f"{table}/{version}"
            if version.startswith("version-") and folder not in known and _age(spark, f"{root}/{folder}") > older_than:
                gone.append(folder)
    _delete(spark, root, gone)
    return gone


def _age(spark: SparkSession, folder: str) -> float:
    """Seconds since the newest file or folder below was written."""
    files, location = _file_system(spark, folder)
    newest, waiting = 0, [files.getFileStatus(location)]
    while waiting:
        status = waiting.pop()
        newest = max(newest, status.getModificationTime())
        if status.isDirectory():
            waiting.extend(files.listStatus(status.getPath()))
    return time.time() - newest / 1000


def retried(spark: SparkSession, root: str, build: Callable[[State], State], tries: int = TRIES) -> State:
    """Build and publish on the current state, anew after each conflict."""
    for _ in range(tries - 1):
        try:
            return build(current_state(spark, root))
        except Conflict:
            continue
    return build(current_state(spark, root))


def write_snapshot(df: DataFrame, root: str, table: str) -> None:
    """Replace the table as a whole. Other tables that are published meanwhile stay."""
    spark, parts = df.sparkSession, stage_snapshot(df, root, table)
    retried(spark, root, lambda state: publish(spark, root, state, {table: parts}))


def read_parts(spark: SparkSession, root: str, parts: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """The given folders as one table; empty without any."""
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/{folder}" for folder in parts.values()))


def read_snapshot(
    spark: SparkSession, root: str, table: str, schema: T.StructType, state: State | None = None
) -> DataFrame:
    """The table in a state, by default the current one; empty before its first version."""
    state = state or current_state(spark, root)
    return read_parts(spark, root, state.tables.get(table, {}), schema)


def load_plan(plan: DataFrame, root: str) -> dict[str, int]:
    """Replace the whole raw plan; returns its number of rows."""
    spark, parts = plan.sparkSession, stage_snapshot(plan, root, PLAN_TABLE)
    retried(spark, root, lambda state: publish(spark, root, state, {PLAN_TABLE: parts}))
    return {"rows": read_parts(spark, root, parts, plan.schema).count()}


def materialize(df: DataFrame, root: str, layer: str, name: str) -> DataFrame:
    """A table of a layer: staging becomes a lazy view, dwh and mart tables are stored as a new version."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    if layer == "staging":
        df.createOrReplaceTempView(name)
        return df
    table = f"{layer}/{name}"
    write_snapshot(df, root, table)
    return read_snapshot(df.sparkSession, root, table, df.schema)


def read_mart(
    spark: SparkSession,
    root: str,
    name: str,
    columns: Sequence[str] | None = None,
    order: Sequence[str | Column] = (),
    schemas: Mapping[str, T.StructType] = MART_SCHEMAS,
) -> tuple[DataFrame, str | None]:
    """Chosen columns of a mart in the given order, and no message.

    Before the first build, and when the stored mart cannot be read, an empty table of the declared schema and a message
    that says what is wrong. Reading is tried on one row.
    """
    schema = schemas[name]
    parts = current_state(spark, root).tables.get(f"mart/{name}", {})
    message = None if parts else f"mart {name} has not been built under {root}; run the refresh first"
    mart = spark.createDataFrame([], schema)
    if parts:
        try:
            mart = read_parts(spark, root, parts, schema)
            mart.limit(1).collect()
        except Exception as error:
            mart = spark.createDataFrame([], schema)
            message = f"mart {name} under {root} cannot be read: {str(error).splitlines()[0]}"
    mart = mart.select(*(columns or schema.names))
    return (mart.orderBy(*order) if order else mart), message
