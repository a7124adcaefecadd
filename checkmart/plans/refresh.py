"""The refresh jobs: the source, facts with everything that depends on them, and the plan with its few dependants.

A run reads one published state, writes new folders, checks them, and publishes them in one step. A run that fails leaves
the state and deletes its folders; one that meets another run's new state builds anew on it. A scheduler calls these
functions; each is safe to call again after a failure.
"""

from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.operators.daily import (
    actual_daily,
    check_level_daily,
    condensed,
    mart_avg_check_by_order_type,
    mart_channel_daily,
    mart_dashboard_daily,
    mart_dish_sales_daily,
    plan_fact_of_days,
)
from checkmart.operators.dims import calendar, date_bounds, dim_dish, dim_order_type, merged_bounds, merged_dishes
from checkmart.operators.quality import CHECK_SUITE, RELATIONSHIP_SUITE, Check, dq_report, require_clean
from checkmart.plans.fact import (
    CONDENSED,
    FACT,
    FACT_TABLE,
    OPEN,
    all_open_checks,
    cancelled_of_open,
    changes_of,
    fact_check_items,
)
from checkmart.plans.staging import stage_checks, stage_plan
from checkmart.schemas import (
    ACTUAL_DAILY,
    DATE_BOUNDS,
    DIM_DISH,
    DIM_ORDER_TYPE,
    MART_SCHEMAS,
    RAW_PLAN,
    SOURCE_CHECKS,
    WITHDRAWN,
)
from checkmart.session import scratch, written
from checkmart.sources.extracts import build_source, changed_source, period_stats
from checkmart.sources.incremental import (
    CHECKPOINT_TABLE,
    advanced_checkpoints,
    last_load,
    read_raw_checks,
    read_withdrawn,
    run_extract,
    source_watermark,
    stored_watermark,
)
from checkmart.sources.runs import RunTable, merged, merged_ranges, next_number, read_runs, stage_run, within
from checkmart.sources.tables import (
    PLAN_TABLE,
    Parts,
    State,
    delete_old,
    discard,
    publish,
    read_parts,
    read_snapshot,
    retried,
    stage_snapshot,
)
from checkmart.vocabulary import RESTAURANT, CheckRules

SOURCE_TABLE = "pos/check_items"
WITHDRAWN_TABLE = "pos/withdrawn_items"
ACTUAL_TABLE = "dwh/actual_daily"
BOUNDS_TABLE = "dwh/fact_date_bounds"
# the month of rows without a day
NO_MONTH = "none"


class _Run:
    """Tables written by one run on one state; nothing is visible before `publish`."""

    def __init__(self, spark: SparkSession, root: str, state: State):
        self.spark, self.root, self.state = spark, root, state
        self.replaced: dict[str, Parts] = {}
        self.updated: dict[str, dict[str, str | None]] = {}
        self.staged: list[str] = []

    def read(self, table: str, schema, months: Collection[str] | None = None) -> DataFrame:
        """A table as it was published, or some months of it."""
        return read_parts(self.spark, self.root, _months(self.state.tables.get(table, {}), months), schema)

    def store(self, df: DataFrame, table: str) -> DataFrame:
        """Replace a table as a whole; returns the new content."""
        self.replaced[table] = stage_snapshot(df, self.root, table)
        self.staged += self.replaced[table].values()
        return read_parts(self.spark, self.root, self.replaced[table], df.schema)

    def store_months(self, df: DataFrame, table: str, months: Collection[str] | None, day: str = "revenue_date") -> DataFrame:
        """Replace the given months of a table, or all; a month without rows goes. Returns the new rows."""
        month = F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))
        staged = stage_snapshot(df.withColumn("month", month).hint("rebalance", "month"), self.root, table, "month")
        self.staged += staged.values()
        if months is None:
            self.replaced[table] = staged
        else:
            self.updated[table] = {**dict.fromkeys(months), **staged}
        return read_parts(self.spark, self.root, staged, df.schema)

    def add(self, table: RunTable, rows: DataFrame, gone: DataFrame | None, anew: bool = False) -> DataFrame:
        """Add a run to a table, or replace all its runs; returns the run's rows."""
        number = next_number(self.state.tables.get(table.name, {}))
        run = stage_run(self.spark, self.root, table, number, rows, gone)
        self.staged.append(run.folder)
        if anew:
            self.replaced[table.name] = {run.part: run.folder}
        elif run.rows or run.gone:
            self.updated[table.name] = {run.part: run.folder}
        return read_runs(self.spark, self.root, table, {run.part: run.folder})

    def merge(self, *tables: RunTable) -> None:
        """Merge the runs that are due after this run's additions."""
        for table in tables:
            parts = self.parts_after(table.name)
            merge = merged(self.spark, self.root, table, parts)
            if merge:
                new, old = merge
                self.staged.append(new.folder)
                published = self.state.tables.get(table.name, {})
                gone: dict[str, str | None] = {run.part: None for run in old if run.part in published}
                kept = {p: f for p, f in self.updated.get(table.name, {}).items() if p not in {run.part for run in old}}
                self.updated[table.name] = {**kept, **gone, new.part: new.folder}

    def parts_after(self, table: str, months: Collection[str] | None = None) -> Parts:
        """The parts of a table when this run is published."""
        if table in self.replaced:
            return _months(self.replaced[table], months)
        both = {**self.state.tables.get(table, {}), **self.updated.get(table, {})}
        return _months({part: folder for part, folder in both.items() if folder}, months)

    def read_after(self, table: RunTable, where: Column | None = None) -> DataFrame:
        """The rows of a table of runs when this run is published."""
        return read_runs(self.spark, self.root, table, self.parts_after(table.name), where)

    def months_after(self, table: str, schema, months: Collection[str] | None = None) -> DataFrame:
        return read_parts(self.spark, self.root, self.parts_after(table, months), schema)

    def publish(self) -> State:
        state = publish(self.spark, self.root, self.state, self.replaced, self.updated)
        named = {folder for parts in state.tables.values() for folder in parts.values()}
        # runs that were merged at once, or added nothing
        discard(self.spark, self.root, [f for f in self.staged if f not in named])
        return state

    def discard(self) -> None:
        discard(self.spark, self.root, self.staged)


def _months(parts: Parts, months: Collection[str] | None) -> Parts:
    return parts if months is None else {month: folder for month, folder in parts.items() if month in months}


def _published(spark: SparkSession, root: str, build: Callable[[_Run], DataFrame]) -> DataFrame:
    """Build and publish, anew after a conflict; returns the report of the run that was published."""
    reports: list[DataFrame] = []

    def attempt(state: State) -> State:
        run = _Run(spark, root, state)
        try:
            report = build(run)
            published = run.publish()
        except Exception:
            run.discard()
            raise
        reports.append(report)
        return published

    retried(spark, root, attempt)
    delete_old(spark, root)
    return reports[-1]


def _check(tables: Mapping[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    report = dq_report(tables, [*suite, *RELATIONSHIP_SUITE])
    # one row per declared check: kept as values, so that it outlives the folders it was computed from
    rows = report.collect()
    report = report.sparkSession.createDataFrame(rows, report.schema)
    require_clean(report.where(F.col("test") != "relationship"))
    return report


def run_bootstrap(
    spark: SparkSession, root: str, extracts: Sequence[DataFrame], periods: Sequence[str]
) -> tuple[DataFrame, int]:
    """Number the lines of all extracts and store them as the source; returns the period statistics and all rows.

    Extracts may be sent again. Lines that are as before keep their ids, new and changed ones get ids above all earlier
    ones, and the ids of lines that changed or are gone become withdrawn, so a refresh by id misses nothing and counts
    nothing twice.
    """

    def build(state: State) -> State:
        parts = state.tables.get(SOURCE_TABLE, {})
        staged: list[str] = []
        try:
            updated: dict[str, Parts] = {}
            if parts:
                stored = read_parts(spark, root, parts, SOURCE_CHECKS)
                ids = stored.select("source_row_id").union(read_withdrawn_lines(spark, root, state).select("source_row_id"))
                first = source_watermark(ids).first()["watermark"] + 1
                source, gone = changed_source(stored, extracts, periods, first)
                folder = stage_snapshot(gone, root, WITHDRAWN_TABLE)[""]
                staged.append(folder)
                updated[WITHDRAWN_TABLE] = {f"{state.number + 1:012d}": folder}
            else:
                source = build_source(extracts, periods)
            new = stage_snapshot(source, root, SOURCE_TABLE)
            staged.append(new[""])
            return publish(spark, root, state, {SOURCE_TABLE: new}, updated)
        except Exception:
            discard(spark, root, staged)
            raise

    with scratch(spark):
        retried(spark, root, build)
    source = read_snapshot(spark, root, SOURCE_TABLE, extracts[0].schema)
    return period_stats(source), source.count()


def read_withdrawn_lines(spark: SparkSession, root: str, state: State | None = None) -> DataFrame:
    """(source_row_id, check_id) of all lines that re-sent extracts changed or no longer hold."""
    return read_snapshot(spark, root, WITHDRAWN_TABLE, WITHDRAWN, state)


def _shifted(months: Collection[str], years: int) -> set[str]:
    return {m if m == NO_MONTH else f"{int(m[:4]) + years:04d}{m[4:]}" for m in months}


def _of_months(months: Collection[str] | None, day: str) -> Column:
    """Whether a day lies in some months; all do without a choice."""
    if months is None:
        return F.lit(True)
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH)).isin(*months)


def _plan_marts(run: _Run, plan: DataFrame, bounds: DataFrame, months: Collection[str] | None) -> dict[str, DataFrame]:
    """Calendar, plan-versus-fact and dashboard mart from the stored day level: all, or the months that days changed in.

    The dashboard shows a month again a year later.
    """
    planned = plan.agg(F.min("plan_date").alias("min_date"), F.max("plan_date").alias("max_date"))
    days = run.store(calendar(merged_bounds(bounds, planned)), "dwh/dim_date")
    actual = run.months_after(ACTUAL_TABLE, ACTUAL_DAILY, months)
    plan_fact = plan_fact_of_days(actual, plan.where(_of_months(months, "plan_date")))
    name = "mart/mart_plan_fact_daily"
    plan_fact = run.store_months(plan_fact, name, months)
    shown = None if months is None else {*months, *_shifted(months, 1)}
    needed = None if shown is None else {*shown, *_shifted(shown, -1)}
    both = run.months_after(name, MART_SCHEMAS["mart_plan_fact_daily"], needed)
    dashboard = mart_dashboard_daily(both).where(_of_months(shown, "revenue_date"))
    dashboard = run.store_months(dashboard, "mart/mart_dashboard_daily", shown)
    return {"dim_date": days, "mart_plan_fact_daily": plan_fact, "mart_dashboard_daily": dashboard}


def _day_marts(checks: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """The daily tables that some days' checks and lines give."""
    return {
        ACTUAL_TABLE: actual_daily(check_level_daily(checks)),
        "mart/mart_channel_daily": mart_channel_daily(checks),
        "mart/mart_avg_check_by_order_type": mart_avg_check_by_order_type(checks),
        "mart/mart_dish_sales_daily": mart_dish_sales_daily(lines),
    }


def _named(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {table.partition("/")[2]: rows for table, rows in tables.items()}


def _rebuild(run: _Run, rules: CheckRules, plan: DataFrame) -> dict[str, DataFrame]:
    """Everything from all raw rows."""
    raw = read_raw_checks(run.spark, run.root, run.state)
    stg = stage_checks(raw, rules)
    stg.createOrReplaceTempView("stg_checks")
    fact = run.add(FACT, fact_check_items(raw, rules), None, anew=True)
    checks = run.add(CONDENSED, condensed(fact), None, anew=True)
    open_checks = run.add(OPEN, all_open_checks(raw, checks), None, anew=True)
    marts = {table: run.store_months(rows, table, None) for table, rows in _day_marts(checks, fact).items()}
    bounds = run.store(_bounds(stg), BOUNDS_TABLE)
    return {
        "stg_checks": stg,
        "fact_check_items": fact,
        "dim_dish": run.store(dim_dish(stg), "dwh/dim_dish"),
        "dim_order_type": run.store(dim_order_type(stg), "dwh/dim_order_type"),
        "cancelled_checks": cancelled_of_open(open_checks),
        **_named(marts),
        **_plan_marts(run, plan, bounds, None),
    }


def _bounds(stg: DataFrame) -> DataFrame:
    return date_bounds(stg, stg.select(F.lit(None).cast("date").alias("plan_date")).limit(0))


def _update(run: _Run, rules: CheckRules, plan: DataFrame, load: int) -> dict[str, DataFrame]:
    """What the raw loads after a number change; everything else is kept as it is.

    Lines of changed checks are added to the fact, and replaced ones taken back; the marts of the touched days are computed
    again and replace these days in their months.
    """
    spark, root, state = run.spark, run.root, run.state
    new_rows = written(read_raw_checks(spark, root, state, after_load=load), "new-rows")
    withdrawn = written(read_withdrawn(spark, root, state, load), "withdrawn-rows")
    any_withdrawn = not withdrawn.isEmpty()
    changes = changes_of(spark, root, state, new_rows, withdrawn if any_withdrawn else None, rules)
    fact = run.add(FACT, changes.lines, changes.replaced)
    run.add(CONDENSED, condensed(changes.lines), changes.replaced)
    open_checks = run.add(OPEN, changes.open_checks, changes.closed)
    of_days = _on_days(changes.days)
    months = {NO_MONTH if day is None else f"{day:%Y-%m}" for day in changes.days}
    marts = {}
    for table, rows in _day_marts(run.read_after(CONDENSED, of_days), run.read_after(FACT, of_days)).items():
        schema = ACTUAL_DAILY if table == ACTUAL_TABLE else MART_SCHEMAS[table.partition("/")[2]]
        kept = run.read(table, schema, months).where(~of_days)
        marts[table] = run.store_months(kept.unionByName(rows.select(*schema.names)), table, months)
    # what was withdrawn may have been the only line of a dish: dimensions are then read from all rows again
    stg = stage_checks(read_raw_checks(spark, root, state) if any_withdrawn else new_rows, rules)
    older = [] if any_withdrawn else [None]
    dishes = merged_dishes(*[run.read("dwh/dim_dish", DIM_DISH) for _ in older], dim_dish(stg))
    bounds = merged_bounds(*[run.read(BOUNDS_TABLE, DATE_BOUNDS) for _ in older], _bounds(stg))
    order_types = dim_order_type(stg)
    for _ in older:
        order_types = run.read("dwh/dim_order_type", DIM_ORDER_TYPE).unionByName(order_types).distinct()
    return {
        "stg_checks": stage_checks(new_rows, rules),
        "fact_check_items": fact,
        "dim_dish": run.store(dishes, "dwh/dim_dish"),
        "dim_order_type": run.store(order_types, "dwh/dim_order_type"),
        "cancelled_checks": cancelled_of_open(open_checks),
        **_named(marts),
        **_plan_marts(run, plan, run.store(bounds, BOUNDS_TABLE), months),
    }


def _on_days(days: Sequence, column: str = "revenue_date") -> Column:
    """Whether a date is one of the days; a NULL day is one like any other. Ranges of days reach the scan."""
    known = sorted(day for day in days if day is not None)
    numbers = merged_ranges([(day.toordinal(), day.toordinal()) for day in known])
    ranges = [(date.fromordinal(low), date.fromordinal(high)) for low, high in numbers]
    inside = F.coalesce(within(column, ranges) & F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
    return inside | F.col(column).isNull() if None in days else inside


def refresh_facts(
    spark: SparkSession,
    root: str,
    rules: CheckRules = RESTAURANT,
    suite: Sequence[Check] = CHECK_SUITE,
    incremental: bool = True,
) -> DataFrame:
    """Bring fact, dimensions and marts up to the raw table, check them, publish them; returns the quality report.

    With `incremental` only raw loads after the fact's own mark are read, with the ranges of ids and the days that they
    touch; the checks cover what is new. A failed check leaves the published tables and the mark as they were, so the next
    run picks the rows up.
    """

    def build(run: _Run) -> DataFrame:
        plan = stage_plan(run.read(PLAN_TABLE, RAW_PLAN))
        plan.createOrReplaceTempView("stg_plan_daily")
        mark = stored_watermark(spark, root, FACT_TABLE, run.state)
        high = last_load(run.state)
        if incremental and mark and FACT_TABLE in run.state.tables:
            tables = _update(run, rules, plan, mark)
        else:
            tables = _rebuild(run, rules, plan)
        report = _check({**tables, "stg_plan_daily": plan}, suite)
        run.merge(FACT, CONDENSED, OPEN)
        # the fact's mark, the last load in it, is published with it
        run.store(advanced_checkpoints(spark, root, run.state, FACT_TABLE, high), CHECKPOINT_TABLE)
        return report

    with scratch(spark):
        return _published(spark, root, build)


def run_fact_refresh(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    full_refresh: bool = False,
    rules: CheckRules = RESTAURANT,
    suite: Sequence[Check] = CHECK_SUITE,
    incremental: bool = False,
    withdrawn: DataFrame | None = None,
) -> DataFrame:
    """Copy new source rows, then bring fact, dimensions and marts up to them (`refresh_facts`).

    `withdrawn` names lines that the source no longer holds (`read_withdrawn_lines` for a published source).
    """
    run_extract(spark, source, root, full_refresh, dependants=[FACT_TABLE], withdrawn=withdrawn)
    return refresh_facts(spark, root, rules, suite, incremental and not full_refresh)


def run_plan_refresh(
    spark: SparkSession,
    root: str,
    plan: DataFrame,
    rules: CheckRules = RESTAURANT,
    suite: Sequence[Check] = CHECK_SUITE,
) -> DataFrame:
    """Replace the plan and rebuild only what depends on it: calendar, plan-versus-fact mart, dashboard mart.

    The new plan is published with these tables; a refused plan leaves no trace. Reads the day level that the fact refresh
    stored, one row a day, so that job must have run before.
    """

    def build(run: _Run) -> DataFrame:
        if ACTUAL_TABLE not in run.state.tables:
            raise ValueError(f"no fact under {root}; run the fact refresh first")
        staged = stage_plan(run.store(plan, PLAN_TABLE))
        staged.createOrReplaceTempView("stg_plan_daily")
        marts = _plan_marts(run, staged, run.read(BOUNDS_TABLE, DATE_BOUNDS), None)
        return _check({"stg_plan_daily": staged, **marts}, suite)

    with scratch(spark):
        return _published(spark, root, build)
