"""The line-level fact and its incremental refresh."""

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.functions.flags import is_dish_sales_item, is_turnover_item
from checkmart.functions.keys import hash_key
from checkmart.operators.versions import added_versions, check_versions, final_versions, positive_qty, replace_checks
from checkmart.plans.staging import stage_checks
from checkmart.schemas import CANCELLED_CHECKS, CHECK_IDS, CONDENSED_CHECKS, FACT_CHECK_ITEMS, OPEN_CHECKS
from checkmart.session import written
from checkmart.sources.incremental import read_raw_checks
from checkmart.sources.runs import RunTable, covering_ranges, read_runs, within
from checkmart.sources.tables import State, current_state
from checkmart.vocabulary import RESTAURANT, CheckRules

FACT_TABLE = "dwh/fact_check_items"
# sorted by day, which is how marts read them; ids of checks mostly grow with the days
FACT = RunTable(FACT_TABLE, FACT_CHECK_ITEMS, "check_id", ["revenue_date", "check_id"], CHECK_IDS)
# one row per check, day and order type; the daily marts are built from it, and it knows every check's final close
CONDENSED = RunTable("dwh/condensed_checks", CONDENSED_CHECKS, "check_id", ["revenue_date", "check_id"], CHECK_IDS)
OPEN = RunTable("dwh/open_checks", OPEN_CHECKS, "check_id", ["check_id"], CHECK_IDS)


def fact_columns(final: DataFrame) -> DataFrame:
    """Final check lines as the 29 fact columns: surrogate keys, revenue date and sales flags added."""
    service, zero_modifier = F.col("is_service_item"), F.col("is_zero_amount_modifier")
    item_parts = ["source_row_id", "check_id", "close_ts", "dish_name", "dish_category", "order_type"]
    return final.select(
        hash_key(*[F.col(c) for c in item_parts]).alias("check_item_key"),
        "source_row_id",
        F.col("accounting_date").alias("revenue_date"),
        "check_id",
        "open_ts",
        "close_ts",
        "open_hour",
        "close_hour",
        hash_key(F.col("dish_name"), F.col("category_clean")).alias("dish_key"),
        hash_key(F.col("order_type"), F.col("channel_group")).alias("order_type_key"),
        "dish_name",
        "dish_category",
        "category_clean",
        "is_delivery_category",
        "order_type",
        "channel_group",
        "qty",
        "guest_count",
        "amount_discount_rub",
        "is_service_item",
        "is_zero_amount_modifier",
        is_turnover_item(zero_modifier).alias("is_turnover_item"),
        is_dish_sales_item(service, zero_modifier).alias("is_dish_sales_item"),
        "check_duration_minutes",
        "is_long_duration_check",
        "is_suspicious_open_date",
        "source_period",
        "source_sheet",
        "extracted_at",
    )


def fact_check_items(raw: DataFrame, rules: CheckRules = RESTAURANT) -> DataFrame:
    """One row per line of every check's final version.

    The final rows are picked from the raw table and staged afterwards: the shuffle carries raw columns only, and
    flags and keys are not computed for superseded rows. Staging works row by row and keeps check, close and
    quantity as they are, so the result is that of picking from the staged table.
    """
    return fact_columns(stage_checks(final_versions(raw), rules))


def incremental_fact_refresh(
    raw: DataFrame,
    fact: DataFrame,
    changed: DataFrame,
    rules: CheckRules = RESTAURANT,
) -> DataFrame:
    """The fact after new raw rows: checks in `changed` are rebuilt from all their rows, the others are kept.

    `changed` holds every check id of the new rows once, as a stored table; `raw` includes the new rows. A newer
    close may arrive for any old check, so no check is ever closed to changes. Equals a full rebuild.
    """
    touched = raw.join(changed, "check_id", "left_semi")
    return replace_checks(fact, fact_check_items(touched, rules), changed)


class Changes(NamedTuple):
    """What new raw rows do to the fact: its new lines, the checks whose older lines go, and the days of both.

    `open_checks` are the changed checks that have no line in the fact afterwards; their older entries go like the
    entries of `closed`.
    """

    lines: DataFrame
    replaced: DataFrame
    days: list[date | None]
    open_checks: DataFrame
    closed: DataFrame


def changes_of(
    spark: SparkSession,
    root: str,
    state: State,
    new_rows: DataFrame,
    withdrawn: DataFrame | None = None,
    rules: CheckRules = RESTAURANT,
) -> Changes:
    """The effect of new raw rows, from these rows and the stored final closes of their checks alone.

    A check's final version is its latest close with a positive quantity. New rows with a later close than the stored one
    replace it, with the same close they join it, with an earlier one they change nothing: neither raw rows nor old lines
    of the fact are read. Only checks of which raw rows were withdrawn are built again from all their raw rows. What is
    read of stored tables is limited to ranges of the changed checks' ids. `new_rows` is a stored table.
    """
    ids = new_rows.select("check_id")
    if withdrawn is not None:
        withdrawn = written(withdrawn.select("check_id").distinct(), "withdrawn-checks")
        ids = ids.union(withdrawn)
    changed = written(ids.distinct(), "changed-checks")
    there = within("check_id", covering_ranges(changed, "check_id"))
    stored = read_runs(spark, root, CONDENSED, state.tables.get(CONDENSED.name, {}), there)
    known = stored.join(changed, "check_id", "left_semi").select("check_id", "close_ts", "revenue_date").distinct()
    known = written(known, "known-closes")
    fresh = new_rows
    again = None
    if withdrawn is not None:
        of_withdrawn = within("check_id", covering_ranges(withdrawn, "check_id")) | F.col("check_id").isNull()
        again = _semi(read_raw_checks(spark, root, state, of_withdrawn), withdrawn)
        again = written(again, "rows-of-withdrawn-checks")
        fresh = _anti(new_rows, withdrawn)
    last = positive_qty(fresh).groupBy("check_id").agg(F.max("close_ts").alias("close_ts"))
    closes = known.groupBy("check_id").agg(F.max("close_ts").alias("old_close_ts"))
    winning = last.join(closes, "check_id", "left").where(
        F.col("old_close_ts").isNull() | (F.col("close_ts") >= F.col("old_close_ts"))
    )
    winning = written(winning, "winning-closes")
    final = positive_qty(fresh).join(winning.select("check_id", "close_ts"), ["check_id", "close_ts"], "left_semi")
    replaced = winning.where(F.col("close_ts") > F.col("old_close_ts")).select("check_id")
    if again is not None:
        final = final.select(*again.columns).unionByName(final_versions(again).select(*again.columns))
        replaced = replaced.union(known.select("check_id").distinct().join(withdrawn, "check_id", "left_semi"))
    lines = written(fact_columns(stage_checks(final, rules)), "new-lines")
    replaced = written(replaced, "replaced-checks")
    touched = lines.select("revenue_date").union(known.join(replaced, "check_id", "left_semi").select("revenue_date"))
    days = sorted({row[0] for row in touched.distinct().collect()}, key=str)  # bounded by the calendar
    # checks without a line in the fact
    of_open = there | F.col("check_id").isNull()
    entries = read_runs(spark, root, OPEN, state.tables.get(OPEN.name, {}), of_open)
    entries = written(_semi(entries, changed), "old-open-checks")
    counted = check_versions(fresh)
    older = entries
    in_fact = known.select("check_id")
    if again is not None:
        counted = counted.unionByName(check_versions(again))
        older = _anti(entries, withdrawn)
        in_fact = in_fact.join(withdrawn, "check_id", "left_anti")
    in_fact = in_fact.union(lines.select("check_id")).distinct()
    open_checks = _anti(added_versions(older, counted), in_fact)
    return Changes(lines, replaced, days, open_checks, entries.select("check_id"))


def _semi(rows: DataFrame, ids: DataFrame) -> DataFrame:
    # a NULL check is a check like any other here
    ids = ids.select(F.col("check_id").alias("_id"))
    return rows.join(ids, rows["check_id"].eqNullSafe(F.col("_id")), "left_semi")


def _anti(rows: DataFrame, ids: DataFrame) -> DataFrame:
    ids = ids.select(F.col("check_id").alias("_id"))
    return rows.join(ids, rows["check_id"].eqNullSafe(F.col("_id")), "left_anti")


def all_open_checks(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """The checks of all raw rows that have no line in the fact."""
    return _anti(check_versions(raw), fact.select("check_id").distinct())


def cancelled_of_open(open_checks: DataFrame) -> DataFrame:
    """The cancelled checks: those without a positive row in any version."""
    cancelled = open_checks.where(F.col("positive_qty_rows_count") == 0).withColumn("is_cancelled", F.lit(True))
    return cancelled.select(*CANCELLED_CHECKS.names)


def read_fact(spark: SparkSession, root: str, state: State | None = None, where: Column | None = None) -> DataFrame:
    """The published fact, or what a filter on its days or checks leaves of it."""
    state = state or current_state(spark, root)
    return read_runs(spark, root, FACT, state.tables.get(FACT_TABLE, {}), where)


def read_cancelled(spark: SparkSession, root: str, state: State | None = None) -> DataFrame:
    """The published cancelled checks."""
    state = state or current_state(spark, root)
    return cancelled_of_open(read_runs(spark, root, OPEN, state.tables.get(OPEN.name, {})))
