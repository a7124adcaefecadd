"""Declarative data-quality checks.

A check counts failures: NULL values (not_null), values seen more than once (unique), distinct unexpected values
(accepted_values), distinct keys without a partner (relationship).
"""

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checkmart.vocabulary import CHANNELS


class Check(NamedTuple):
    table: str
    column: str
    test: str
    values: Sequence[str] = ()
    to_table: str = ""


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, the number of rows with a NULL; all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values seen more than once, with their row counts; NULL is ignored."""
    seen = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows_count"))
    return seen.where(F.col("rows_count") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts; NULL passes."""
    unexpected = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return unexpected.groupBy(column).agg(F.count("*").alias("rows_count"))


def relationship(df: DataFrame, column: str, other: DataFrame) -> DataFrame:
    """Distinct non-NULL values of `column` that `other` lacks."""
    keys = df.where(F.col(column).isNotNull()).select(column).distinct()
    return keys.join(other.select(column), column, "left_anti")


def _declare(table: str, column: str, *tests: str) -> list[Check]:
    return [Check(table, column, test, CHANNELS if test == "accepted_values" else ()) for test in tests]


# The checks declared for every layer.
CHECK_SUITE: list[Check] = [
    *_declare("stg_checks", "source_row_id", "not_null", "unique"),
    *_declare("stg_checks", "accounting_date", "not_null"),
    *_declare("stg_checks", "check_id", "not_null"),
    *_declare("stg_checks", "dish_name", "not_null"),
    *_declare("stg_checks", "channel_group", "accepted_values"),
    *_declare("stg_plan_daily", "plan_date", "not_null", "unique"),
    *_declare("stg_plan_daily", "plan_total_amount", "not_null"),
    *_declare("dim_date", "date_key", "not_null", "unique"),
    *_declare("dim_dish", "dish_key", "not_null", "unique"),
    *_declare("dim_dish", "dish_name", "not_null"),
    *_declare("dim_order_type", "order_type_key", "not_null", "unique"),
    *_declare("dim_order_type", "order_type", "not_null"),
    *_declare("dim_order_type", "channel_group", "accepted_values"),
    *_declare("fact_check_items", "check_item_key", "not_null", "unique"),
    *_declare("fact_check_items", "revenue_date", "not_null"),
    *_declare("fact_check_items", "check_id", "not_null"),
    *_declare("fact_check_items", "dish_key", "not_null"),
    *_declare("fact_check_items", "order_type_key", "not_null"),
    *_declare("cancelled_checks", "check_id", "not_null", "unique"),
    *_declare("mart_plan_fact_daily", "revenue_date", "not_null", "unique"),
    *_declare("mart_channel_daily", "revenue_date", "not_null"),
    *_declare("mart_channel_daily", "channel_group", "accepted_values"),
    *_declare("mart_avg_check_by_order_type", "revenue_date", "not_null"),
    *_declare("mart_avg_check_by_order_type", "order_type", "not_null"),
    *_declare("mart_dish_sales_daily", "revenue_date", "not_null"),
    *_declare("mart_dish_sales_daily", "dish_name", "not_null"),
    *_declare("mart_dashboard_daily", "revenue_date", "not_null", "unique"),
]

# Facts whose dish or order type is NULL have a key that no dimension row carries; reported, but not a failed run.
RELATIONSHIP_SUITE: list[Check] = [
    Check("fact_check_items", "dish_key", "relationship", to_table="dim_dish"),
    Check("fact_check_items", "order_type_key", "relationship", to_table="dim_order_type"),
]


def dq_report(tables: Mapping[str, DataFrame], suite: Sequence[Check] = CHECK_SUITE) -> DataFrame:
    """Failures of every declared check on the given tables: (table_name, column_name, test, failures).

    All not_null checks of a table share one pass; the others read one column each.
    """
    parts = []
    for name, df in tables.items():
        checks = [c for c in suite if c.table == name]
        null_columns = [c.column for c in checks if c.test == "not_null"]
        if null_columns:
            parts.append(
                not_null(df, null_columns).select(
                    F.lit(name).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "failures"
                )
            )
        for check in checks:
            if check.test == "unique":
                failing = unique(df, check.column)
            elif check.test == "accepted_values":
                failing = accepted_values(df, check.column, check.values)
            elif check.test == "relationship" and check.to_table in tables:
                failing = relationship(df, check.column, tables[check.to_table])
            else:
                continue
            parts.append(
                failing.agg(F.count("*").alias("failures")).select(
                    F.lit(name).alias("table_name"),
                    F.lit(check.column).alias("column_name"),
                    F.lit(check.test).alias("test"),
                    "failures",
                )
            )
    if not parts:
        raise ValueError("no declared check applies to the given tables")
    return reduce(DataFrame.unionByName, parts)


def require_clean(report: DataFrame) -> None:
    """Raise with the list of failed checks, if there are any. The report has one row per declared check."""
    failed = report.where(F.col("failures") > 0).orderBy("table_name", "column_name", "test").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed]
        raise ValueError("data-quality checks failed: " + "; ".join(lines))
