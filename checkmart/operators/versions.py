"""Check versions. The POS re-sends a whole check whenever it changes; only its final version counts."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checkmart.functions.flags import is_modifier, is_service_category
from checkmart.vocabulary import MODIFIER_CATEGORY, SERVICE_CATEGORIES


def positive_qty(df: DataFrame) -> DataFrame:
    """Rows with a quantity above zero; NULL, zero and negative quantities drop out (pushed down to the scan)."""
    return df.where(F.col("qty") > 0)


def check_final_close(stg: DataFrame) -> DataFrame:
    """Closing time of every check's final version."""
    return positive_qty(stg).groupBy("check_id").agg(F.max("close_ts").alias("final_close_ts"))


def final_versions(stg: DataFrame, keys: Sequence[str] = ("check_id",)) -> DataFrame:
    """Rows of every check's final version: positive quantity, closed at the check's latest positive close.

    All rows that share the latest close are kept. A NULL key or close never matches. The latest closes are a
    map-side-combined aggregate that reads the key and the close only; the rows then join with it by key and close, a
    join that adaptive execution splits where one check holds many rows.
    """
    live = positive_qty(stg)
    last = live.groupBy(*keys).agg(F.max("close_ts").alias("close_ts"))
    return live.join(last, [*keys, "close_ts"], "left_semi")


def check_versions(stg: DataFrame) -> DataFrame:
    """Per check: all rows, rows with a positive quantity, last close, first and last accounting day."""
    return stg.groupBy("check_id").agg(
        F.count("*").alias("raw_rows_count"),
        F.count_if(F.col("qty") > 0).alias("positive_qty_rows_count"),
        F.max("close_ts").alias("last_close_ts"),
        F.min("accounting_date").alias("first_accounting_date"),
        F.max("accounting_date").alias("last_accounting_date"),
    )


def added_versions(*parts: DataFrame) -> DataFrame:
    """One entry per check from those of several sets of rows; equals `check_versions` of all rows together."""
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("check_id")
        .agg(
            F.sum("raw_rows_count").alias("raw_rows_count"),
            F.sum("positive_qty_rows_count").alias("positive_qty_rows_count"),
            F.max("last_close_ts").alias("last_close_ts"),
            F.min("first_accounting_date").alias("first_accounting_date"),
            F.max("last_accounting_date").alias("last_accounting_date"),
        )
    )


def cancelled_checks(stg: DataFrame) -> DataFrame:
    """Checks without a single positive row in any version."""
    return (
        check_versions(stg)
        .where(F.col("positive_qty_rows_count") == 0)
        .drop("positive_qty_rows_count")
        .withColumn("is_cancelled", F.lit(True))
    )


def latest_line_per_check_day(
    stg: DataFrame, service_categories: Sequence[str] = SERVICE_CATEGORIES, modifier: str = MODIFIER_CATEGORY
) -> DataFrame:
    """Documented variant: one line per check and accounting day, the latest closed one that is a real dish line.

    Ties go to the lowest row id. A NULL category drops out. Catalyst keeps one row per key in every map task before
    the shuffle, so a hot check does not travel as a whole.
    """
    category = F.col("dish_category")
    by_check_day = Window.partitionBy("check_id", "accounting_date").orderBy(
        F.col("close_ts").desc_nulls_last(), F.col("source_row_id").asc_nulls_last()
    )
    return (
        positive_qty(stg)
        .where(~is_service_category(category, service_categories) & ~is_modifier(category, modifier))
        .withColumn("_rank", F.row_number().over(by_check_day))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def superseded_versions(stg: DataFrame) -> DataFrame:
    """Documented variant: (check, accounting day, open time) with a close before the last close of that check-day.

    Rows first collapse to one per (check, day, open time): it is superseded somewhere exactly when its earliest
    close is before the last close of the check-day.
    """
    closed = stg.where(F.col("check_id").isNotNull() & F.col("accounting_date").isNotNull())
    opens = closed.groupBy("check_id", "accounting_date", "open_ts").agg(F.min("close_ts").alias("_first_close"))
    days = closed.groupBy("check_id", "accounting_date").agg(F.max("close_ts").alias("_day_close"))
    marked = opens.join(days, ["check_id", "accounting_date"])
    return marked.where(F.col("_first_close") < F.col("_day_close")).select("check_id", "accounting_date", "open_ts")


def replace_checks(current: DataFrame, rebuilt: DataFrame, changed: DataFrame) -> DataFrame:
    """`current` without the rows of the changed checks, plus their rebuilt rows."""
    return current.join(changed, "check_id", "left_anti").select(*current.columns).unionByName(rebuilt)
