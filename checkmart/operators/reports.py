"""Period reports over the daily marts. Filters come before aggregation, so they reach the mart scans."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checkmart.functions.numbers import guarded_ratio, money_sum
from checkmart.functions.text import fmt_money, fmt_number, fmt_percent
from checkmart.vocabulary import (
    DETAIL_HEADERS,
    DETAIL_PAGE_ROWS,
    NO_CATEGORY,
    SAMPLE_ROWS,
    TOP_DISHES,
)

Day = str | date | None


def filter_by_date(df: DataFrame, start: Day = None, end: Day = None, column: str = "revenue_date") -> DataFrame:
    """Rows from `start` to `end`, both included; a missing bound is open, a table without the column is kept whole."""
    if column not in df.columns:
        return df
    if start:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def default_period(daily: DataFrame) -> DataFrame:
    """First date, last date, and the default period: from the first day of the last month to the last date."""
    return daily.agg(F.min("revenue_date").alias("min_date"), F.max("revenue_date").alias("max_date")).select(
        "min_date",
        "max_date",
        F.trunc("max_date", "month").alias("start_date"),
        F.col("max_date").alias("end_date"),
    )


def period_kpis(daily: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Totals of a period and the ratios between them, as one row.

    Missing values count as zero, and so does an empty period. A ratio is NULL when its base is zero, and the
    difference to plan is NULL without a plan.
    """

    def total(name: str) -> Column:
        return F.coalesce(money_sum(F.col(name)), F.lit(0.0))

    def count(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint"))

    totals = filter_by_date(daily, start, end).agg(
        total("fact_total_amount").alias("fact_amount"),
        total("plan_total_amount").alias("plan_amount"),
        total("prev_year_fact_total_amount").alias("prev_year_amount"),
        count("checks_count").alias("checks_count"),
        count("guests_count").alias("guests_count"),
    )
    fact, plan, prev = F.col("fact_amount"), F.col("plan_amount"), F.col("prev_year_amount")
    return totals.select(
        "*",
        (guarded_ratio(fact, plan) * 100).alias("plan_completion_pct"),
        ((guarded_ratio(fact, prev) - 1) * 100).alias("yoy_growth_pct"),
        guarded_ratio(fact, F.col("checks_count")).alias("avg_check"),
        guarded_ratio(fact, F.col("guests_count")).alias("avg_guest"),
        F.when(plan != 0, fact - plan).alias("plan_delta_amount"),
    )


def channel_totals(channel_daily: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Revenue and checks of every channel in a period, highest revenue first; a NULL channel drops out."""
    return (
        filter_by_date(channel_daily, start, end)
        .dropna(subset=["channel_group"])
        .groupBy("channel_group")
        .agg(
            F.coalesce(money_sum(F.col("revenue_amount")), F.lit(0.0)).alias("revenue_amount"),
            F.coalesce(F.sum("checks_count"), F.lit(0).cast("bigint")).alias("checks_count"),
        )
        .orderBy(F.desc("revenue_amount"), "channel_group")
    )


def dish_totals(dish_daily: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Revenue and quantity by category and dish in a period; rows with a NULL key drop out."""
    return (
        filter_by_date(dish_daily, start, end)
        .dropna(subset=["category_clean", "dish_name"])
        .groupBy("category_clean", "dish_name")
        .agg(
            F.coalesce(money_sum(F.col("dish_revenue_amount")), F.lit(0.0)).alias("dish_revenue_amount"),
            F.coalesce(F.sum("qty_sold"), F.lit(0.0)).alias("qty_sold"),
        )
    )


def top_dishes(dish_daily: DataFrame, start: Day = None, end: Day = None, n: int = TOP_DISHES) -> DataFrame:
    """The n dishes with the highest revenue, shown in ascending order and labelled `dish / category`."""
    top = (
        dish_totals(dish_daily, start, end)
        .orderBy(F.desc("dish_revenue_amount"), "dish_name", "category_clean")
        .limit(n)
    )
    category = F.coalesce(F.col("category_clean"), F.lit(NO_CATEGORY))
    return top.withColumn("label", F.concat(F.col("dish_name"), F.lit(" / "), category)).orderBy(
        F.asc("dish_revenue_amount"), F.desc("dish_name"), F.desc("category_clean")
    )


def daily_detail_report(daily: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """The detail table of a period as formatted text, one row per day."""
    cells = [
        F.col("revenue_date").cast("string"),
        fmt_money(F.col("fact_total_amount")),
        fmt_money(F.col("plan_total_amount")),
        fmt_percent(F.col("plan_completion_rate") * 100),
        fmt_percent(F.col("yoy_growth_rate") * 100),
        fmt_number(F.col("checks_count")),
        fmt_money(F.col("avg_check_per_order")),
    ]
    rows = filter_by_date(daily, start, end).orderBy("revenue_date")
    return rows.select(*[cell.alias(header) for cell, header in zip(cells, DETAIL_HEADERS, strict=True)])


def daily_detail_page(daily: DataFrame, after: Day = None, n: int = DETAIL_PAGE_ROWS) -> DataFrame:
    """One page of the detail: the n days that follow `after`; the first page without it."""
    if after:
        daily = daily.where(F.col("revenue_date") > F.lit(after).cast("date"))
    return daily.orderBy("revenue_date").limit(n)


def sample_mart(mart: DataFrame, order: list[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """The first n rows in the given order, NULLs last."""
    return mart.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
