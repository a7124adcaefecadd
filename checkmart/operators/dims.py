"""Dimensions and the date spine."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checkmart.functions.keys import hash_key
from checkmart.functions.times import calendar_attributes


def dim_dish(stg: DataFrame) -> DataFrame:
    """One row per dish and cleaned category, with flags that hold if any of its lines has them."""
    return (
        stg.where(F.col("dish_name").isNotNull())
        .groupBy("dish_name", "category_clean")
        .agg(
            F.bool_or("is_delivery_category").alias("has_delivery_category"),
            F.bool_or("is_service_item").alias("is_service_item"),
        )
        .select(
            hash_key(F.col("dish_name"), F.col("category_clean")).alias("dish_key"),
            "dish_name",
            "category_clean",
            "has_delivery_category",
            "is_service_item",
        )
    )


def merged_dishes(*parts: DataFrame) -> DataFrame:
    """One dimension from those of several sets of lines; equals the dimension of all lines together."""
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("dish_key", "dish_name", "category_clean")
        .agg(
            F.bool_or("has_delivery_category").alias("has_delivery_category"),
            F.bool_or("is_service_item").alias("is_service_item"),
        )
    )


def dim_order_type(stg: DataFrame) -> DataFrame:
    """One row per order type and its channel."""
    return (
        stg.where(F.col("order_type").isNotNull())
        .select("order_type", "channel_group")
        .distinct()
        .select(
            hash_key(F.col("order_type"), F.col("channel_group")).alias("order_type_key"),
            "order_type",
            "channel_group",
        )
    )


def date_bounds(stg: DataFrame, plan: DataFrame) -> DataFrame:
    """First and last date over check lines and plan, as one row."""
    dates = stg.select(F.col("accounting_date").alias("date_value")).union(plan.select("plan_date"))
    return dates.agg(F.min("date_value").alias("min_date"), F.max("date_value").alias("max_date"))


def merged_bounds(*parts: DataFrame) -> DataFrame:
    """First and last date of several bounds."""
    union = reduce(DataFrame.unionByName, parts)
    return union.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def calendar(bounds: DataFrame) -> DataFrame:
    """The calendar between two dates."""
    return date_spine(bounds).select("date_key", *calendar_attributes(F.col("date_key")))


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day from `min_date` to `max_date`, both included; no days when a bound is NULL."""
    days = F.sequence(F.col("min_date"), F.col("max_date"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date_key"))


def dim_date(stg: DataFrame, plan: DataFrame) -> DataFrame:
    """Calendar over all days between the first and the last date of facts and plan."""
    return calendar(date_bounds(stg, plan))
