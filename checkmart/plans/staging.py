"""Typed staging projections. They stay lazy: every consumer reads only the columns it needs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checkmart.functions.flags import channel_group, is_service_item, is_zero_amount_modifier, is_zero_qty
from checkmart.functions.text import category_clean, clean_text, is_delivery_category
from checkmart.functions.times import is_long_duration, is_suspicious_open, minutes_between
from checkmart.schemas import RAW_CHECKS, RAW_PLAN
from checkmart.vocabulary import RESTAURANT, CheckRules

TEXT_COLUMNS = ("dish_name", "dish_category", "order_type")


def typed_as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, in its order and types."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])


def stage_checks(raw: DataFrame, rules: CheckRules = RESTAURANT) -> DataFrame:
    """The 20 raw columns in their declared types, plus cleaned category, channel, flags and check duration."""
    typed = typed_as(raw, RAW_CHECKS).withColumns({name: clean_text(F.col(name)) for name in TEXT_COLUMNS})
    category, dish, amount = F.col("dish_category"), F.col("dish_name"), F.col("amount_discount_rub")
    open_ts, close_ts = F.col("open_ts"), F.col("close_ts")
    return typed.select(
        "*",
        category_clean(category, rules.delivery_prefix).alias("category_clean"),
        is_delivery_category(category, rules.delivery_prefix).alias("is_delivery_category"),
        channel_group(F.col("order_type"), rules.channels).alias("channel_group"),
        is_service_item(dish, rules.service_dishes).alias("is_service_item"),
        is_zero_amount_modifier(category, amount, rules.modifier_category).alias("is_zero_amount_modifier"),
        minutes_between(open_ts, close_ts).alias("check_duration_minutes"),
        is_long_duration(open_ts, close_ts).alias("is_long_duration_check"),
        is_suspicious_open(open_ts, F.col("accounting_date")).alias("is_suspicious_open_date"),
        is_zero_qty(F.col("qty")).alias("is_zero_qty_row"),
    )


def stage_plan(raw: DataFrame) -> DataFrame:
    """The 16 plan columns in their declared types."""
    return typed_as(raw, RAW_PLAN)
