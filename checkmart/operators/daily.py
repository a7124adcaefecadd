"""Daily aggregates and marts.

Guest counts repeat on every line of a check, so measures first collapse to one row per check and then to days.
Both steps combine on the map side, so neither a hot check nor a busy day travels line by line.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checkmart.functions.numbers import guarded_ratio, money_sum, round_half_away

# Channels that have a column of their own in the plan-versus-fact mart, in column order.
PIVOT_CHANNELS = ["restaurant", "delivery", "pickup", "banquet", "other"]


def turnover(amount: Column) -> Column:
    """The amount on turnover lines, zero on the others."""
    return F.when(F.col("is_turnover_item"), amount).otherwise(0.0)


def channel_sums(
    amount: Column, turnover_flag: Column, channels: Sequence[str] = PIVOT_CHANNELS, suffix: str = "_revenue"
) -> list[Column]:
    """One conditional turnover sum per channel, all in one pass over the lines."""
    return [
        money_sum(F.when((F.col("channel_group") == channel) & turnover_flag, amount).otherwise(0.0)).alias(
            f"{channel}{suffix}"
        )
        for channel in channels
    ]


def check_level(fact: DataFrame, by: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """One row per check within `by`: guests once, turnover of the whole check."""
    return fact.groupBy(*by, "check_id").agg(
        F.max("guest_count").alias("guest_count"),
        money_sum(turnover(F.col("amount_discount_rub"))).alias("check_revenue"),
        *extra,
    )


def condensed(fact: DataFrame) -> DataFrame:
    """The fact with one row per check, day and order type, under the same column names.

    Guests are a maximum and turnover is a sum, so the daily and channel marts give the same result on it as on the
    lines. A refresh stores it once instead of reading all lines for every mart.
    """
    by = ["revenue_date", "order_type", "channel_group", "check_id"]
    return fact.groupBy(*by).agg(
        F.max("guest_count").alias("guest_count"),
        money_sum(turnover(F.col("amount_discount_rub"))).alias("amount_discount_rub"),
        F.lit(True).alias("is_turnover_item"),
        F.max("close_ts").alias("close_ts"),
    )


def check_level_daily(fact: DataFrame) -> DataFrame:
    """Check level by day, with the turnover split over the five channels."""
    return check_level(
        fact, ["revenue_date"], channel_sums(F.col("amount_discount_rub"), F.col("is_turnover_item"))
    )


def actual_daily(checks: DataFrame) -> DataFrame:
    """Day level from the check level: checks, guests, six unrounded revenues and two averages."""
    revenue = money_sum(F.col("check_revenue"))
    return checks.groupBy("revenue_date").agg(
        F.count("*").alias("checks_count"),
        F.sum("guest_count").alias("guests_count"),
        revenue.alias("fact_total_amount"),
        *[money_sum(F.col(f"{c}_revenue")).alias(f"fact_{c}_amount") for c in PIVOT_CHANNELS],
        guarded_ratio(revenue, F.count("*")).alias("avg_check_per_order"),
        guarded_ratio(revenue, F.sum("guest_count")).alias("avg_check_per_guest"),
    )


def channel_pivot_daily(fact: DataFrame) -> DataFrame:
    """Turnover of the five channels by day, in one pass."""
    return fact.groupBy("revenue_date").agg(
        *channel_sums(F.col("amount_discount_rub"), F.col("is_turnover_item"))
    )


def plan_fact_join(actual: DataFrame, plan: DataFrame) -> DataFrame:
    """Full outer join by day. Days known to one side only keep NULLs on the other."""
    joined = actual.join(plan, actual["revenue_date"] == plan["plan_date"], "full_outer")
    return joined.withColumn("revenue_date", F.coalesce(actual["revenue_date"], plan["plan_date"]))


def mart_plan_fact_daily(fact: DataFrame, plan: DataFrame) -> DataFrame:
    """Actual and planned revenue by day; differences and rates come from the unrounded amounts."""
    return plan_fact_of_days(actual_daily(check_level_daily(fact)), plan)


def plan_fact_of_days(actual: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan-versus-fact mart from the day level."""

    def money(c: Column) -> Column:
        return round_half_away(c, 2)

    total, planned = F.col("fact_total_amount"), F.col("plan_total_amount")
    delivery_plan = F.col("plan_delivery_amount") + F.col("plan_aggregator_amount")
    banquet_plan = F.col("plan_banquet_own_amount") + F.col("plan_banquet_cb_amount")
    return plan_fact_join(actual, plan).select(
        "revenue_date",
        "checks_count",
        "guests_count",
        money(total).alias("fact_total_amount"),
        money(planned).alias("plan_total_amount"),
        money(total - planned).alias("plan_fact_delta_amount"),
        round_half_away(guarded_ratio(total, planned), 4).alias("plan_completion_rate"),
        money(F.col("fact_restaurant_amount")).alias("fact_restaurant_amount"),
        money(F.col("plan_restaurant_amount")).alias("plan_restaurant_amount"),
        money(F.col("fact_delivery_amount")).alias("fact_delivery_amount"),
        money(delivery_plan).alias("plan_delivery_and_aggregator_amount"),
        money(F.col("fact_pickup_amount")).alias("fact_pickup_amount"),
        money(F.col("plan_pickup_amount")).alias("plan_pickup_amount"),
        money(F.col("fact_banquet_amount")).alias("fact_banquet_amount"),
        money(banquet_plan).alias("plan_banquet_amount"),
        money(F.col("fact_other_amount")).alias("fact_other_amount"),
        money(F.col("avg_check_per_order")).alias("avg_check_per_order"),
        money(F.col("avg_check_per_guest")).alias("avg_check_per_guest"),
        "plan_avg_check_restaurant",
        "plan_avg_check_delivery",
        "plan_avg_guest_restaurant",
        "plan_avg_guest_delivery",
        "plan_avg_guest_banquet",
    )


def _sales_by(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    revenue = money_sum(F.col("check_revenue"))
    return (
        check_level(fact, by)
        .groupBy(*by)
        .agg(
            F.count("*").alias("checks_count"),
            F.sum("guest_count").alias("guests_count"),
            round_half_away(revenue, 2).alias("revenue_amount"),
            round_half_away(guarded_ratio(revenue, F.count("*")), 2).alias("avg_check_per_order"),
            round_half_away(guarded_ratio(revenue, F.sum("guest_count")), 2).alias("avg_revenue_per_guest"),
        )
    )


def mart_channel_daily(fact: DataFrame) -> DataFrame:
    """Sales by day and channel. A check that spans channels counts in each of them."""
    return _sales_by(fact, ["revenue_date", "channel_group"])


def mart_avg_check_by_order_type(fact: DataFrame) -> DataFrame:
    """Sales by day, order type and channel; a NULL order type is a group of its own."""
    return _sales_by(fact, ["revenue_date", "order_type", "channel_group"])


def mart_dish_sales_daily(fact: DataFrame) -> DataFrame:
    """Dish sales by day, cleaned category and dish, without service lines and free modifiers.

    Lines collapse to one row per check within the group first, which makes the distinct check count a plain count.
    """
    by = ["revenue_date", "category_clean", "dish_name"]
    per_check = (
        fact.where(F.col("is_dish_sales_item"))
        .groupBy(*by, "check_id")
        .agg(money_sum(F.col("qty")).alias("qty"), money_sum(F.col("amount_discount_rub")).alias("amount"))
    )
    return per_check.groupBy(*by).agg(
        money_sum(F.col("qty")).alias("qty_sold"),
        round_half_away(money_sum(F.col("amount")), 2).alias("dish_revenue_amount"),
        F.count("check_id").alias("checks_count"),
    )


def avg_check_distinct(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    """Documented variant: average check as turnover over distinct checks, in one level."""
    revenue = money_sum(turnover(F.col("amount_discount_rub")))
    checks = F.count_distinct("check_id")
    return fact.groupBy(*by).agg(
        checks.alias("checks_count"), round_half_away(guarded_ratio(revenue, checks), 2).alias("avg_check")
    )


def _as_next_year(daily: DataFrame, totals: Sequence[str], averages: Mapping[str, tuple[str, str]]) -> DataFrame:
    """`daily` one calendar year later, one row per day: 28 and 29 February fall on one day and are added up."""
    kinds = dict(daily.dtypes)
    sums = [(money_sum(F.col(c)) if kinds[c] == "double" else F.sum(c)).alias(c) for c in totals]
    alone = [F.max(c).alias(f"_{c}") for c in averages]
    by_day = daily.groupBy(F.add_months("revenue_date", 12).alias("revenue_date")).agg(
        F.count("*").alias("_days"), *sums, *alone
    )
    recomputed = {
        c: F.when(F.col("_days") == 1, F.col(f"_{c}")).otherwise(
            round_half_away(guarded_ratio(F.col(amount), F.col(count)), 2)
        )
        for c, (amount, count) in averages.items()
    }
    return by_day.select("revenue_date", *totals, *[c.alias(name) for name, c in recomputed.items()])


def with_prev_year(
    daily: DataFrame,
    totals: Sequence[str],
    averages: Mapping[str, tuple[str, str]] | None = None,
    literal: bool = False,
) -> DataFrame:
    """Left self-join with the same calendar day one year before; its columns get the prefix `prev_year_`.

    29 February shifts to 28 February. There it is added to the day before: totals are summed and `averages`, given as
    (amount, count) by name, are computed anew, so every day stays a single row and no day is lost. With `literal` both
    days are joined as they are, and a 28 February after a leap year becomes two rows.

    Both sides read `daily`: pass a stored table.
    """
    averages = averages or {}
    columns = [*totals, *averages]
    if literal:
        prev = daily.select(F.add_months("revenue_date", 12).alias("revenue_date"), *columns)
    else:
        prev = _as_next_year(daily, totals, averages)
    prev = prev.withColumnsRenamed({c: f"prev_year_{c}" for c in columns})
    return daily.join(prev, "revenue_date", "left")


def mart_dashboard_daily(plan_fact: DataFrame) -> DataFrame:
    """The plan-versus-fact mart without its plan averages, plus the previous year and three changes against it.

    Reads `plan_fact` twice: pass the stored mart.
    """
    columns = [c for c in plan_fact.columns if not c.startswith("plan_avg_")]
    totals = ["fact_total_amount", "checks_count", "guests_count"]
    averages = {
        "avg_check_per_order": ("fact_total_amount", "checks_count"),
        "avg_check_per_guest": ("fact_total_amount", "guests_count"),
    }
    total, prev_total = F.col("fact_total_amount"), F.col("prev_year_fact_total_amount")
    checks_delta = F.col("checks_count") - F.col("prev_year_checks_count")
    avg_delta = F.col("avg_check_per_order") - F.col("prev_year_avg_check_per_order")
    return with_prev_year(plan_fact.select(*columns), totals, averages).select(
        *columns,
        *[f"prev_year_{c}" for c in [*totals, *averages]],
        round_half_away(guarded_ratio(total - prev_total, prev_total), 4).alias("yoy_growth_rate"),
        checks_delta.alias("yoy_checks_delta"),
        round_half_away(avg_delta, 2).alias("yoy_avg_check_delta"),
    )
