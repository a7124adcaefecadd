"""Adapters: other tables seen as check lines, as a daily plan, or as a text extract.

They give the operators real tables to run on: orders with their lines (years of dates, one order type per check) and
an event log (numbered rows, several versions per check, checks that span order types).
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.plans.staging import stage_checks, stage_plan
from checkmart.schemas import RAW_CHECKS, RAW_PLAN
from checkmart.vocabulary import DELIVERY_PREFIX, FACT_HEADERS, MODIFIER_CATEGORY, CheckRules

ORDER_RULES = CheckRules(
    channels={
        "delivery": ["1-URGENT"],
        "pickup": ["2-HIGH"],
        "restaurant": ["3-MEDIUM"],
        "banquet": ["4-NOT SPECIFIED"],
    },
    service_dishes=["red plate", "hot ring"],
)
EVENT_RULES = CheckRules(
    channels={"delivery": ["click"], "pickup": ["purchase"], "restaurant": ["signup"], "banquet": ["view"]},
    service_dishes=["dish-3", "dish-11"],
)
EVENT_CATEGORIES = [f"{DELIVERY_PREFIX}ПИЦЦА", "ПИЦЦА", MODIFIER_CATEGORY]
EVENT_PERIODS = ["2024-01 first half", "2024-01 second half"]

# Share of the day's planned total that every part of the plan gets.
PLAN_SHARES = {
    "plan_restaurant_amount": 0.4,
    "plan_banquet_own_amount": 0.05,
    "plan_banquet_cb_amount": 0.05,
    "plan_aggregator_amount": 0.2,
    "plan_pickup_amount": 0.1,
    "plan_delivery_amount": 0.2,
}
PLAN_AVERAGES = {
    "plan_avg_check_restaurant": 2500.0,
    "plan_avg_check_delivery": 1800.0,
    "plan_avg_guest_restaurant": 1250.0,
    "plan_avg_guest_delivery": 900.0,
    "plan_avg_guest_banquet": 3000.0,
}
PLAN_SHIFT_DAYS = 45


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_raw(df: DataFrame) -> DataFrame:
    # raw columns that the input does not have are typed NULLs
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in RAW_CHECKS.fields
        ]
    )


def raw_checks_from_orders(
    spark: SparkSession, sf_dir: str, pick: Callable[[DataFrame], DataFrame] = lambda lines: lines
) -> DataFrame:
    """Order lines as raw check lines: the order is the check, a returned line has quantity zero.

    `pick` chooses lines by check_id, close_ts and qty before they meet orders and parts, which add columns only.
    """
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "l_orderkey AS check_id",
        "CAST(l_shipdate AS TIMESTAMP_NTZ) AS close_ts",
        "CASE WHEN l_returnflag = 'R' THEN 0D ELSE CAST(l_quantity AS DOUBLE) END AS qty",
    )
    lines = pick(lines)
    orders, parts = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "part")
    joined = lines.join(parts, F.expr("l_partkey = p_partkey")).join(orders, F.expr("l_orderkey = o_orderkey"))
    # prices have two decimals and discounts whole percents, so cents times percents is exact
    net = "rint(l_extendedprice * 100) * (100 - rint(l_discount * 100)) / 10000"
    return _as_raw(
        joined.selectExpr(
            "CAST(o_orderdate AS DATE) AS accounting_date",
            "check_id",
            "o_orderdate - make_dt_interval(CAST(o_orderkey % 5 AS INT)) AS open_ts",
            "close_ts",
            "p_name AS dish_name",
            f"CASE WHEN p_type = 'PROMO' THEN concat('{DELIVERY_PREFIX}', p_brand)"
            f" WHEN p_type = 'SMALL' THEN '{MODIFIER_CATEGORY}' ELSE p_brand END AS dish_category",
            "o_orderpriority AS order_type",
            "qty",
            "1 + o_custkey % 4 AS guest_count",
            f"CASE WHEN p_type = 'SMALL' AND l_quantity <= 25 THEN 0D ELSE {net} END AS amount_discount_rub",
        ).selectExpr("*", "hour(open_ts) AS open_hour", "hour(close_ts) AS close_hour")
    )


def event_columns(events: DataFrame) -> DataFrame:
    """Events as raw check lines: a user's day is a check, re-sent at the end of every six-hour slot."""
    categories = ", ".join(f"'{c}'" for c in EVENT_CATEGORIES)
    slots = events.selectExpr(
        "*",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, (hour(ts) DIV 6 + 1) * 6) AS slot_end",
        f"CASE WHEN day(ts) <= 15 THEN '{EVENT_PERIODS[0]}' ELSE '{EVENT_PERIODS[1]}' END AS period",
    )
    return _as_raw(
        slots.selectExpr(
            "event_id + 1 AS source_row_id",
            "CAST(ts AS DATE) AS accounting_date",
            "user_id * 100 + day(ts) AS check_id",
            "ts AS open_ts",
            "hour(ts) AS open_hour",
            "slot_end AS close_ts",
            "hour(slot_end) AS close_hour",
            "CASE WHEN event_id % 89 <> 5 THEN concat('dish-', CAST(k % 20 AS STRING)) END AS dish_name",
            f"element_at(array({categories}), k % 3 + 1) AS dish_category",
            "CASE WHEN event_id % 97 <> 3 THEN event_type END AS order_type",
            "CASE WHEN event_type = 'error' THEN 0 ELSE 1 + event_id % 3 END AS qty",
            "1 + user_id % 4 AS guest_count",
            "CASE WHEN k % 3 = 2 AND k % 2 = 0 THEN 0D ELSE rint(value * 100) / 100 END AS amount_discount_rub",
            "'events' AS source_system",
            "'events.parquet' AS source_file",
            "period AS source_sheet",
            "period AS source_period",
            "event_id + 2 AS source_row_number",
        )
    )


def raw_checks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(_table(spark, sf_dir, "events"))


def raw_plan_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily plan from the order totals of 45 days earlier.

    Nothing is planned on the 13th of a month, and the corporate banquet part is missing on the first.
    """
    plan_date = F.date_add(F.col("o_orderdate").cast("date"), PLAN_SHIFT_DAYS)
    by_day = (
        _table(spark, sf_dir, "orders")
        .groupBy(plan_date.alias("plan_date"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("ordered"))
    )
    day = F.dayofmonth("plan_date")
    total = F.when(day == 13, 0.0).otherwise(F.col("ordered"))
    shares = {name: total * share for name, share in PLAN_SHARES.items()}
    shares["plan_banquet_cb_amount"] = F.when(day != 1, shares["plan_banquet_cb_amount"])
    columns = {
        "plan_date": F.col("plan_date"),
        "plan_total_amount": total,
        **shares,
        **{name: F.lit(value) for name, value in PLAN_AVERAGES.items()},
        "source_file": F.lit("orders.parquet"),
        "source_sheet": F.lit("plan"),
        "loaded_at": F.lit(None),
    }
    return by_day.select(*[columns[f.name].cast(f.dataType.simpleString()).alias(f.name) for f in RAW_PLAN.fields])


def stage_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_checks(raw_checks_from_orders(spark, sf_dir), ORDER_RULES)


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_checks(raw_checks_from_events(spark, sf_dir), EVENT_RULES)


def stage_order_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_plan(raw_plan_from_orders(spark, sf_dir))


def _every(n: int, when: int, broken: Column | None, c: Column) -> Column:
    # some cells of the text extract are broken, as in real extracts
    return F.when(F.col("source_row_id") % n == when, broken).otherwise(c)


def text_extract_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a text extract under the source headers, with blanks, tabs, junk and missing cells in places."""
    raw = raw_checks_from_events(spark, sf_dir)
    nothing = F.lit(None).cast("string")
    cells = {name: F.col(name).cast("string") for name in FACT_HEADERS.values()}
    dotted = F.date_format("accounting_date", "dd.MM.yyyy")
    cells["accounting_date"] = _every(37, 5, F.lit("no date"), _every(3, 1, dotted, cells["accounting_date"]))
    cells["check_id"] = _every(41, 3, nothing, _every(43, 7, F.lit("n/a"), cells["check_id"]))
    cells["close_ts"] = _every(31, 2, F.lit("2024"), cells["close_ts"])
    cells["open_hour"] = _every(11, 0, F.concat(cells["open_hour"], F.lit(".0")), cells["open_hour"])
    cells["qty"] = _every(23, 1, F.lit("x"), cells["qty"])
    cells["guest_count"] = _every(29, 4, F.lit(" "), cells["guest_count"])
    cells["amount_discount_rub"] = _every(19, 6, F.lit("12,5"), cells["amount_discount_rub"])
    blank = F.lit("\u00a0")
    cells["dish_name"] = _every(7, 2, F.concat(F.lit(" \t"), cells["dish_name"], blank), cells["dish_name"])
    cells["dish_category"] = _every(13, 4, F.lit(" \u00a0 "), cells["dish_category"])
    cells["order_type"] = _every(17, 8, nothing, F.concat(cells["order_type"], F.lit("\u2003")))
    return raw.select(
        *[cells[name].alias(header) for header, name in FACT_HEADERS.items()],
        F.col("source_row_number").cast("string").alias("source_row_number"),
    )
