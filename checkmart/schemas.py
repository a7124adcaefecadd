"""Declared schemas of the stored tables. Reads always pass one of these; nothing is inferred from data."""

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def schema_of(columns: str) -> T.StructType:
    """A nullable StructType from a comma-separated `name type` list; needs no session, unlike a DDL string."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SOURCE_CHECKS = schema_of(
    "source_row_id bigint, accounting_date date, check_id bigint, open_ts timestamp_ntz, open_hour int,"
    " close_ts timestamp_ntz, close_hour int, dish_name string, dish_category string, order_type string,"
    " qty double, guest_count int, amount_discount_rub double, source_system string, source_file string,"
    " source_sheet string, source_period string, source_row_number bigint, source_loaded_at timestamp_ntz"
)

RAW_CHECKS = T.StructType([*SOURCE_CHECKS.fields, T.StructField("extracted_at", T.TimestampNTZType())])

RAW_PLAN = schema_of(
    "plan_date date, plan_total_amount double, plan_restaurant_amount double, plan_banquet_own_amount double,"
    " plan_banquet_cb_amount double, plan_aggregator_amount double, plan_pickup_amount double,"
    " plan_delivery_amount double, plan_avg_check_restaurant double, plan_avg_check_delivery double,"
    " plan_avg_guest_restaurant double, plan_avg_guest_delivery double, plan_avg_guest_banquet double,"
    " source_file string, source_sheet string, loaded_at timestamp_ntz"
)

CHECKPOINTS = schema_of("source_name string, watermark bigint, updated_at timestamp_ntz")

UNSEEN_RANGES = schema_of("source_name string, first_id bigint, last_id bigint")

WITHDRAWN = schema_of("source_row_id bigint, check_id bigint")

FACT_CHECK_ITEMS = schema_of(
    "check_item_key string, source_row_id bigint, revenue_date date, check_id bigint, open_ts timestamp_ntz,"
    " close_ts timestamp_ntz, open_hour int, close_hour int, dish_key string, order_type_key string,"
    " dish_name string, dish_category string, category_clean string, is_delivery_category boolean,"
    " order_type string, channel_group string, qty double, guest_count int, amount_discount_rub double,"
    " is_service_item boolean, is_zero_amount_modifier boolean, is_turnover_item boolean,"
    " is_dish_sales_item boolean, check_duration_minutes bigint, is_long_duration_check boolean,"
    " is_suspicious_open_date boolean, source_period string, source_sheet string, extracted_at timestamp_ntz"
)

CONDENSED_CHECKS = schema_of(
    "revenue_date date, order_type string, channel_group string, check_id bigint, guest_count int,"
    " amount_discount_rub double, is_turnover_item boolean, close_ts timestamp_ntz"
)

# Checks without a line in the fact, with what their versions add up to.
OPEN_CHECKS = schema_of(
    "check_id bigint, raw_rows_count bigint, positive_qty_rows_count bigint, last_close_ts timestamp_ntz,"
    " first_accounting_date date, last_accounting_date date"
)

CHECK_IDS = schema_of("check_id bigint")

ACTUAL_DAILY = schema_of(
    "revenue_date date, checks_count bigint, guests_count bigint, fact_total_amount double,"
    " fact_restaurant_amount double, fact_delivery_amount double, fact_pickup_amount double,"
    " fact_banquet_amount double, fact_other_amount double, avg_check_per_order double, avg_check_per_guest double"
)

DATE_BOUNDS = schema_of("min_date date, max_date date")

DIM_DISH = schema_of(
    "dish_key string, dish_name string, category_clean string, has_delivery_category boolean, is_service_item boolean"
)

DIM_ORDER_TYPE = schema_of("order_type_key string, order_type string, channel_group string")

CANCELLED_CHECKS = schema_of(
    "check_id bigint, raw_rows_count bigint, last_close_ts timestamp_ntz, first_accounting_date date,"
    " last_accounting_date date, is_cancelled boolean"
)

MART_PLAN_FACT_DAILY = schema_of(
    "revenue_date date, checks_count bigint, guests_count bigint, fact_total_amount double, plan_total_amount double,"
    " plan_fact_delta_amount double, plan_completion_rate double, fact_restaurant_amount double,"
    " plan_restaurant_amount double, fact_delivery_amount double, plan_delivery_and_aggregator_amount double,"
    " fact_pickup_amount double, plan_pickup_amount double, fact_banquet_amount double, plan_banquet_amount double,"
    " fact_other_amount double, avg_check_per_order double, avg_check_per_guest double,"
    " plan_avg_check_restaurant double, plan_avg_check_delivery double, plan_avg_guest_restaurant double,"
    " plan_avg_guest_delivery double, plan_avg_guest_banquet double"
)

MART_CHANNEL_DAILY = schema_of(
    "revenue_date date, channel_group string, checks_count bigint, guests_count bigint, revenue_amount double,"
    " avg_check_per_order double, avg_revenue_per_guest double"
)

MART_ORDER_TYPE_DAILY = schema_of(
    "revenue_date date, order_type string, channel_group string, checks_count bigint, guests_count bigint,"
    " revenue_amount double, avg_check_per_order double, avg_revenue_per_guest double"
)

MART_DISH_SALES_DAILY = schema_of(
    "revenue_date date, category_clean string, dish_name string, qty_sold double, dish_revenue_amount double,"
    " checks_count bigint"
)

MART_DASHBOARD_DAILY = T.StructType(
    [
        *[f for f in MART_PLAN_FACT_DAILY.fields if not f.name.startswith("plan_avg_")],
        *schema_of(
            "prev_year_fact_total_amount double, prev_year_checks_count bigint, prev_year_guests_count bigint,"
            " prev_year_avg_check_per_order double, prev_year_avg_check_per_guest double, yoy_growth_rate double,"
            " yoy_checks_delta bigint, yoy_avg_check_delta double"
        ).fields,
    ]
)

MART_SCHEMAS = {
    "mart_plan_fact_daily": MART_PLAN_FACT_DAILY,
    "mart_channel_daily": MART_CHANNEL_DAILY,
    "mart_avg_check_by_order_type": MART_ORDER_TYPE_DAILY,
    "mart_dish_sales_daily": MART_DISH_SALES_DAILY,
    "mart_dashboard_daily": MART_DASHBOARD_DAILY,
}
