"""Every operator as a named query over the given tables: name -> callable(spark, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.functions import flags, keys, numbers, text, times
from checkmart.operators import daily, dims, quality, reports, versions
from checkmart.plans import refresh
from checkmart.plans.fact import fact_check_items, fact_columns, incremental_fact_refresh, read_fact
from checkmart.plans.staging import stage_checks
from checkmart.session import scratch_path, written
from checkmart.sources import adapters, extracts, incremental, tables
from checkmart.streaming.loads import stream_incremental_load
from checkmart.vocabulary import (
    CHANNEL_PATTERNS,
    DELIVERY_PREFIX,
    FACT_HEADERS,
    MODIFIER_CATEGORY,
    ORDER_TYPE_CHANNELS,
    PLAN_HEADERS,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Order-type patterns of the order table, for the pattern normaliser.
PRIORITY_PATTERNS = [
    ("%urgent%", "fast"),
    ("%-HIGH", "fast"),
    ("3%", "normal"),
    ("%not%", "open"),
    ("%specified%", "x"),
]
SERVICE_BRANDS = ["Brand#1", "Brand#2", f"{DELIVERY_PREFIX}Brand#3"]

# Columns of the staging line that hold no clock and no input path.
LINE = [
    "accounting_date", "check_id", "open_ts", "open_hour", "close_ts", "close_hour", "dish_name", "dish_category",
    "order_type", "qty", "guest_count", "amount_discount_rub",
]
DOTTED = extracts.DateText(["dd.MM.yyyy"])
LINEAGE = ["source_system", "source_sheet", "source_period", "source_row_number"]


def query(function: Query) -> Query:
    """Register under the function's name; a trailing `_query` keeps the name free for the operator."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def orders_fact(spark: SparkSession, sf: str) -> DataFrame:
    # final versions are picked from the lines alone, before they meet orders and parts
    final = adapters.raw_checks_from_orders(spark, sf, versions.final_versions)
    return fact_columns(stage_checks(final, adapters.ORDER_RULES))


def events_fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact_check_items(adapters.raw_checks_from_events(spark, sf), adapters.EVENT_RULES)


def plan_fact(spark: SparkSession, sf: str) -> DataFrame:
    return daily.mart_plan_fact_daily(orders_fact(spark, sf), adapters.stage_order_plan(spark, sf))


def dashboard(spark: SparkSession, sf: str) -> DataFrame:
    # the mart joins with itself, so its input is stored first, as in the refresh job
    return daily.mart_dashboard_daily(written(plan_fact(spark, sf), "plan-fact"))


def from_orders(columns: Callable[[], list[Column | str]]) -> Query:
    """Columns over the staged order lines; built on call, because a Column needs a session."""
    return lambda spark, sf: adapters.stage_orders(spark, sf).select(*columns())


def labelled(label: str, df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.lit(label))


def union(*parts: DataFrame) -> DataFrame:
    return extracts.union_periods(parts)


def named_order_type() -> Column:
    """One of the feed's order types, or NULL, by check."""
    names = [name for channel in ORDER_TYPE_CHANNELS.values() for name in channel]
    return F.get(F.lit(names), (F.col("check_id") % (len(names) + 1)).cast("int"))


# --- columns -------------------------------------------------------------------------------------------------------

ORDER_KEY = ["check_id", "dish_name", "close_ts"]

ORDER_COLUMNS: dict[str, Callable[[], list[Column | str]]] = {
    "category_clean": lambda: [
        *ORDER_KEY,
        "dish_category",
        text.category_clean(F.col("dish_category")).alias("category_clean"),
    ],
    "is_delivery_category": lambda: [
        *ORDER_KEY,
        "dish_category",
        text.is_delivery_category(F.col("dish_category")).alias("is_delivery_category"),
    ],
    "channel_group": lambda: [
        "check_id",
        "order_type",
        flags.channel_group(F.col("order_type"), adapters.ORDER_RULES.channels).alias("channel_group"),
    ],
    "is_service_item": lambda: [
        *ORDER_KEY,
        flags.is_service_item(F.col("dish_name"), adapters.ORDER_RULES.service_dishes).alias("is_service_item"),
    ],
    "is_zero_amount_modifier": lambda: [
        *ORDER_KEY,
        "amount_discount_rub",
        flags.is_zero_amount_modifier(F.col("dish_category"), F.col("amount_discount_rub")).alias("is_zero_modifier"),
    ],
    "is_long_duration_check": lambda: [
        *ORDER_KEY,
        "open_ts",
        times.is_long_duration(F.col("open_ts"), F.col("close_ts")).alias("is_long"),
    ],
    "is_suspicious_open_date": lambda: [
        "check_id",
        "open_ts",
        "accounting_date",
        times.is_suspicious_open(F.col("open_ts"), F.col("accounting_date")).alias("is_suspicious"),
    ],
    "is_zero_qty_row": lambda: [*ORDER_KEY, "qty", flags.is_zero_qty(F.col("qty")).alias("is_zero_qty")],
    "service_category_flags": lambda: [
        *ORDER_KEY,
        "dish_category",
        flags.is_service_category(F.col("dish_category"), SERVICE_BRANDS).alias("is_service_category"),
        flags.is_modifier(F.col("dish_category")).alias("is_modifier"),
    ],
    "is_multiday_check": lambda: [
        "check_id",
        "open_ts",
        "accounting_date",
        times.is_multiday_check(F.col("open_ts"), F.col("accounting_date")).alias("is_multiday"),
    ],
    "is_rounding_adjustment": lambda: [
        *ORDER_KEY,
        flags.is_rounding_adjustment(F.col("dish_name"), "red plate").alias("is_rounding"),
    ],
    "normalize_channel_patterns": lambda: [
        "check_id",
        "order_type",
        text.normalize_channel(F.col("order_type"), PRIORITY_PATTERNS, "other").alias("channel"),
        named_order_type().alias("named_order_type"),
        text.normalize_channel(named_order_type(), CHANNEL_PATTERNS, "other").alias("named_channel"),
    ],
}
QUERIES.update({name: from_orders(columns) for name, columns in ORDER_COLUMNS.items()})


@query
def dish_name_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """Dish names decorated with the prefix and the trailing plus, then normalised."""
    stg = adapters.stage_orders(spark, sf)
    plus = F.when(F.col("is_long_duration_check"), " + ").otherwise(F.lit(""))
    decorated = stg.withColumn("decorated", F.concat(F.lit(DELIVERY_PREFIX), "dish_name", plus))
    return decorated.select("check_id", "decorated", text.dish_name_normalized(F.col("decorated")).alias("dish"))


@query
def check_duration_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes from a midnight near every event to the event, either way, and from opening to close of order lines."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("event_id") % 40).cast("int"))
    previous = F.when(F.col("event_id") % 50 != 0, day.cast("timestamp_ntz"))
    gaps = events.withColumn("previous_ts", previous).select(
        F.col("event_id").alias("row_id"),
        times.minutes_between(F.col("previous_ts"), F.col("ts")).alias("minutes"),
        times.is_long_duration(F.col("previous_ts"), F.col("ts"), 1).alias("is_long"),
    )
    lines = adapters.stage_orders(spark, sf).select(
        F.col("check_id").alias("row_id"),
        F.col("check_duration_minutes").alias("minutes"),
        F.col("is_long_duration_check").alias("is_long"),
    )
    return union(labelled("event gap", gaps), labelled("order line", lines))


@query
def open_date_hour(spark: SparkSession, sf: str) -> DataFrame:
    opened = F.col("open_ts")
    return adapters.stage_events(spark, sf).select(
        "source_row_id", times.open_date(opened).alias("open_date"), times.open_hour(opened).alias("open_hour")
    )


@query
def excel_serial_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Event ids as serial numbers: a day number plus a fraction of a day."""
    serial = 46054 + F.col("event_id") / F.lit(977.0)
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", times.excel_serial_to_ts(serial).alias("serial_ts"), serial.alias("serial")
    )


@query
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    cells = extracts.rename_columns(adapters.text_extract_from_events(spark, sf), FACT_HEADERS)
    return cells.select(
        F.col("source_row_number"),
        numbers.to_number(F.col("qty")).alias("qty"),
        numbers.to_number(F.col("amount_discount_rub")).alias("amount"),
        numbers.to_number(F.col("check_id"), as_int=True).alias("check_id"),
        numbers.to_number(F.col("open_hour"), as_int=True).alias("open_hour"),
        numbers.to_number(F.col("guest_count"), as_int=True).alias("guest_count"),
    )


@query
def coerce_datetime(spark: SparkSession, sf: str) -> DataFrame:
    cells = extracts.rename_columns(adapters.text_extract_from_events(spark, sf), FACT_HEADERS)
    return cells.select(
        F.col("source_row_number"),
        times.to_day(F.col("accounting_date"), *DOTTED).alias("accounting_date"),
        times.to_ts(F.col("open_ts")).alias("open_ts"),
        times.to_day(F.col("open_ts")).alias("open_day"),
        times.to_ts(F.col("close_ts")).alias("close_ts"),
    )


@query
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Event cells, and whole documents."""
    cells = extracts.rename_columns(adapters.text_extract_from_events(spark, sf), FACT_HEADERS)
    lines = cells.select(
        F.col("source_row_number").cast("bigint").alias("row_id"),
        text.clean_text(F.col("dish_name")).alias("first"),
        text.clean_text(F.col("dish_category")).alias("second"),
        text.clean_text(F.col("order_type")).alias("third"),
    )
    documents = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").cast("bigint").alias("row_id"),
        F.md5(text.clean_text(F.col("text"))).alias("first"),
        text.clean_text(F.col("lang")).alias("second"),
        text.clean_text(F.col("source")).alias("third"),
    )
    return union(labelled("line", lines), labelled("document", documents))


@query
def fact_flags(spark: SparkSession, sf: str) -> DataFrame:
    service, modifier = F.col("is_service_item"), F.col("is_zero_amount_modifier")
    return adapters.stage_orders(spark, sf).select(
        *ORDER_KEY,
        "amount_discount_rub",
        flags.is_turnover_item(modifier).alias("is_turnover_item"),
        flags.is_dish_sales_item(service, modifier).alias("is_dish_sales_item"),
    )


@query
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    fact = events_fact(spark, sf)
    return fact.select("source_row_id", "check_item_key", "dish_key", "order_type_key")


@query
def guarded_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Fact to plan, and revenue per guest, of every day; days without plan, fact or guests give NULL."""
    mart = plan_fact(spark, sf)
    return mart.select(
        "revenue_date",
        numbers.guarded_ratio(F.col("fact_total_amount"), F.col("plan_total_amount")).alias("fact_to_plan"),
        numbers.guarded_ratio(F.col("fact_total_amount"), F.col("guests_count")).alias("per_guest"),
        numbers.guarded_ratio(F.col("plan_pickup_amount"), F.col("fact_pickup_amount")).alias("pickup_plan_to_fact"),
    )


# --- staging -------------------------------------------------------------------------------------------------------


@query
def stg_checks(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.stage_orders(spark, sf)


@query
def stg_plan_daily(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.stage_order_plan(spark, sf)


# --- versions and fact -----------------------------------------------------------------------------------------------


@query
def positive_qty(spark: SparkSession, sf: str) -> DataFrame:
    return versions.positive_qty(adapters.stage_orders(spark, sf)).select(*ORDER_KEY, "qty", "amount_discount_rub")


@query
def check_final_close(spark: SparkSession, sf: str) -> DataFrame:
    return versions.check_final_close(adapters.stage_events(spark, sf))


@query
def final_versions(spark: SparkSession, sf: str) -> DataFrame:
    final = versions.final_versions(adapters.raw_checks_from_events(spark, sf))
    return stage_checks(final, adapters.EVENT_RULES).select("source_row_id", *LINE, "channel_group")


@query
def check_versions(spark: SparkSession, sf: str) -> DataFrame:
    return versions.check_versions(adapters.stage_events(spark, sf))


@query
def cancelled_checks(spark: SparkSession, sf: str) -> DataFrame:
    return versions.cancelled_checks(adapters.stage_events(spark, sf))


@query
def latest_line_per_check_day(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_line_per_check_day(adapters.stage_events(spark, sf), [MODIFIER_CATEGORY]).select(
        "source_row_id", *LINE
    )


@query
def superseded_versions(spark: SparkSession, sf: str) -> DataFrame:
    return versions.superseded_versions(adapters.stage_events(spark, sf))


QUERIES["fact_check_items"] = events_fact


@query
def fact_check_items_orders(spark: SparkSession, sf: str) -> DataFrame:
    return orders_fact(spark, sf)


# --- dimensions ------------------------------------------------------------------------------------------------------


@query
def dim_dish(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_dish(adapters.stage_events(spark, sf))


@query
def dim_order_type(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_order_type(adapters.stage_events(spark, sf))


@query
def date_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return dims.date_bounds(adapters.stage_orders(spark, sf), adapters.stage_order_plan(spark, sf))


@query
def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    return dims.date_spine(date_bounds(spark, sf))


@query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_date(adapters.stage_orders(spark, sf), adapters.stage_order_plan(spark, sf))


# --- daily aggregates and marts --------------------------------------------------------------------------------------


@query
def check_level_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily.check_level_daily(events_fact(spark, sf))


@query
def channel_pivot_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily.channel_pivot_daily(events_fact(spark, sf))


@query
def actual_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily.actual_daily(daily.check_level_daily(orders_fact(spark, sf)))


@query
def mart_plan_fact_daily(spark: SparkSession, sf: str) -> DataFrame:
    return plan_fact(spark, sf)


@query
def mart_channel_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily.mart_channel_daily(events_fact(spark, sf))


@query
def mart_avg_check_by_order_type(spark: SparkSession, sf: str) -> DataFrame:
    return daily.mart_avg_check_by_order_type(events_fact(spark, sf))


@query
def mart_dish_sales_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily.mart_dish_sales_daily(orders_fact(spark, sf))


@query
def mart_dashboard_daily(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard(spark, sf)


@query
def yoy_shift_join(spark: SparkSession, sf: str) -> DataFrame:
    """The literal join: 28 February after a leap year meets two days of the previous year."""
    actual = daily.actual_daily(daily.check_level_daily(orders_fact(spark, sf)))
    stored = written(actual.select("revenue_date", "checks_count", "fact_total_amount"), "actual-daily")
    return daily.with_prev_year(stored, ["checks_count", "fact_total_amount"], literal=True)


@query
def avg_check_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return daily.avg_check_distinct(events_fact(spark, sf), ["revenue_date", "order_type", "channel_group"])


# --- reports ---------------------------------------------------------------------------------------------------------


@query
def default_period(spark: SparkSession, sf: str) -> DataFrame:
    return reports.default_period(plan_fact(spark, sf))


@query
def filter_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """The daily mart unfiltered, from a day, up to a day, and between two days."""
    mart = written(plan_fact(spark, sf).select("revenue_date", "checks_count", "fact_total_amount"), "plan-fact")
    start, end = "1996-02-10", "1998-03-05"
    return union(
        labelled("all", reports.filter_by_date(mart)),
        labelled("from", reports.filter_by_date(mart, start)),
        labelled("up to", reports.filter_by_date(mart, None, end)),
        labelled("between", reports.filter_by_date(mart, start, end)),
    )


@query
def period_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the whole range, of one year, and of a period without data."""
    mart = written(dashboard(spark, sf), "dashboard")
    return union(
        labelled("all", reports.period_kpis(mart)),
        labelled("1997", reports.period_kpis(mart, "1997-01-01", "1997-12-31")),
        labelled("none", reports.period_kpis(mart, "1890-01-01", "1890-12-31")),
    )


@query
def channel_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reports.channel_totals(daily.mart_channel_daily(events_fact(spark, sf)))


@query
def dish_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dish_totals(daily.mart_dish_sales_daily(orders_fact(spark, sf)))


@query
def top_dishes(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_dishes(daily.mart_dish_sales_daily(orders_fact(spark, sf)))


@query
def daily_detail_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.daily_detail_report(dashboard(spark, sf))


@query
def daily_detail_page(spark: SparkSession, sf: str) -> DataFrame:
    """The first page and the page after a day."""
    mart = written(plan_fact(spark, sf).select("revenue_date", "checks_count", "fact_total_amount"), "plan-fact")
    return union(
        labelled("first", reports.daily_detail_page(mart)),
        labelled("next", reports.daily_detail_page(mart, "1997-02-20")),
    )


@query
def sample_marts(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten rows of three marts."""

    def sample(label: str, mart: DataFrame, order: list[str], group: str | None, revenue: str) -> DataFrame:
        columns = [
            "revenue_date",
            (F.col(group) if group else F.lit(None).cast("string")).alias("group_name"),
            "checks_count",
            F.col(revenue).alias("revenue"),
        ]
        return labelled(label, reports.sample_mart(mart, order).select(*columns))

    fact = events_fact(spark, sf)
    order_types = daily.mart_avg_check_by_order_type(fact)
    return union(
        sample("plan_fact", plan_fact(spark, sf), ["revenue_date"], None, "fact_total_amount"),
        sample(
            "channel",
            daily.mart_channel_daily(fact),
            ["revenue_date", "channel_group"],
            "channel_group",
            "revenue_amount",
        ),
        sample("order_type", order_types, ["revenue_date", "order_type"], "order_type", "revenue_amount"),
    )


@query
def read_mart(spark: SparkSession, sf: str) -> DataFrame:
    """A mart stored in its layer and read back: chosen columns, in date and descending revenue order."""
    root = scratch_path(spark, "warehouse")
    tables.materialize(daily.mart_dish_sales_daily(orders_fact(spark, sf)), root, "mart", "mart_dish_sales_daily")
    columns = ["revenue_date", "category_clean", "dish_name", "dish_revenue_amount"]
    order = ["revenue_date", F.desc_nulls_last("dish_revenue_amount")]
    return tables.read_mart(spark, root, "mart_dish_sales_daily", columns, order)[0]


# --- extracts and incremental loading --------------------------------------------------------------------------------


def stored_extract(spark: SparkSession, sf: str) -> str:
    """The text extract of the events as a CSV folder."""
    path = scratch_path(spark, "extract")
    # tabs and blanks at cell ends belong to the data
    adapters.text_extract_from_events(spark, sf).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


@query
def scan_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The events written as a CSV extract and read back as check lines."""
    read = extracts.read_fact_extract(spark, stored_extract(spark, sf), "2024-01", dates=DOTTED)
    return read.select(*LINE, *LINEAGE)


@query
def scan_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The plan written as CSV with two header lines and a foreign column, and read back by header occurrence."""
    path = scratch_path(spark, "plan-extract")
    plan = adapters.raw_plan_from_orders(spark, sf)
    cells = {
        "foreign": F.lit("note"),
        **{name: F.col(name).cast("string") for name in PLAN_HEADERS.values()},
    }
    cells["plan_date"] = F.when(F.dayofmonth("plan_date") % 2 == 0, F.date_format("plan_date", "dd.MM.yyyy")).otherwise(
        cells["plan_date"]
    )
    body = plan.select(*[c.alias(name) for name, c in cells.items()])
    titles = {"foreign": "Комментарий", **{name: header for (header, _), name in PLAN_HEADERS.items()}}
    first = spark.range(1).select(
        *[F.lit("План" if name == "plan_total_amount" else " ").alias(name) for name in cells]
    )
    second = spark.range(1).select(*[F.lit(titles[name]).alias(name) for name in cells])
    union(first, second, body).write.csv(path, header=False)
    read = extracts.read_plan_extract(spark, path, "plan", dates=DOTTED)
    return read.drop("source_file", "loaded_at")


@query
def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Source headers renamed and pruned to the canonical columns in their order."""
    cells = adapters.text_extract_from_events(spark, sf)
    return extracts.rename_columns(cells, FACT_HEADERS).select(*FACT_HEADERS.values())


@query
def drop_unkeyed(spark: SparkSession, sf: str) -> DataFrame:
    cells = extracts.rename_columns(adapters.text_extract_from_events(spark, sf), FACT_HEADERS)
    typed = extracts.coerce_fact(cells, DOTTED)
    return extracts.drop_unkeyed(typed, ["accounting_date", "check_id"]).select(
        "source_row_number", "accounting_date", "check_id"
    )


def event_periods(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The events as one frame per period, without row ids."""
    raw = adapters.raw_checks_from_events(spark, sf).drop("source_row_id", "extracted_at")
    return [raw.where(F.col("source_period") == period) for period in adapters.EVENT_PERIODS]


@query
def with_lineage(spark: SparkSession, sf: str) -> DataFrame:
    lines = adapters.raw_checks_from_events(spark, sf).select("source_row_number", "check_id", "amount_discount_rub")
    return extracts.with_lineage(lines, "2024-01", "january", "events.parquet", "events")


@query
def union_periods(spark: SparkSession, sf: str) -> DataFrame:
    return extracts.union_periods(event_periods(spark, sf)).select(*LINE, *LINEAGE)


@query
def assign_row_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids through the periods in list order: the second half of the month first, then the first half."""
    periods = list(reversed(adapters.EVENT_PERIODS))
    numbered = extracts.build_source(event_periods(spark, sf), periods)
    return numbered.select("source_row_id", "source_period", "source_row_number", "check_id")


@query
def period_stats(spark: SparkSession, sf: str) -> DataFrame:
    return extracts.period_stats(adapters.raw_checks_from_events(spark, sf))


def first_half_mark(spark: SparkSession, sf: str) -> int:
    """Highest row id of the first period, as a run after that period would have stored it."""
    first = event_source(spark, sf).where(F.col("source_period") == adapters.EVENT_PERIODS[0])
    return incremental.source_watermark(first).first()["watermark"]


def event_source(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.raw_checks_from_events(spark, sf).drop("extracted_at")


@query
def incremental_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: up to the mark of the first period, then everything above it."""
    source, mark = event_source(spark, sf), first_half_mark(spark, sf)
    runs = [
        labelled("first run", incremental.incremental_extract(source, 0, mark)),
        labelled("second run", incremental.incremental_extract(source, mark)),
    ]
    return union(*runs).select("label", "source_row_id", *LINE, *LINEAGE)


@query
def source_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.source_watermark(event_source(spark, sf))


def event_checkpoints(spark: SparkSession, sf: str, period: str | None = None) -> DataFrame:
    """A checkpoint per event type: its highest row id and latest time, in a period or in the whole log."""
    lines = event_source(spark, sf).where(F.col("order_type").isNotNull())
    if period:
        lines = lines.where(F.col("source_period") == period)
    return lines.groupBy(F.col("order_type").alias("source_name")).agg(
        F.max("source_row_id").alias("watermark"), F.max("open_ts").alias("updated_at")
    )


@query
def read_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """The stored mark of a known and of an unknown source."""
    checkpoints = event_checkpoints(spark, sf)
    return union(
        labelled("click", incremental.read_watermark(checkpoints, "click")),
        labelled("unknown", incremental.read_watermark(checkpoints, "unknown")),
    )


@query
def upsert_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Marks of the first period, then updates: higher ones, a lower one, and a new source."""
    first, second = (event_checkpoints(spark, sf, period) for period in adapters.EVENT_PERIODS)
    lower = F.when(F.col("source_name") == "view", 1).otherwise(F.col("watermark")).cast("bigint")
    renamed = F.when(F.col("source_name") == "error", "fault").otherwise(F.col("source_name"))
    updates = second.withColumn("watermark", lower).withColumn("source_name", renamed)
    return incremental.upsert_checkpoint(first, updates)


@query
def stream_incremental_load_query(spark: SparkSession, sf: str) -> DataFrame:
    """The event file streamed into the raw table; must equal the batch load."""
    root = scratch_path(spark, "stream")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = stream_incremental_load(
        spark,
        f"{sf}/events*.parquet",
        root,
        f"{root}/checkpoint",
        schema,
        lambda batch: adapters.event_columns(batch).drop("extracted_at"),
    )
    stream.awaitTermination()
    return incremental.read_raw_checks(spark, root).select("source_row_id", *LINE, *LINEAGE)


@query
def incremental_fact_refresh_query(spark: SparkSession, sf: str) -> DataFrame:
    """The fact of the lines below a mark, refreshed with the lines above it; must equal a full rebuild.

    The mark falls inside a day, so that checks of that day exist on both sides.
    """
    raw = adapters.raw_checks_from_events(spark, sf)
    mark = incremental.source_watermark(raw).first()["watermark"] // 2
    fact = written(fact_check_items(raw.where(F.col("source_row_id") <= mark), adapters.EVENT_RULES), "fact")
    new_lines = incremental.incremental_extract(raw, mark)
    changed = written(new_lines.select("check_id").distinct(), "changed")
    return incremental_fact_refresh(raw, fact, changed, adapters.EVENT_RULES)


@query
def refresh_job_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The published fact after two runs of the refresh job, the later lines first; must equal a full rebuild.

    The first run stops short of some ids too, which the second one finds below the mark.
    """
    root = scratch_path(spark, "refresh-job")
    source = event_source(spark, sf)
    late = (F.col("source_row_id") > incremental.source_watermark(source).first()["watermark"] // 2) | (
        F.col("source_row_id") % 977 == 5
    )
    for part in (source.where(late), source):
        refresh.run_fact_refresh(spark, root, part, rules=adapters.EVENT_RULES, suite=[], incremental=True)
    return read_fact(spark, root).withColumn("extracted_at", F.lit(None).cast("timestamp_ntz"))


# --- quality ---------------------------------------------------------------------------------------------------------


def broken_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Staged event lines with violations of every check put in."""
    stg = adapters.stage_events(spark, sf)
    row = F.col("source_row_id")
    return stg.withColumns(
        {
            "channel_group": F.when(row % 50 == 7, "kiosk").when(row % 50 == 8, None).otherwise(F.col("channel_group")),
            "dish_name": F.when(row % 40 != 3, F.col("dish_name")),
            "source_row_id": F.when(row % 30 == 1, row - 1).when(row % 90 != 5, row),
        }
    )


@query
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["source_row_id", "accounting_date", "check_id", "dish_name", "channel_group"]
    return quality.not_null(broken_lines(spark, sf), columns)


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique(broken_lines(spark, sf), "source_row_id")


@query
def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return quality.accepted_values(broken_lines(spark, sf), "channel_group", quality.CHANNELS)


@query
def dq_relationship(spark: SparkSession, sf: str) -> DataFrame:
    """Dishes of the lines that the dimension of the final lines lacks."""
    lines = adapters.stage_orders(spark, sf).withColumn(
        "dish_key", keys.hash_key(F.col("dish_name"), F.col("category_clean"))
    )
    return quality.relationship(lines, "dish_key", dims.dim_dish(versions.final_versions(lines)))


@query
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """The declared suite over broken lines and over all layers built from the orders."""
    stg, plan = adapters.stage_orders(spark, sf), adapters.stage_order_plan(spark, sf)
    fact = written(orders_fact(spark, sf), "fact")
    mart = written(daily.mart_plan_fact_daily(fact, plan), "plan-fact")
    layers = {
        "stg_plan_daily": plan,
        "dim_date": dims.dim_date(stg, plan),
        "dim_dish": dims.dim_dish(stg),
        "dim_order_type": dims.dim_order_type(stg),
        "fact_check_items": fact,
        "cancelled_checks": versions.cancelled_checks(stg),
        "mart_plan_fact_daily": mart,
        "mart_channel_daily": daily.mart_channel_daily(fact),
        "mart_avg_check_by_order_type": daily.mart_avg_check_by_order_type(fact),
        "mart_dish_sales_daily": daily.mart_dish_sales_daily(fact),
        "mart_dashboard_daily": daily.mart_dashboard_daily(mart),
    }
    suite = [*quality.CHECK_SUITE, *quality.RELATIONSHIP_SUITE]
    return quality.dq_report({"stg_checks": broken_lines(spark, sf), **layers}, suite)
