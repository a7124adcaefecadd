import pytest
from helpers import day, line, raw_checks, raw_plan
from pyspark.sql import functions as F

from checkmart.operators import daily, dims, reports
from checkmart.plans.fact import fact_check_items
from checkmart.plans.staging import stage_checks, stage_plan
from checkmart.schemas import CONDENSED_CHECKS, MART_DASHBOARD_DAILY, MART_SCHEMAS


@pytest.fixture(scope="module")
def raw(spark):
    later = {"accounting_date": "2026-02-02"}
    return raw_checks(
        spark,
        [
            line(1, "12:00", 1.0, 100.105),
            line(1, "12:00", 1.0, 50.0, order_type="Доставка курьером", dish_category="Д.ПАСТА"),
            line(1, "12:00", 1.0, 0.0, dish_category="МОДИФИКАТОРЫ", dish_name="соус"),
            line(1, "12:00", 1.0, -0.17, dish_name="Округление в пользу гостя"),
            line(2, "12:00", 2.0, 200.0, guest_count=3),
            line(3, "12:00", 1.0, 10.0, guest_count=0, **later),
            line(4, "12:00", 1.0, None, order_type=None, guest_count=None, accounting_date="2026-02-03"),
        ],
    )


@pytest.fixture(scope="module")
def fact(raw):
    return fact_check_items(raw)


@pytest.fixture(scope="module")
def plan(spark):
    part = {name: 10.0 for name in ("plan_restaurant_amount", "plan_pickup_amount", "plan_delivery_amount")}
    return stage_plan(
        raw_plan(
            spark,
            [
                {"plan_date": "2026-02-01", "plan_total_amount": 700.0, "plan_aggregator_amount": 5.0, **part},
                {"plan_date": "2026-02-02", "plan_total_amount": 0.0, "plan_banquet_own_amount": 1.0, **part},
                {"plan_date": "2026-02-05", "plan_total_amount": 9.0, **part},
            ],
        )
    )


def by_day(df):
    return {str(r.revenue_date): r for r in df.collect()}


def test_plan_fact(fact, plan):
    mart = daily.mart_plan_fact_daily(fact, plan)
    assert [(f.name, f.dataType) for f in mart.schema] == [
        (f.name, f.dataType) for f in MART_SCHEMAS["mart_plan_fact_daily"]
    ]
    rows = by_day(mart)
    assert sorted(rows) == ["2026-02-01", "2026-02-02", "2026-02-03", "2026-02-05"]
    first = rows["2026-02-01"]
    assert (first.checks_count, first.guests_count, first.fact_total_amount) == (2, 5, 349.94)
    # 349.935 - 700 from the unrounded amount, and the rate likewise
    assert (first.plan_fact_delta_amount, first.plan_completion_rate) == (-350.07, 0.4999)
    assert (first.fact_restaurant_amount, first.fact_delivery_amount) == (299.94, 50.0)
    assert first.plan_delivery_and_aggregator_amount == 15.0 and first.plan_banquet_amount is None
    second, third, planned = rows["2026-02-02"], rows["2026-02-03"], rows["2026-02-05"]
    assert second.plan_completion_rate is None and second.avg_check_per_guest is None
    assert second.avg_check_per_order == 10.0
    assert third.fact_total_amount is None and third.checks_count == 1 and third.plan_total_amount is None
    assert planned.checks_count is None and planned.fact_total_amount is None


def test_channels_do_not_add_up_in_checks_but_in_revenue(fact):
    rows = {(str(r.revenue_date), r.channel_group): r for r in daily.mart_channel_daily(fact).collect()}
    assert rows["2026-02-01", "restaurant"].checks_count == 2
    assert rows["2026-02-01", "delivery"].checks_count == 1
    total = by_day(daily.actual_daily(daily.check_level_daily(fact)))["2026-02-01"]
    channels = sum(r.revenue_amount for (d, _), r in rows.items() if d == "2026-02-01")
    assert total.checks_count == 2 and abs(total.fact_total_amount - channels) < 0.011
    pivot = by_day(daily.channel_pivot_daily(fact))["2026-02-01"]
    assert (pivot.restaurant_revenue, pivot.delivery_revenue, pivot.other_revenue) == (299.935, 50.0, 0.0)


def test_order_types(fact):
    mart = daily.mart_avg_check_by_order_type(fact)
    rows = {(str(r.revenue_date), r.order_type): r for r in mart.collect()}
    assert rows["2026-02-03", None].checks_count == 1
    assert rows["2026-02-01", "Доставка курьером"].avg_check_per_order == 50.0
    # the one-level form gives the same average
    by = ["revenue_date", "order_type", "channel_group"]
    simple = {(str(r.revenue_date), r.order_type): r for r in daily.avg_check_distinct(fact, by).collect()}
    assert {k: (r.checks_count, r.avg_check) for k, r in simple.items()} == {
        k: (r.checks_count, r.avg_check_per_order) for k, r in rows.items()
    }


def test_dish_sales(fact):
    rows = {(str(r.revenue_date), r.category_clean, r.dish_name): r for r in daily.mart_dish_sales_daily(fact).collect()}
    pasta = rows["2026-02-01", "ПАСТА", "Карбонара"]
    # 350.105 * 100 lies below the tie in binary, as in the SQL engine's scale-and-round
    assert (pasta.qty_sold, pasta.checks_count, pasta.dish_revenue_amount) in [(4.0, 2, 350.1), (4.0, 2, 350.11)]
    assert not any(dish in ("соус", "Округление в пользу гостя") for _, _, dish in rows)


def test_year_over_year(spark):
    days = ["2024-02-28", "2024-02-29", "2025-02-28", "2025-03-01", "2026-03-01"]
    plan_fact = spark.createDataFrame(
        [(day(d), n + 1, 10.0 * (n + 1), 2.0) for n, d in enumerate(days)],
        "revenue_date date, checks_count long, fact_total_amount double, avg_check_per_order double",
    )
    literal = daily.with_prev_year(plan_fact, ["checks_count"], literal=True)
    assert sorted((str(r.revenue_date), r.prev_year_checks_count) for r in literal.collect() if r.prev_year_checks_count) == [
        ("2025-02-28", 1), ("2025-02-28", 2), ("2026-03-01", 4)
    ]
    averages = {"avg_check_per_order": ("fact_total_amount", "checks_count")}
    merged = by_day(daily.with_prev_year(plan_fact, ["checks_count", "fact_total_amount"], averages))
    # 28 and 29 February 2024 are one day of the previous year, nothing is lost
    leap = merged["2025-02-28"]
    assert len(merged) == 5 and (leap.prev_year_checks_count, leap.prev_year_fact_total_amount) == (3, 30.0)
    assert leap.prev_year_avg_check_per_order == 10.0 and merged["2026-03-01"].prev_year_avg_check_per_order == 2.0


def test_dashboard(fact, plan):
    last_year = daily.mart_plan_fact_daily(fact, plan).withColumn("revenue_date", F.add_months("revenue_date", -12))
    last_year = last_year.withColumn("fact_total_amount", F.lit(300.0))
    mart = daily.mart_dashboard_daily(daily.mart_plan_fact_daily(fact, plan).unionByName(last_year))
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in MART_DASHBOARD_DAILY]
    first = by_day(mart)["2026-02-01"]
    assert (first.yoy_growth_rate, first.yoy_checks_delta, first.yoy_avg_check_delta) == (0.1665, 0, 0.0)
    assert by_day(mart)["2025-02-01"].yoy_growth_rate is None


def test_dimensions(raw, plan):
    stg = stage_checks(raw)
    dishes = {(r.dish_name, r.category_clean): r for r in dims.dim_dish(stg).collect()}
    # delivery and dine-in categories are one dish
    assert dishes["Карбонара", "ПАСТА"].has_delivery_category
    assert dishes["Округление в пользу гостя", "ПАСТА"].is_service_item
    assert {r.order_type for r in dims.dim_order_type(stg).collect()} == {"Заказ в ресторане", "Доставка курьером"}
    days = [str(r.date_key) for r in dims.dim_date(stg, plan).orderBy("date_key").collect()]
    assert days == [f"2026-02-0{n}" for n in range(1, 6)]
    nothing = dims.date_bounds(stg.limit(0), plan.limit(0))
    assert dims.date_spine(nothing).count() == 0


def test_marts_of_the_condensed_fact_are_the_same(fact, plan):
    checks = daily.condensed(fact)
    assert checks.count() < fact.count() and checks.schema.names == CONDENSED_CHECKS.names
    for mart in (
        daily.mart_channel_daily,
        daily.mart_avg_check_by_order_type,
        lambda lines: daily.mart_plan_fact_daily(lines, plan),
    ):
        assert sorted(map(str, mart(checks).collect())) == sorted(map(str, mart(fact).collect()))


def test_turnover_flag_never_changes_revenue(fact):
    flagged = daily.check_level(fact, ["revenue_date"]).agg(F.sum("check_revenue")).first()[0]
    assert abs(flagged - fact.agg(F.sum("amount_discount_rub")).first()[0]) < 1e-6


@pytest.fixture(scope="module")
def dashboard(spark):
    return spark.createDataFrame(
        [
            (day("2026-01-31"), 100.0, 80.0, 50.0, 4, 8),
            (day("2026-02-01"), 200.0, None, 100.0, 5, 0),
            (day("2026-02-02"), None, 40.0, None, None, None),
        ],
        "revenue_date date, fact_total_amount double, plan_total_amount double, prev_year_fact_total_amount double,"
        " checks_count long, guests_count long",
    )


def test_period_reports(dashboard):
    everything = reports.period_kpis(dashboard).first()
    assert (everything.fact_amount, everything.plan_amount, everything.checks_count) == (300.0, 120.0, 9)
    assert (everything.plan_completion_pct, everything.yoy_growth_pct) == (250.0, 100.0)
    assert (everything.avg_guest, everything.plan_delta_amount) == (37.5, 180.0)
    one = reports.period_kpis(dashboard, "2026-02-01", "2026-02-01").first()
    assert one.plan_completion_pct is None and one.plan_delta_amount is None and one.avg_guest is None
    nothing = reports.period_kpis(dashboard, "2030-01-01").first()
    assert nothing.fact_amount == 0.0 and nothing.checks_count == 0 and nothing.avg_check is None
    period = reports.default_period(dashboard).first()
    assert [str(v) for v in period] == ["2026-01-31", "2026-02-02", "2026-02-01", "2026-02-02"]
    assert list(reports.default_period(dashboard.limit(0)).first()) == [None] * 4


def test_filter_by_date(dashboard):
    assert reports.filter_by_date(dashboard, "2026-02-01").count() == 2
    assert reports.filter_by_date(dashboard, None, "2026-01-31").count() == 1
    assert reports.filter_by_date(dashboard).count() == 3
    assert reports.filter_by_date(dashboard.drop("revenue_date"), "2030-01-01").count() == 3


def test_pages(dashboard):
    first = reports.daily_detail_page(dashboard, n=2).collect()
    assert [str(r.revenue_date) for r in first] == ["2026-01-31", "2026-02-01"]
    second = reports.daily_detail_page(dashboard, after=first[-1].revenue_date, n=2).collect()
    assert [str(r.revenue_date) for r in second] == ["2026-02-02"]


def test_top_dishes_and_channels(spark):
    rows = [(day("2026-02-01"), "A" if n % 2 else "B", f"dish {n:02d}", 1.0, float(n // 2)) for n in range(20)]
    rows.append((day("2026-02-01"), None, "no category", 1.0, 999.0))
    dishes = spark.createDataFrame(
        rows, "revenue_date date, category_clean string, dish_name string, qty_sold double, dish_revenue_amount double"
    )
    top = reports.top_dishes(dishes).collect()
    assert len(top) == 15 and top[-1].label == "dish 18 / B" and top[0].dish_revenue_amount == 2.0
    assert [r.dish_revenue_amount for r in top] == sorted(r.dish_revenue_amount for r in top)
    channels = spark.createDataFrame(
        [(day("2026-02-01"), "pickup", 1.0, 1), (day("2026-02-02"), "delivery", 5.0, 2), (day("2026-02-02"), None, 9.0, 3)],
        "revenue_date date, channel_group string, revenue_amount double, checks_count long",
    )
    assert [tuple(r) for r in reports.channel_totals(channels).collect()] == [("delivery", 5.0, 2), ("pickup", 1.0, 1)]
