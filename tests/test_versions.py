import random

import pytest
from helpers import line, raw_checks
from pyspark.sql import functions as F

from checkmart.operators import versions
from checkmart.plans.fact import fact_check_items, incremental_fact_refresh
from checkmart.plans.staging import stage_checks
from checkmart.session import written


@pytest.fixture(scope="module")
def lines(spark):
    return raw_checks(
        spark,
        [
            line(39558, "12:04", 0.0),
            line(39558, "14:15", 0.0),
            line(39558, "22:22", 1.0, 510.0),
            line(2, "11:00", 1.0, 5.0),
            line(2, "12:00", 1.0, 7.0),
            line(2, "12:00", 2.0, 8.0),
            line(2, "12:00", 0.0, 9.0),
            line(2, "13:00", 0.0, 9.0),
            line(3, "12:00", 0.0),
            line(4, "12:00", -1.0, -3.0),
            line(5, None, 1.0, 1.0),
            line(6, "12:00", None, 1.0),
            line(7, "12:00", 1.0, 1.0, accounting_date="2025-02-01"),
            line(7, "13:00", 1.0, 2.0),
            line(None, "12:00", 1.0, 1.0),
        ],
    )


def ids(df):
    return sorted(r.source_row_id for r in df.select("source_row_id").collect())


def test_final_versions(spark, lines):
    assert ids(versions.final_versions(lines)) == [3, 5, 6, 14]


def test_final_versions_against_brute_force(spark):
    draw = random.Random(3)
    # check 1 holds a third of all rows, all of its final version among them
    rows = [
        line(1 if draw.random() < 0.34 else draw.randint(2, 60), f"1{draw.randint(0, 3)}:00", draw.choice([0.0, 1.0, 2.0]))
        for _ in range(900)
    ]
    latest = {}
    for row in rows:
        if row["qty"] > 0:
            latest[row["check_id"]] = max(latest.get(row["check_id"], ""), row["close_ts"])
    expected = [n for n, r in enumerate(rows, 1) if r["qty"] > 0 and r["close_ts"] == latest[r["check_id"]]]
    df = raw_checks(spark, rows).repartition(6)
    for broadcast in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        assert ids(versions.final_versions(df)) == expected
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_final_versions_by_check_and_day(lines):
    assert ids(versions.final_versions(lines, keys=["check_id", "accounting_date"])) == [3, 5, 6, 13, 14]


def test_check_summaries(lines):
    closes = {r.check_id: str(r.final_close_ts)[11:16] for r in versions.check_final_close(lines).collect() if r.final_close_ts}
    assert closes == {39558: "22:22", 2: "12:00", 7: "13:00", None: "12:00"}
    summary = {r.check_id: r for r in versions.check_versions(lines).collect()}
    assert (summary[2].raw_rows_count, summary[2].positive_qty_rows_count) == (5, 3)
    assert str(summary[7].first_accounting_date) == "2025-02-01"
    assert str(summary[7].last_accounting_date) == "2026-02-01"
    cancelled = versions.cancelled_checks(lines)
    assert sorted(r.check_id for r in cancelled.collect()) == [3, 4, 6]
    assert cancelled.columns == [
        "check_id", "raw_rows_count", "last_close_ts", "first_accounting_date", "last_accounting_date", "is_cancelled"
    ]


def test_fact_and_cancelled_are_disjoint_and_complete(lines):
    fact = fact_check_items(lines)
    cancelled = versions.cancelled_checks(lines)
    assert fact.join(cancelled, "check_id", "left_semi").count() == 0
    positive = {r.check_id for r in versions.positive_qty(lines).where("close_ts IS NOT NULL").collect()} - {None}
    assert {r.check_id for r in fact.collect()} == positive


def test_latest_line_per_check_day(spark):
    df = raw_checks(
        spark,
        [
            line(1, "12:00", 1.0),
            line(1, "13:00", 1.0),
            line(1, "13:00", 1.0),
            line(1, "14:00", 0.0),
            line(1, "15:00", 1.0, dish_category="УСЛУГИ"),
            line(1, "16:00", 1.0, dish_category="МОДИФИКАТОРЫ"),
            line(1, "11:00", 1.0, accounting_date="2026-02-02"),
        ],
    )
    assert ids(versions.latest_line_per_check_day(stage_checks(df))) == [2, 7]


def test_superseded_versions(spark):
    df = raw_checks(
        spark,
        [
            line(1, "12:00", 1.0),
            line(1, "13:00", 1.0),
            line(2, "12:00", 1.0),
            line(3, "12:00", 1.0, open_ts="2026-02-01 08:00:00"),
            line(3, "12:00", 1.0, open_ts="2026-02-01 08:00:00"),
            line(3, "14:00", 1.0, open_ts="2026-02-01 09:00:00"),
            line(3, "14:00", 1.0, accounting_date="2026-02-02"),
            line(4, None, 1.0),
        ],
    )
    got = versions.superseded_versions(df).collect()
    assert sorted((r.check_id, str(r.open_ts)[11:16]) for r in got) == [(1, "10:00"), (3, "08:00")]


def test_incremental_refresh_equals_rebuild(spark):
    draw = random.Random(5)
    rows = [line(draw.randint(1, 40), f"1{draw.randint(0, 9)}:00", draw.choice([0.0, 1.0])) for _ in range(300)]
    df = raw_checks(spark, rows)
    fact = None
    for low, high in [(0, 180), (180, 180), (180, 300)]:
        seen = df.where(F.col("source_row_id") <= high)
        changed = written(
            df.where(F.col("source_row_id").between(low + 1, high)).select("check_id").distinct(), "changed"
        )
        if fact is None:
            fact = written(fact_check_items(seen), "fact")
        else:
            fact = written(incremental_fact_refresh(seen, fact, changed), "fact")
        assert sorted(fact.collect()) == sorted(fact_check_items(seen).collect())


def test_staging_flags(spark):
    df = raw_checks(
        spark,
        [
            line(1, "12:00", 1.0, 0.0, dish_name="  Соус\t", dish_category="МОДИФИКАТОРЫ", order_type="Банкет"),
            line(1, "12:00", 0.0, -0.17, dish_name="Округление в пользу гостя", dish_category="Д.ПАСТА", order_type=""),
        ],
    )
    free, rounding = stage_checks(df).orderBy("source_row_id").collect()
    assert free.dish_name == "Соус" and free.is_zero_amount_modifier and free.channel_group == "banquet"
    assert rounding.is_service_item and rounding.is_zero_qty_row and rounding.category_clean == "ПАСТА"
    assert rounding.order_type is None and rounding.channel_group == "other" and rounding.is_delivery_category
    assert free.check_duration_minutes == 120 and not free.is_long_duration_check
    assert len(stage_checks(df).columns) == 29 and len(fact_check_items(df).columns) == 29
