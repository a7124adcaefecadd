import datetime as dt

import duckdb
import pytest
from helpers import day, ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checkmart.functions import flags, keys, numbers, text, times
from checkmart.vocabulary import CHANNEL_PATTERNS, CHANNELS, ORDER_TYPE_CHANNELS, OTHER_CHANNEL


def apply(spark, values, kind, function):
    """function(column) on every value, in order."""
    rows = [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
    kinds = kind if isinstance(kind, list) else [kind]
    schema = ", ".join(["i int", *[f"c{n} {k}" for n, k in enumerate(kinds)]])
    df = spark.createDataFrame(rows, schema)
    columns = [F.col(f"c{n}") for n in range(len(kinds))]
    return [r.v for r in df.select("i", function(*columns).alias("v")).orderBy("i").collect()]


def test_to_number(spark):
    cells = ["1", "1.5", "x", "", None, " 7 ", "-2e3", "1d", "0x10", "nan", "12,5"]
    got = apply(spark, cells, "string", numbers.to_number)
    assert got == [1.0, 1.5, None, None, None, 7.0, -2000.0, None, None, None, None]


def test_to_number_whole(spark):
    got = apply(spark, ["1", "2.0", "x", None, "9007199254740993"], "string", lambda c: numbers.to_number(c, True))
    assert got == [1, 2, None, None, 9007199254740993]
    with pytest.raises(Exception, match="not a whole number: 1.5"):
        apply(spark, ["1.5"], "string", lambda c: numbers.to_number(c, True))


def test_to_ts_and_to_day(spark):
    cells = ["2026-02-01 09:02:22", "2026-02-01", "2026-02-01T10:00:00", "46054", "2026", "junk", None]
    got = apply(spark, cells, "string", times.to_ts)
    assert got == [ts("2026-02-01 09:02:22"), ts("2026-02-01"), ts("2026-02-01 10:00"), None, None, None, None]
    assert apply(spark, cells[:1], "string", times.to_day) == [day("2026-02-01")]
    assert apply(spark, ["01.02.2026"], "string", lambda c: times.to_day(c, ["dd.MM.yyyy"])) == [day("2026-02-01")]


def test_excel_serial(spark):
    got = apply(spark, [46054.0, 46054.376655, 46049.0, None], "double", times.excel_serial_to_ts)
    assert got == [ts("2026-02-01"), ts("2026-02-01 09:02:22.992000"), ts("2026-01-27"), None]


def test_clean_text(spark):
    cells = ["\tПицца\n", " a b ", "", "   ", None, "\x1cx\x1f", "a\tb"]
    assert apply(spark, cells, "string", text.clean_text) == ["Пицца", "a b", None, None, None, "x", "a\tb"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aЖ \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85    　", max_size=6), min_size=20, max_size=60))
def test_clean_text_strips_like_python(spark, cells):
    assert apply(spark, cells, "string", text.clean_text) == [cell.strip() or None for cell in cells]


def test_category(spark):
    cells = ["Д.ПИЦЦА", "ПИЦЦА", "Д.", "Д", "xД.", None]
    assert apply(spark, cells, "string", text.category_clean) == ["ПИЦЦА", "ПИЦЦА", "", "Д", "xД.", None]
    assert apply(spark, cells, "string", text.is_delivery_category) == [True, False, True, False, False, False]


def test_dish_name_normalized(spark):
    cells = ["Д.Карбонара +", "Карбонара+", "Карбонара + сыр", None]
    assert apply(spark, cells, "string", text.dish_name_normalized) == ["Карбонара", "Карбонара", "Карбонара + сыр", None]


def test_channel_group(spark):
    known = [(name, channel) for channel, names in ORDER_TYPE_CHANNELS.items() for name in names]
    assert len(known) == 14
    cells = [name for name, _ in known] + ["банкет", "Банкет ", "?", None]
    expected = [channel for _, channel in known] + [OTHER_CHANNEL] * 4
    got = apply(spark, cells, "string", flags.channel_group)
    assert got == expected and set(got) == set(CHANNELS)


def test_first_channel_wins(spark):
    overlapping = {"first": ["a", "b"], "second": ["b", "c"]}
    got = apply(spark, ["a", "b", "c", "d"], "string", lambda c: flags.channel_group(c, overlapping))
    assert got == ["first", "first", "second", OTHER_CHANNEL]


def test_normalize_channel(spark):
    cells = ["Приложение (доставка КУРЬЕРОМ)", "Агрегатор (Самовывоз)", "Самовывоз гостем", "Яндекс.ультима",
             "Заказ в ресторане", "Банкет C&B", "Веранда", None]
    got = apply(spark, cells, "string", lambda c: text.normalize_channel(c, CHANNEL_PATTERNS, OTHER_CHANNEL))
    assert got == ["delivery_courier", "pickup_aggregator", "pickup_direct", "delivery_yandex", "dine_in", "banquet",
                   "other", "other"]


def test_flags(spark):
    assert apply(spark, ["Доставка 199", "доставка 199", None], "string", flags.is_service_item) == [True, False, False]
    modifier = apply(
        spark,
        [("МОДИФИКАТОРЫ", 0.0), ("МОДИФИКАТОРЫ", None), ("МОДИФИКАТОРЫ", 5.0), ("ПАСТА", 0.0), (None, 0.0)],
        ["string", "double"],
        flags.is_zero_amount_modifier,
    )
    assert modifier == [True, True, False, False, False]
    assert apply(spark, [0.0, None, 1.0, -1.0], "double", flags.is_zero_qty) == [True, True, False, False]
    assert apply(spark, ["УСЛУГИ", "ПАСТА", None], "string", flags.is_service_category) == [True, False, None]
    assert apply(spark, ["МОДИФИКАТОРЫ", "ПАСТА"], "string", flags.is_modifier) == [True, False]
    assert apply(spark, ["Округление в пользу гостя", "x"], "string", flags.is_rounding_adjustment) == [True, False]
    pairs = [(True, True), (True, False), (False, True), (False, False)]
    assert apply(spark, pairs, ["boolean"] * 2, flags.is_dish_sales_item) == [False, False, False, True]
    assert apply(spark, [True, False], "boolean", flags.is_turnover_item) == [False, True]


def test_durations(spark):
    spans = [
        (ts("2026-02-01 09:59:59"), ts("2026-02-01 10:00:01")),
        (ts("2026-02-01 10:00:01"), ts("2026-02-01 09:59:59")),
        (ts("2026-02-01 00:59:59"), ts("2026-02-01 12:00:00")),
        (ts("2026-02-01 00:59:59"), ts("2026-02-01 13:00:00")),
        (None, ts("2026-02-01")),
    ]
    kinds = ["timestamp_ntz"] * 2
    assert apply(spark, spans, kinds, times.minutes_between) == [1, -1, 661, 721, None]
    hours = apply(spark, spans, kinds, lambda a, b: times.boundaries_between("HOUR", a, b))
    assert hours == [1, -1, 12, 13, None]
    assert apply(spark, spans, kinds, times.is_long_duration) == [False, False, False, True, False]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.datetimes(dt.datetime(1950, 1, 1), dt.datetime(2090, 1, 1))] * 2), min_size=30, max_size=60))
def test_minutes_between_like_sql(spark, spans):
    got = apply(spark, spans, ["timestamp_ntz"] * 2, times.minutes_between)
    con = duckdb.connect()
    assert got == [con.execute("SELECT date_diff('minute', ?, ?)", list(s)).fetchone()[0] for s in spans]


def test_suspicious_open(spark):
    opened = [("2026-01-27 08:04", True), ("2026-01-29 00:00", False), ("2026-01-28 23:59", True), (None, False)]
    rows = [(ts(o), day("2026-02-01")) for o, _ in opened]
    got = apply(spark, rows, ["timestamp_ntz", "date"], times.is_suspicious_open)
    assert got == [expected for _, expected in opened]
    assert apply(spark, rows[:1], ["timestamp_ntz", "date"], times.is_multiday_check) == [True]
    assert apply(spark, [ts("2026-02-01 09:02")], "timestamp_ntz", times.open_hour) == [9]
    assert apply(spark, [ts("2026-02-01 09:02")], "timestamp_ntz", times.open_date) == [ts("2026-02-01")]


def test_calendar(spark):
    df = spark.createDataFrame([(day("2026-02-01"),), (day("2026-02-02"),)], "d date")
    rows = df.select("d", *times.calendar_attributes(F.col("d"))).orderBy("d").collect()
    assert tuple(rows[0])[1:] == (2026, 2, 1, "2026-02", "Sunday", 7, True)
    assert tuple(rows[1])[1:] == (2026, 2, 2, "2026-02", "Monday", 1, False)


def test_rounding_like_sql(spark):
    values = [0.125, 1.005, 0.285, 2.675, -0.125, -1.005, -2.5, 0.0, 1e12 + 0.005, None]
    values += [n / 1000 for n in range(-2000, 2000, 7)]
    con = duckdb.connect()
    for digits in (2, 4):
        got = apply(spark, values, "double", lambda c, d=digits: numbers.round_half_away(c, d))
        sql = f"SELECT round(CAST(? AS DOUBLE), {digits})"
        assert got == [con.execute(sql, [v]).fetchone()[0] for v in values]


def test_guarded_ratio(spark):
    pairs = [(1.0, 4.0), (1.0, 0.0), (1.0, None), (None, 2.0), (0.0, 2.0)]
    assert apply(spark, pairs, ["double"] * 2, numbers.guarded_ratio) == [0.25, None, None, None, 0.0]


def test_money_sum_does_not_depend_on_order(spark):
    cents = [0.1, 0.2, 0.3, -0.17, -0.425, 1e6, 1e-6] * 50
    df = spark.createDataFrame([(v,) for v in cents], "v double")
    one = df.coalesce(1).agg(numbers.money_sum(F.col("v")).alias("s")).first().s
    many = df.repartition(7).agg(numbers.money_sum(F.col("v")).alias("s")).first().s
    assert one == many == 50000000.25005
    empty = spark.createDataFrame([(None,)], "v double").agg(numbers.money_sum(F.col("v")).alias("s")).first().s
    assert empty is None


def test_money_sum_of_large_small_and_infinite_amounts(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        return df.agg(numbers.money_sum(F.col("v")).alias("s")).first().s

    many = spark.range(1_000_000).select(F.lit(4e-7).alias("v"))
    assert many.agg(numbers.money_sum(F.col("v")).alias("s")).first().s == 0.4
    assert total([1e12] * 10) == 1e13 and total([5e14, 0.25]) == 500000000000000.25
    inf, nan = float("inf"), float("nan")
    assert total([1.0, inf]) == inf and total([-inf, 2.0, None]) == -inf
    assert str(total([inf, -inf])) == str(total([nan, 1.0])) == "nan"
    assert total([1e18, 1.0]) == 1e18


def test_hash_key(spark):
    rows = [("a", "b"), ("a", None), (None, None)]
    got = apply(spark, rows, ["string"] * 2, keys.hash_key)
    con = duckdb.connect()
    assert got == [con.execute("SELECT md5(?)", [t]).fetchone()[0] for t in ("a|b", "a|", "|")]


def test_formats(spark):
    values = [1234567.5, -0.4, 2.5, 0.0, None]
    python = ["—" if v is None else f"{v:,.0f}".replace(",", " ") for v in values]
    assert apply(spark, values, "double", text.fmt_number) == python
    assert apply(spark, values, "double", text.fmt_money) == [p if p == "—" else f"{p} ₽" for p in python]
    percents = [12.25, 0.05, 1234.56, -3.0, None]
    expected = ["—" if v is None else f"{v:.1f}%" for v in percents]
    assert apply(spark, percents, "double", text.fmt_percent) == expected
