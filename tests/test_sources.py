import pytest
from helpers import line, raw_checks, raw_plan
from pyspark.sql import functions as F

from checkmart.plans import refresh
from checkmart.plans.fact import read_fact
from checkmart.schemas import CHECKPOINTS, MART_SCHEMAS, RAW_PLAN, SOURCE_CHECKS
from checkmart.sources import extracts, incremental, runs, tables
from checkmart.streaming.loads import stream_incremental_load
from checkmart.vocabulary import FACT_HEADERS, PLAN_HEADERS

FACT_ROW = {
    "Учетный день": "2026-02-01",
    "Номер чека": "39558",
    "Время открытия": "2026-02-01 10:00:00",
    "Час открытия": "10",
    "Время закрытия": "2026-02-01 22:22:00",
    "Час закрытия": "22",
    "Блюдо": " Д.S.Алла Дьявола\t",
    "Категория блюда": "Д.ПИЦЦА S",
    "Тип заказа": "Доставка курьером",
    "Количество блюд": "1",
    "Количество гостей": "2",
    "Сумма со скидкой, р.": "510.0",
}


def text_extract(spark, rows, extra="source_row_number"):
    names = [*FACT_HEADERS, extra]
    schema = ", ".join(f"`{n}` string" for n in names)
    filled = [tuple({**FACT_ROW, extra: str(n + 2), **row}.get(c) for c in names) for n, row in enumerate(rows)]
    return spark.createDataFrame(filled, schema)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_read_fact_extract(spark, tmp_path, kind):
    cells = text_extract(
        spark,
        [
            {},
            {"Учетный день": "junk"},
            {"Номер чека": None},
            {"Количество блюд": "x", "Блюдо": "  ", "Количество гостей": None, "Время закрытия": "46054.3"},
        ],
    )
    path = f"{tmp_path}/extract-as-{kind}"
    if kind == "csv":
        cells.write.csv(path, header=True)
    else:
        cells.write.parquet(path)
    read = extracts.read_fact_extract(spark, path, "2026-02", "факт 02 2026", file_format=kind, most_unreadable=0.3)
    got = read.orderBy("source_row_number").collect()
    assert [r.source_row_number for r in got] == [2, 5]
    assert got[0].check_id == 39558 and got[0].dish_name == "Д.S.Алла Дьявола" and got[0].qty == 1.0
    assert (got[0].source_period, got[0].source_sheet) == ("2026-02", "факт 02 2026")
    assert got[0].source_file.endswith(f".{kind}") or "part-" in got[0].source_file
    assert got[1].qty is None and got[1].dish_name is None and got[1].close_ts is None and got[1].guest_count is None


def test_dates_in_other_formats(spark, tmp_path):
    cells = [{"Учетный день": d, "Время открытия": t} for d, t in [
        ("01.02.2026", "01.02.2026 09:30:00"), (" 2026-02-02 ", "2026-02-02 10:00:00"), ("46054", "46054.5"), ("Итого", None)
    ]]
    text_extract(spark, cells).write.csv(f"{tmp_path}/extract", header=True)
    # dates that nobody can read are an error, not an empty load
    with pytest.raises(ValueError, match="3 of 4 cells of accounting_date are no dates"):
        extracts.read_fact_extract(spark, f"{tmp_path}/extract", "2026-02")
    dates = extracts.DateText(["dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy"], serials=True)
    got = extracts.read_fact_extract(spark, f"{tmp_path}/extract", "2026-02", dates=dates, most_unreadable=0.25)
    rows = [(str(r.accounting_date), str(r.open_ts)) for r in got.orderBy("source_row_number").collect()]
    assert rows == [
        ("2026-02-01", "2026-02-01 09:30:00"), ("2026-02-02", "2026-02-02 10:00:00"), ("2026-02-01", "2026-02-01 12:00:00")
    ]


def test_unreadable_times_are_no_silent_loss(spark, tmp_path):
    text_extract(spark, [{"Время закрытия": "01.02.2026 12:00:00"}] * 20).write.csv(f"{tmp_path}/extract", header=True)
    with pytest.raises(ValueError, match="20 of 20 cells of close_ts are no dates"):
        extracts.read_fact_extract(spark, f"{tmp_path}/extract", "2026-02")
    dates = extracts.DateText(["dd.MM.yyyy HH:mm:ss"])
    got = extracts.read_fact_extract(spark, f"{tmp_path}/extract", "2026-02", dates=dates)
    assert {str(r.close_ts) for r in got.collect()} == {"2026-02-01 12:00:00"}
    mixed = [{"Время закрытия": "soon"}, *[{}] * 19]
    text_extract(spark, mixed).write.csv(f"{tmp_path}/mixed", header=True)
    with pytest.warns(UserWarning, match="close_ts': 1"):
        assert extracts.read_fact_extract(spark, f"{tmp_path}/mixed", "2026-02").count() == 20


def test_refused_lines_are_kept_with_their_reasons(spark, tmp_path):
    rows = [
        {},
        {"Учетный день": "Итого", "Номер чека": None},
        {"Учетный день": " "},
        {"Номер чека": "x"},
        {"Количество гостей": "1.5", "Время закрытия": "soon"},
        {"Время открытия": None, "Количество гостей": "2.0", "Количество блюд": "x"},
    ]
    text_extract(spark, rows).write.csv(f"{tmp_path}/extract", header=True)
    lines, refused = extracts.split_fact_extract(spark, f"{tmp_path}/extract", "2026-02")
    assert sorted(r.source_row_number for r in lines.collect()) == [2, 7]
    assert {r.source_row_number: r.reasons for r in refused.collect()} == {
        3: "accounting_date is no date, check_id is missing",
        4: "accounting_date is missing",
        5: "check_id is missing",
        6: "close_ts is no date, guest_count is no whole number",
    }
    assert lines.count() + refused.count() == len(rows)
    assert refused.where("source_row_number = 6").first().close_ts == "soon"


def test_missing_columns_are_named_in_order(spark, tmp_path):
    cells = text_extract(spark, [{}]).drop("Тип заказа", "Блюдо")
    cells.write.csv(f"{tmp_path}/extract", header=True)
    with pytest.raises(ValueError, match=r"\['dish_name', 'order_type'\]"):
        extracts.read_fact_extract(spark, f"{tmp_path}/extract", "2026-02")
    with pytest.raises(ValueError, match="source_row_number"):
        extracts.with_lineage(cells.drop("source_row_number"), "2026-02", "s", "f")


def test_fraction_in_a_whole_column_fails(spark, tmp_path):
    text_extract(spark, [{"Количество гостей": "1.5"}]).write.csv(f"{tmp_path}/extract", header=True)
    with pytest.raises(Exception, match="not a whole number"):
        extracts.read_fact_extract(spark, f"{tmp_path}/extract", "2026-02").collect()


def test_read_plan_extract(spark, tmp_path):
    headers = [name for name, _ in PLAN_HEADERS]
    groups = ["", "", *["План"] * 11]
    folder = tmp_path / "plan"
    folder.mkdir()
    rows = [groups, headers, ["2026-02-01", *[str(n) for n in range(1, 13)]], ["2026-02-02", "x", *["5"] * 11], ["", *["9"] * 12]]
    (folder / "plan.csv").write_text("\n".join(",".join(f'"{c}"' for c in row) for row in rows), "utf-8")
    got = extracts.read_plan_extract(spark, str(folder), "план 02 2026").orderBy("plan_date")
    assert got.columns == RAW_PLAN.names
    first, second = got.collect()
    assert (first.plan_total_amount, first.plan_restaurant_amount, first.plan_avg_check_restaurant) == (1.0, 2.0, 8.0)
    assert (first.plan_avg_guest_restaurant, first.plan_avg_guest_banquet) == (10.0, 12.0)
    assert second.plan_total_amount is None and first.source_file == "plan.csv"
    with pytest.raises(ValueError, match="Ресторан #3"):
        extracts.plan_positions([h for i, h in enumerate(headers) if i != 10])


def test_assign_row_ids_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("place"), F.lit("x").alias("v")).repartition(9)
    for merge in ("true", "false"):
        # without merging of small partitions the ids run through several of them
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
        got = extracts.assign_row_ids(df, ["place"], start=10).orderBy("place").collect()
        assert [r.source_row_id for r in got] == list(range(10, 5010))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert extracts.assign_row_ids(df.limit(0), ["place"]).count() == 0


def test_build_source_numbers_periods_in_list_order(spark):
    lines = raw_checks(spark, [line(n, "12:00", 1.0, source_row_number=90 - n) for n in range(1, 7)])
    lines = lines.drop("source_row_id", "extracted_at", "source_loaded_at")
    later = lines.withColumn("source_period", F.lit("2026-02"))
    earlier = lines.withColumn("source_period", F.lit("2025-02")).where("check_id <= 4")
    got = extracts.build_source([later, earlier], ["2026-02", "2025-02"]).orderBy("source_row_id").collect()
    assert [(r.source_row_id, r.source_period, r.check_id) for r in got] == [
        *[(n, "2026-02", 7 - n) for n in range(1, 7)],
        *[(n + 6, "2025-02", 5 - n) for n in range(1, 5)],
    ]
    stats = extracts.period_stats(extracts.union_periods([later, earlier, earlier])).collect()
    assert [tuple(r) for r in stats] == [("2025-02", 8, 4), ("2026-02", 6, 6)]


def test_snapshots(spark, tmp_path):
    root, schema = str(tmp_path), spark.range(1).schema

    def count(table="t"):
        return tables.read_snapshot(spark, root, table, schema).count()

    assert count() == 0
    tables.write_snapshot(spark.range(3), root, "t")
    tables.write_snapshot(spark.range(5), root, "t")
    assert count() == 5
    base = tables.current_state(spark, root)
    staged = {"t": tables.stage_snapshot(spark.range(9), root, "t"), "u": tables.stage_snapshot(spark.range(2), root, "u")}
    assert (count(), count("u")) == (5, 0)
    tables.publish(spark, root, base, staged)
    # a second run that was built on the same state is refused and leaves everything as it is
    with pytest.raises(tables.Conflict):
        tables.publish(spark, root, base, {"t": {}})
    assert tables.current_state(spark, root).number == base.number + 1
    assert (count(), count("u")) == (9, 2)
    # a table may be replaced by something computed from itself
    tables.write_snapshot(tables.read_snapshot(spark, root, "t", schema).where("id < 2"), root, "t")
    assert (count(), count("u")) == (2, 2)
    # old versions go, the current ones stay
    assert len(tables.delete_old(spark, root, keep=1)) == 3
    assert (count(), count("u")) == (2, 2) and tables.delete_old(spark, root, keep=1) == []


def test_tables_in_parts(spark, tmp_path):
    root, rows = str(tmp_path), spark.range(6).withColumn("part", F.pmod("id", F.lit(3)).cast("string"))
    staged = tables.stage_snapshot(rows, root, "t", "part")
    state = tables.publish(spark, root, tables.current_state(spark, root), {"t": staged})
    new = tables.stage_snapshot(spark.range(100, 102).withColumn("part", F.lit("1")), root, "t", "part")
    tables.publish(spark, root, state, {}, {"t": {**new, "2": None}})
    got = tables.read_snapshot(spark, root, "t", spark.range(1).schema)
    assert sorted(r.id for r in got.collect()) == [0, 3, 100, 101]


def test_ensure_table_keeps_what_is_there(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.ensure_table(spark, path, SOURCE_CHECKS)
    assert spark.read.parquet(path).columns == SOURCE_CHECKS.names
    spark.range(2).write.mode("overwrite").parquet(path)
    tables.ensure_table(spark, path, SOURCE_CHECKS)
    assert spark.read.parquet(path).count() == 2


def test_layers_and_missing_mart(spark, tmp_path):
    root = str(tmp_path)
    empty, message = tables.read_mart(spark, root, "mart_channel_daily", order=["revenue_date", "channel_group"])
    assert empty.count() == 0 and empty.schema == MART_SCHEMAS["mart_channel_daily"] and "mart_channel_daily" in message
    rows = spark.createDataFrame([(None, "pickup", 1, 2, 3.0, 4.0, 5.0)], MART_SCHEMAS["mart_channel_daily"])
    tables.materialize(rows, root, "mart", "mart_channel_daily")
    mart, message = tables.read_mart(spark, root, "mart_channel_daily", ["channel_group"])
    assert message is None and [tuple(r) for r in mart.collect()] == [("pickup",)]
    # a mart that is published but cannot be read
    folder = tables.current_state(spark, root).tables["mart/mart_channel_daily"][""]
    for file in (tmp_path / folder).glob("part-*"):
        file.write_bytes(b"no parquet")
        (file.parent / f".{file.name}.crc").unlink()
    mart, message = tables.read_mart(spark, root, "mart_channel_daily", ["channel_group"])
    assert mart.count() == 0 and "cannot be read" in message
    tables.materialize(rows, root, "staging", "some_view")
    assert spark.table("some_view").count() == 1
    with pytest.raises(ValueError, match="unknown layer"):
        tables.materialize(rows, root, "gold", "t")


def test_load_plan_replaces(spark, tmp_path):
    root = str(tmp_path)
    tables.load_plan(raw_plan(spark, [{"plan_date": "2026-02-01"}, {"plan_date": "2026-02-02"}]), root)
    assert tables.load_plan(raw_plan(spark, [{"plan_date": "2026-03-01"}]), root) == {"rows": 1}
    got = tables.read_snapshot(spark, root, "raw/stg_plan_daily", RAW_PLAN)
    assert [str(r.plan_date) for r in got.collect()] == ["2026-03-01"]


def source_rows(spark, ids):
    lines = raw_checks(spark, [line(n, "12:00", 1.0, source_row_id=n) for n in ids])
    return lines.drop("extracted_at")


def loaded(spark, root):
    return sorted(r.source_row_id for r in incremental.read_raw_checks(spark, root).collect())


def test_incremental_batches_equal_one_load(spark, tmp_path):
    root = str(tmp_path)

    def extract(ids, **more):
        return incremental.run_extract(spark, source_rows(spark, ids), root, **more)

    assert extract(range(1, 5)) == {"previous": 0, "current": 4, "rows": 4, "total": 4}
    assert extract(range(1, 5)) == {"previous": 4, "current": 4, "rows": 0, "total": 4}
    assert loaded(spark, root) == [1, 2, 3, 4]
    assert extract(range(1, 11))["rows"] == 6
    assert loaded(spark, root) == list(range(1, 11))
    # a source that shrinks neither moves the mark back nor loads rows again
    assert extract(range(1, 3)) == {"previous": 10, "current": 10, "rows": 0, "total": 10}
    extract(range(1, 12))
    assert loaded(spark, root) == list(range(1, 12))
    assert extract(range(1, 4), full_refresh=True)["current"] == 3
    assert loaded(spark, root) == [1, 2, 3]


def test_many_loads_are_merged_by_size(spark, tmp_path, monkeypatch):
    """Every row is written log-many times, and there are log-many runs."""
    written_rows = []
    real = incremental.merged

    def counting(*args):
        merge = real(*args)
        written_rows.append(merge[0].rows if merge else 0)
        return merge

    monkeypatch.setattr(incremental, "merged", counting)
    root = str(tmp_path)
    for high in range(3, 50, 3):
        incremental.run_extract(spark, source_rows(spark, range(1, high + 1)), root)
        assert len(incremental.raw_parts(tables.current_state(spark, root))) <= 5
    assert loaded(spark, root) == list(range(1, 49))
    assert sum(written_rows) <= 48 * 4  # 16 loads
    # sizes alone decide: 200 loads, of one size and of several
    for sizes in ([7] * 200, [1 + n * n % 23 for n in range(200)], [500, *[1] * 199]):
        held, rewritten = [], 0
        for n, size in enumerate(sizes, 1):
            held.append(runs.Run(n, n, size, 0, 0, str(n)))
            old = runs.due(held)
            if old:
                rewritten += sum(r.rows for r in old)
                held = [*held[: -len(old)], runs.Run(old[0].first, n, sum(r.rows for r in old), 0, 0, "")]
            assert len(held) <= 12
        assert rewritten <= sum(sizes) * 8


def test_ids_in_any_order_are_loaded_once(spark, tmp_path):
    root = str(tmp_path)

    def extract(ids):
        return incremental.run_extract(spark, source_rows(spark, ids), root)["rows"]

    assert extract([101, 102, 103]) == 3
    assert extract([1, 2, 3]) == 3
    assert extract([1, 2, 3, 101]) == 0
    assert extract([50, 2, 103, 104]) == 2
    assert extract(range(1, 105)) == 104 - 8
    assert incremental.stored_unseen(spark, root, incremental.CHECK_SOURCE_NAME, tables.current_state(spark, root)) == []
    assert loaded(spark, root) == list(range(1, 105))
    # many holes: the ranges that are kept stay few, and no id is lost
    odd = [n for n in range(105, 900) if n % 3 == 0]
    assert extract(odd) == len(odd)
    kept = incremental.stored_unseen(spark, root, incremental.CHECK_SOURCE_NAME, tables.current_state(spark, root))
    assert 1 < len(kept) <= runs.MOST_RANGES
    assert extract(range(1, 900)) == 899 - 104 - len(odd)
    assert loaded(spark, root) == list(range(1, 900))


def test_unseen_ranges(spark):
    ids = spark.createDataFrame([(n,) for n in [2, 3, 3, 5, 9, 10, 10]], "source_row_id bigint")
    for cells in (1, 3, 100):
        found = incremental.unseen_ranges(ids, [(1, 6), (8, 12)], cells=cells)
        covered = {n for low, high in found for n in range(low, high + 1)}
        assert covered >= {1, 4, 6, 8, 11, 12} and covered <= set(range(1, 7)) | set(range(8, 13))
        assert cells < 100 or covered == {1, 4, 6, 8, 11, 12}
    assert runs.merged_ranges([(5, 6), (1, 2), (3, 3), (9, 9), (30, 31)], 2) == [(1, 9), (30, 31)]
    scattered = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,), (None,)], "check_id bigint")
    assert len(runs.covering_ranges(scattered, "check_id")) == 3
    assert runs.covering_ranges(scattered.where("check_id is null"), "check_id") == []


def test_failed_full_refresh_keeps_the_rows(spark, tmp_path):
    root = str(tmp_path)
    incremental.run_extract(spark, source_rows(spark, range(1, 6)), root)
    failing = source_rows(spark, range(1, 9)).withColumn(
        "qty", F.when(F.col("source_row_id") == 7, F.raise_error(F.lit("lost connection")).cast("double")).otherwise(F.col("qty"))
    )
    for full_refresh in (True, False):
        with pytest.raises(Exception, match="lost connection"):
            incremental.run_extract(spark, failing, root, full_refresh)
        assert loaded(spark, root) == [1, 2, 3, 4, 5]
    assert incremental.run_extract(spark, source_rows(spark, range(1, 9)), root)["previous"] == 5
    assert loaded(spark, root) == list(range(1, 9))


def test_checkpoints(spark):
    marks = spark.createDataFrame([("a", 5, None), ("b", 7, None)], CHECKPOINTS)
    updates = spark.createDataFrame([("a", 9, None), ("b", 3, None), ("c", 1, None)], CHECKPOINTS)
    merged = incremental.upsert_checkpoint(marks, updates)
    assert sorted((r.source_name, r.watermark) for r in merged.collect()) == [("a", 9), ("b", 7), ("c", 1)]
    assert incremental.read_watermark(merged, "zzz").first().watermark == 0
    assert incremental.source_watermark(source_rows(spark, [])).first().watermark == 0


def test_read_source(spark, tmp_path):
    rows = source_rows(spark, [1, 2])
    tables.write_snapshot(rows, str(tmp_path), "pos/check_items")
    rows.write.parquet(f"{tmp_path}/plain")
    rows.createOrReplaceTempView("pos_lines")
    assert incremental.read_source(spark, f"{tmp_path}/plain").count() == 2
    assert incremental.read_source(spark, "pos_lines", "table").count() == 2
    assert incremental.read_source(spark, "pos/check_items", "published", str(tmp_path)).count() == 2
    with pytest.raises(ValueError, match="root"):
        incremental.read_source(spark, "pos/check_items", "published")


def test_stream_and_batch_load_every_row_once(spark, tmp_path):
    """Stream, then batch, then stream again, each refreshing the fact."""
    source, root, checkpoint = (f"{tmp_path}/{n}" for n in ("source", "root", "checkpoint"))
    counts = []

    def on_batch(session, loaded_now):
        counts.append(loaded_now["rows"])
        refresh.refresh_facts(session, root)

    def stream():
        stream_incremental_load(spark, source, root, checkpoint, on_batch=on_batch).awaitTermination()
        fact = read_fact(spark, root)
        assert sorted(r.source_row_id for r in fact.collect()) == loaded(spark, root)
        return loaded(spark, root)

    source_rows(spark, [1, 2]).coalesce(1).write.mode("append").parquet(source)
    assert stream() == [1, 2]
    assert stream() == [1, 2]
    source_rows(spark, [3]).coalesce(1).write.mode("append").parquet(source)
    refresh.run_fact_refresh(spark, root, spark.read.schema(SOURCE_CHECKS).parquet(source), incremental=True)
    assert loaded(spark, root) == [1, 2, 3]
    # the stream meets the file that the batch has loaded, and a new one
    source_rows(spark, [4, 5]).coalesce(1).write.mode("append").parquet(source)
    assert stream() == [1, 2, 3, 4, 5]
    assert counts == [2, 2]
