import pathlib
import random

import pytest
from helpers import line, raw_checks, raw_plan
from pyspark.sql import functions as F

from checkmart.operators import daily, dims, versions
from checkmart.plans import refresh
from checkmart.plans.fact import FACT_TABLE, fact_check_items, read_cancelled, read_fact
from checkmart.plans.staging import stage_checks, stage_plan
from checkmart.schemas import CANCELLED_CHECKS, DIM_DISH, DIM_ORDER_TYPE, MART_SCHEMAS, RAW_PLAN, SOURCE_CHECKS
from checkmart.session import shared_dir, written
from checkmart.sources import incremental, runs, tables
from checkmart.sources.incremental import read_raw_checks, run_extract
from checkmart.sources.tables import Conflict, current_state, load_plan, read_mart, read_snapshot

pytestmark = pytest.mark.usefixtures("compiled")

MARCH = {"accounting_date": "2026-03-03"}

ROWS = [
    line(1, "12:00", 0.0),
    line(1, "13:00", 1.0, 100.0),
    line(2, "12:00", 1.0, 50.0, **MARCH),
    line(3, "12:00", 0.0),
    line(4, "12:00", 1.0, 20.0, accounting_date="2026-01-05"),
    # a newer version of check 1, and a check of another month
    line(1, "14:00", 2.0, 150.0),
    line(5, "12:00", 1.0, 70.0, **MARCH),
]
PLAN = [{"plan_date": "2026-02-01", "plan_total_amount": 300.0}, {"plan_date": "2026-03-03", "plan_total_amount": 10.0}]


def source(spark, count):
    return raw_checks(spark, ROWS[:count]).drop("extracted_at")


def texts(df):
    return sorted(map(str, df.collect()))


def revenue(spark, root):
    mart, message = read_mart(spark, root, "mart_dashboard_daily", order=["revenue_date"])
    assert message is None
    return {str(r.revenue_date): (r.fact_total_amount, r.plan_total_amount) for r in mart.collect()}


def digest(df):
    """A value of all rows, for tables too large to collect."""
    line = F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)])
    return tuple(df.agg(F.count("*"), F.sum(line.cast("decimal(38,0)")), F.bit_xor(line)).first())


def assert_equals_a_rebuild(spark, root, texts=texts):
    """Everything published is what one build from all raw rows gives."""
    raw = read_raw_checks(spark, root)
    stg, plan = stage_checks(raw), stage_plan(read_snapshot(spark, root, tables.PLAN_TABLE, RAW_PLAN))
    lines = written(fact_check_items(raw), "expected-fact")
    plan_fact = written(daily.mart_plan_fact_daily(lines, plan), "expected-plan-fact")
    assert texts(read_fact(spark, root)) == texts(lines)
    assert texts(read_cancelled(spark, root)) == texts(versions.cancelled_checks(stg).select(*CANCELLED_CHECKS.names))
    expected = {
        "mart_plan_fact_daily": plan_fact,
        "mart_channel_daily": daily.mart_channel_daily(lines),
        "mart_avg_check_by_order_type": daily.mart_avg_check_by_order_type(lines),
        "mart_dish_sales_daily": daily.mart_dish_sales_daily(lines),
        "mart_dashboard_daily": daily.mart_dashboard_daily(plan_fact),
    }
    assert set(expected) == set(MART_SCHEMAS)
    for name, mart in expected.items():
        assert texts(read_mart(spark, root, name)[0]) == texts(mart.select(*MART_SCHEMAS[name].names)), name
    days = dims.dim_date(stg, plan)
    for table, schema, frame in (
        ("dwh/dim_dish", DIM_DISH, dims.dim_dish(stg)),
        ("dwh/dim_order_type", DIM_ORDER_TYPE, dims.dim_order_type(stg)),
        ("dwh/dim_date", days.schema, days),
    ):
        assert texts(read_snapshot(spark, root, table, schema)) == texts(frame.select(*schema.names)), table


def test_refresh_jobs(spark, tmp_path):
    """One warehouse through its life: the steps depend on each other."""
    root = str(tmp_path)
    with pytest.raises(ValueError, match="run the fact refresh first"):
        refresh.run_plan_refresh(spark, root, raw_plan(spark, PLAN))

    # first build, without a plan
    report = refresh.run_fact_refresh(spark, root, source(spark, 5))
    assert report.where("failures > 0").count() == 0 and report.count() == 38
    assert revenue(spark, root) == {"2026-01-05": (20.0, None), "2026-02-01": (100.0, None), "2026-03-03": (50.0, None)}
    for name, schema in MART_SCHEMAS.items():
        mart, message = read_mart(spark, root, name)
        assert message is None and mart.schema == schema and mart.count() > 0
    assert spark.table("stg_checks").count() == 5

    # the plan job touches its dependants only
    def folders(table):
        return current_state(spark, root).tables[table]

    channel = folders("mart/mart_channel_daily")
    report = refresh.run_plan_refresh(spark, root, raw_plan(spark, PLAN))
    assert {r.table_name for r in report.collect()} == {
        "stg_plan_daily", "dim_date", "mart_plan_fact_daily", "mart_dashboard_daily"
    }
    assert revenue(spark, root)["2026-03-03"] == (50.0, 10.0)
    assert folders("mart/mart_channel_daily") == channel

    # a refused plan leaves no trace, and the next fact refresh goes on with the old one
    with pytest.raises(ValueError, match="plan_total_amount not_null"):
        refresh.run_plan_refresh(spark, root, raw_plan(spark, [{"plan_date": "2026-02-01"}]))
    assert revenue(spark, root)["2026-03-03"] == (50.0, 10.0)

    # new versions rewrite the months they touch, and add to the fact
    before = folders("mart/mart_dish_sales_daily")
    refresh.run_fact_refresh(spark, root, source(spark, 7), incremental=True)
    after = folders("mart/mart_dish_sales_daily")
    assert {m for m in before if before[m] == after[m]} == {"2026-01"} and len(before) == 3
    # few lines: the two runs of the fact are one again
    assert list(folders(FACT_TABLE)) == ["000000001-000000002-4-0-1"]
    assert_equals_a_rebuild(spark, root)
    published = revenue(spark, root)
    assert published["2026-02-01"] == (150.0, 300.0) and published["2026-03-03"] == (120.0, 10.0)

    # a failed check publishes nothing, and the next incremental run picks the rows up
    broken = raw_checks(spark, [*ROWS, line(9, "12:00", 1.0, 5.0, dish_name=None)]).drop("extracted_at")
    with pytest.raises(ValueError, match=r"stg_checks\.dish_name not_null: 1"):
        refresh.run_fact_refresh(spark, root, broken, incremental=True)
    assert revenue(spark, root) == published
    suite = [c for c in refresh.CHECK_SUITE if c.column != "dish_name"]
    refresh.run_fact_refresh(spark, root, broken, suite=suite, incremental=True)
    assert_equals_a_rebuild(spark, root)
    assert revenue(spark, root)["2026-02-01"] == (155.0, 300.0)

    # start over from a source that holds less
    refresh.run_fact_refresh(spark, root, source(spark, 3), full_refresh=True)
    assert read_raw_checks(spark, root).count() == 3
    assert run_extract(spark, source(spark, 3), root)["current"] == 3
    assert set(revenue(spark, root)) == {"2026-02-01", "2026-03-03"}
    assert_equals_a_rebuild(spark, root)


def test_random_increments_equal_a_rebuild(spark, tmp_path):
    """Checks move between days and months, lose all lines, and come back."""
    root, draw = str(tmp_path), random.Random(8)
    days = ["2026-01-30", "2026-01-31", "2026-02-01", "2026-02-28", "2025-02-01", None]
    rows = [
        line(
            draw.randint(1, 14),
            f"1{draw.randint(0, 9)}:00",
            draw.choice([0.0, 1.0, 2.0]),
            draw.choice([10.0, 0.1, 33.33]),
            accounting_date=draw.choice(days[:-1]),
            dish_name=draw.choice(["Карбонара", "Соус"]),
            order_type=draw.choice(["Заказ в ресторане", "Доставка курьером"]),
        )
        for _ in range(90)
    ]
    everything = raw_checks(spark, rows).drop("extracted_at")
    load_plan(raw_plan(spark, PLAN), root)
    for high in (40, 70, 90):
        refresh.run_fact_refresh(spark, root, everything.where(F.col("source_row_id") <= high), incremental=True)
    assert_equals_a_rebuild(spark, root)


class Stopped(RuntimeError):
    pass


@pytest.mark.parametrize("incremental_run", [True, False])
def test_a_run_that_stops_anywhere_leaves_the_old_state(spark, tmp_path, monkeypatch, incremental_run):
    """Stops the run at each of its writes in turn; the last pass goes through."""
    root = str(tmp_path)
    load_plan(raw_plan(spark, PLAN), root)
    refresh.run_fact_refresh(spark, root, source(spark, 5))
    old = revenue(spark, root)
    run_extract(spark, source(spark, 7), root)
    real, real_run, calls, stop_at = tables.stage_snapshot, runs.stage_run, [0], [1]

    def stopping(*args, real=real, **more):
        calls[0] += 1
        if calls[0] == stop_at[0]:
            raise Stopped
        return real(*args, **more)

    monkeypatch.setattr(refresh, "stage_snapshot", stopping)
    monkeypatch.setattr(refresh, "stage_run", lambda *args, **more: stopping(*args, real=real_run, **more))
    before = current_state(spark, root)
    # the first, some middle and the last writes
    for step in (1, 2, 4, 6, 9):
        calls[0], stop_at[0] = 0, step
        with pytest.raises(Stopped):
            refresh.refresh_facts(spark, root, incremental=incremental_run)
        assert current_state(spark, root) == before and revenue(spark, root) == old
    monkeypatch.setattr(refresh, "stage_snapshot", real)
    monkeypatch.setattr(refresh, "stage_run", real_run)
    monkeypatch.setattr(refresh, "publish", lambda *args: (_ for _ in ()).throw(Stopped()))
    with pytest.raises(Stopped):
        refresh.refresh_facts(spark, root, incremental=incremental_run)
    assert current_state(spark, root) == before and revenue(spark, root) == old
    monkeypatch.setattr(refresh, "publish", tables.publish)
    refresh.refresh_facts(spark, root, incremental=incremental_run)
    assert_equals_a_rebuild(spark, root)
    # nothing that a stopped run wrote is left, neither staged nor intermediate
    states = (before, current_state(spark, root))
    named = {f.split("/")[2] for state in states for f in state.tables[FACT_TABLE].values()}
    assert {p.name for p in (tmp_path / FACT_TABLE).iterdir()} == named
    assert not list((tmp_path / "published_states").glob(".draft-*"))


def test_interleaved_jobs_both_count(spark, tmp_path, monkeypatch):
    """A plan job publishes while a fact job is about to: the fact job builds anew on the new plan."""
    root = str(tmp_path)
    refresh.run_fact_refresh(spark, root, source(spark, 5))
    run_extract(spark, source(spark, 7), root)
    real, met = tables.publish, []

    def late(spark, root, base, *tables_of_run):
        if not met:
            met.append(True)
            refresh.run_plan_refresh(spark, root, raw_plan(spark, PLAN))
        return real(spark, root, base, *tables_of_run)

    monkeypatch.setattr(refresh, "publish", late)
    refresh.refresh_facts(spark, root)
    assert_equals_a_rebuild(spark, root)
    assert revenue(spark, root)["2026-03-03"] == (120.0, 10.0)
    with pytest.raises(Conflict):
        real(spark, root, tables.State(1, {}), {})


EXTRACT = "source_row_id", "extracted_at", "source_loaded_at"


def extract_of(spark, period, rows):
    """Lines of one period; a row is (row number, check, close, quantity, amount)."""
    made = [line(c, t, q, a, source_row_number=n, source_period=period, source_system="pos") for n, c, t, q, a in rows]
    return raw_checks(spark, made).drop(*EXTRACT)


def test_extracts_that_are_sent_again(spark, tmp_path):
    """Lines added, changed and removed in an older period: the same result as from scratch, and ids that stay."""
    root, anew = f"{tmp_path}/a", f"{tmp_path}/b"
    first = [(1, 1, "12:00", 1.0, 10.0), (2, 2, "12:00", 1.0, 20.0), (3, 2, "13:00", 1.0, 25.0), (4, 3, "12:00", 1.0, 40.0), (5, 6, "12:00", 1.0, 5.0)]
    second = [(1, 4, "12:00", 1.0, 40.0), (2, 5, "12:00", 0.0, 0.0), (3, 4, "12:00", 1.0, 2.0)]

    def load(at, one, two):
        refresh.run_bootstrap(spark, at, [extract_of(spark, "p1", one), extract_of(spark, "p2", two)], ["p1", "p2"])
        source = incremental.read_source(spark, refresh.SOURCE_TABLE, "published", at)
        withdrawn = refresh.read_withdrawn_lines(spark, at)
        refresh.run_fact_refresh(spark, at, source, incremental=True, withdrawn=withdrawn)
        return {(r.source_period, r.source_row_number, r.amount_discount_rub): r.source_row_id for r in source.collect()}

    ids = load(root, first, second)
    assert sorted(ids.values()) == list(range(1, 9))
    # an added line, a changed amount, and a newer version, a sole line and a check's last line that are gone
    changed = [first[0], first[1], (4, 3, "12:00", 1.0, 44.0), (9, 9, "12:00", 1.0, 50.0)]
    for one, two in ((changed, second), (changed, second[:1]), ([*first, changed[-1]], second)):
        again = load(root, one, two)
        assert len(again) == len(one) + len(two)
        assert all(again[key] == ids[key] for key in again.keys() & ids.keys() if again[key] in ids.values())
        fresh = [i for key, i in again.items() if key not in ids]
        assert not set(fresh) & set(ids.values())
        ids |= again
        assert_equals_a_rebuild(spark, root)
        numbered = {r.source_row_id for r in read_raw_checks(spark, root).collect()}
        assert numbered == set(again.values())
    load(anew, one, two)
    for name in MART_SCHEMAS:
        assert texts(read_mart(spark, root, name)[0]) == texts(read_mart(spark, anew, name)[0]), name


def bytes_read(spark):
    statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    return statistics.getLong("bytesRead")


def size_of(root, table):
    return sum(f.stat().st_size for f in (pathlib.Path(root) / table).rglob("*.parquet"))


PER_DAY = 300


def event_log(spark, first, last, lines=5):
    """Check lines of some checks, 300 a day from January 2024 on; ids grow with the days."""
    check = F.col("id").cast("bigint")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (check / PER_DAY).cast("int"))
    seed = F.xxhash64(check, "place")
    rows = spark.range(first, last).withColumn("place", F.explode(F.sequence(F.lit(1), F.lit(lines)))).select(
        (check * lines + F.col("place")).alias("source_row_id"),
        day.alias("accounting_date"),
        check.alias("check_id"),
        F.lit(None).cast("timestamp_ntz").alias("open_ts"),
        day.cast("timestamp_ntz").alias("close_ts"),
        F.concat(F.lit("dish "), F.pmod(seed, F.lit(40))).alias("dish_name"),
        F.concat(F.lit("group "), F.pmod(seed, F.lit(5))).alias("dish_category"),
        F.lit("Заказ в ресторане").alias("order_type"),
        F.lit(1.0).alias("qty"),
        F.lit(2).alias("guest_count"),
        (F.pmod(seed, F.lit(100000)) / 100).alias("amount_discount_rub"),
        day.cast("timestamp_ntz").alias("source_loaded_at"),
    )
    missing = {f.name: F.lit(None).cast(f.dataType) for f in SOURCE_CHECKS.fields if f.name not in rows.columns}
    return rows.withColumns(missing).select(*SOURCE_CHECKS.names)


def test_a_refresh_costs_what_changed(spark, tmp_path):
    """1,000 changed checks over 24 months: the real job reads and writes less than a twentieth of raw rows and fact."""
    root, last = str(tmp_path), 730 * PER_DAY
    load_plan(raw_plan(spark, PLAN), root)
    base = event_log(spark, 0, last).repartitionByRange(8, "source_row_id")
    refresh.run_fact_refresh(spark, root, base)
    stored = size_of(root, incremental.RAW_CHECKS_TABLE) + size_of(root, FACT_TABLE)
    folders = {p for table in (incremental.RAW_CHECKS_TABLE, FACT_TABLE) for p in (tmp_path / table).iterdir()}
    # 980 new checks, and new versions of some recent ones and of some of one month a year ago
    new = event_log(spark, last, last + 980)
    late = event_log(spark, last - 300, last - 290).unionByName(event_log(spark, last - 108_000, last - 107_990))
    late = late.withColumn("close_ts", F.col("close_ts") + F.expr("INTERVAL 1 HOUR")).withColumn("source_row_id", F.col("source_row_id") + 10**7)
    increment = written(new.unionByName(late), "increment")
    before = bytes_read(spark)
    refresh.run_fact_refresh(spark, root, increment, incremental=True)
    read = bytes_read(spark) - before
    state = current_state(spark, root)
    changed = {p for table in (incremental.RAW_CHECKS_TABLE, FACT_TABLE) for p in (tmp_path / table).iterdir()} - folders
    new_bytes = sum(f.stat().st_size for p in changed for f in p.rglob("*.parquet"))
    assert folders <= {tmp_path / f for parts in state.tables.values() for f in parts.values()}
    assert read < stored / 20 and new_bytes < stored / 20
    assert_equals_a_rebuild(spark, root, digest)


def test_bootstrap_and_clean_up(spark, tmp_path):
    root = str(tmp_path)
    lines = raw_checks(spark, [line(n, "12:00", 1.0, source_row_number=n, source_period="p") for n in range(1, 4)])
    extract = lines.drop("source_row_id", "extracted_at", "source_loaded_at")
    stats, total = refresh.run_bootstrap(spark, root, [extract], ["p"])
    assert [tuple(r) for r in stats.collect()] == [("p", 3, 3)] and total == 3
    numbered = incremental.read_source(spark, refresh.SOURCE_TABLE, "published", root)
    assert sorted(r.source_row_id for r in numbered.collect()) == [1, 2, 3]
    refresh.run_fact_refresh(spark, root, numbered)
    # what a killed driver left goes after a while; what states name stays
    half = tmp_path / FACT_TABLE / "version-left"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half a fi")
    assert tables.sweep(spark, root) == []
    assert tables.sweep(spark, root, older_than=0.0) == [f"{FACT_TABLE}/version-left"]
    assert not half.exists() and read_fact(spark, root).count() == 3
    # intermediate results of the jobs are gone
    scratch = pathlib.Path(shared_dir(spark).removeprefix("file:")) / "checkmart"
    assert not list(scratch.glob("run-*"))
