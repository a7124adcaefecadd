"""What the physical plans must look like: these properties decide how the jobs behave on large data."""

import contextlib
import io
import re

import pytest

from checkmart.operators import versions
from checkmart.operators.reports import filter_by_date
from checkmart.plans.fact import fact_check_items
from checkmart.plans.staging import stage_checks
from checkmart.registry import QUERIES
from checkmart.schemas import MART_CHANNEL_DAILY, RAW_CHECKS
from checkmart.sources import adapters
from checkmart.sources.incremental import incremental_extract

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.usefixtures("compiled")


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "checks")
    spark.createDataFrame([], RAW_CHECKS).write.parquet(path)
    return spark.read.schema(RAW_CHECKS).parquet(path)


def jobs_of(spark, build):
    """Spark jobs that run while a frame is built."""
    spark.sparkContext.setJobGroup("build", "build")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_final_versions_join_by_check_and_close(spark, raw):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(fact_check_items(raw))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # both sides are dealt for the join alone, so that adaptive execution can split a check with many rows
    assert plan.count("hashpartitioning(check_id") >= 2 and "LeftSemi" in plan and "Window" not in plan
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    assert len(pushed) == 2 and all("GreaterThan(qty,0.0)" in p and "IsNotNull(check_id)" in p for p in pushed)
    reads = sorted(re.findall(r"ReadSchema: (.*)", plan), key=len)
    assert reads[0].count(":") == 3, "the latest closes read key, close and quantity only"
    assert "source_file" not in reads[1]


def test_no_job_runs_while_a_query_is_built(spark, raw):
    assert jobs_of(spark, lambda: fact_check_items(raw)) == 0
    assert jobs_of(spark, lambda: versions.superseded_versions(raw)) == 0
    orders = adapters.raw_checks_from_orders(spark, SF_DIR)
    assert jobs_of(spark, lambda: versions.final_versions(orders)) == 0


def test_orders_pick_final_lines_before_the_joins(spark):
    tree = plan_of(QUERIES["fact_check_items_orders"](spark, SF_DIR)).split("\n\n")[0]
    depth = {m[2]: len(m[1]) for m in re.finditer(r"^([\s+:\-|*]*)(?:\* )?\w*Join (LeftSemi|Inner)", tree, re.M)}
    assert "LeftSemi" in tree and depth.get("LeftSemi", 99) > depth.get("Inner", 0)


def test_latest_line_is_limited_before_the_shuffle(raw):
    tree = plan_of(versions.latest_line_per_check_day(stage_checks(raw))).split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")


def test_increments_and_periods_reach_the_scan(spark, raw, tmp_path):
    assert "GreaterThan(source_row_id,41)" in plan_of(incremental_extract(raw, 41))
    spark.createDataFrame([], MART_CHANNEL_DAILY).write.parquet(f"{tmp_path}/mart")
    mart = spark.read.schema(MART_CHANNEL_DAILY).parquet(f"{tmp_path}/mart")
    plan = plan_of(filter_by_date(mart, "2026-02-01", "2026-02-28").select("checks_count"))
    assert "GreaterThanOrEqual(revenue_date,2026-02-01)" in plan and "revenue_amount" not in plan


# queries that store an intermediate result or stream are left out: their plan is only that of the last step
@pytest.mark.parametrize(
    "name", ["mart_plan_fact_daily", "mart_dish_sales_daily", "dim_dish", "dim_date", "top_dishes", "superseded_versions"]
)
def test_no_python_no_cross_join_no_global_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert not re.search(r"Window.*\n.*\[\], \[", plan)
