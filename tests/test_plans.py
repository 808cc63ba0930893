"""Shape of the physical plans, with broadcasting off as for large inputs."""

import contextlib
import io
import re

import pytest

from seriesmill.catalogue.queries import queries

FOLDER = "/root/testdata/sf0.001"
MODELS = [
    "stg_household", "stg_wages", "stg_monthly", "int_regional", "int_wage_trends", "mart_regional",
    "mart_wage", "mart_industry", "industry_wages_unrounded", "dash_regional", "dash_story",
    "kpi_latest", "kpi_yoy", "rank_both", "snapshot_diff", "completeness_gaps", "year_ago_join",
    "benchmark_join", "extremes", "dq_staging", "dq_marts", "rows_for_role", "mask_values",
]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", MODELS)
def test_no_cross_join_python_or_global_window(no_broadcast, name):
    plan = physical(queries()[name](no_broadcast, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
    assert not re.search(r"Window \[.*\], \[\](?:$|\n)", plan)


@pytest.mark.parametrize("name", MODELS)
def test_one_partition_only_after_partial_aggregates(no_broadcast, name):
    lines = physical(queries()[name](no_broadcast, FOLDER)).splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "partial_" in below


def test_region_join_reuses_the_aggregation_shuffle(no_broadcast):
    plan = physical(queries()["int_regional"](no_broadcast, FOLDER))
    assert plan.count("Exchange hashpartitioning(year_num") == 2  # one per side, none for the join


def test_wage_model_reads_few_columns_and_pushes_the_date(spark):
    df = queries()["int_wage_trends"](spark, FOLDER)
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    plan = out.getvalue()
    assert "GreaterThanOrEqual(l_shipdate" in " ".join(re.findall(r"PushedFilters: \[(.*)\]", plan))
    scans = {re.search(r"(\w+)[.]parquet", scan).group(1): scan for scan in plan.split("Scan parquet")[1:] if ".parquet" in scan}
    read = {name: re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1) for name, scan in scans.items()}
    assert len(read["lineitem"].split(",")) == 6 and len(read["part"].split(",")) == 2
