"""Shapes of physical plans that matter at scale."""

import re

import pytest

from contract.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"ingest_stream", "monthly_job"}))
def test_no_product_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval",
                     "InPandas"):
        assert operator not in text


def test_scan_reads_only_what_is_used(spark):
    schema = re.search(r"ReadSchema: (\S+)", plan(spark, "latest_period")).group(1)
    assert schema == "struct<l_shipdate:timestamp_ntz>"
    assert "l_extendedprice" not in plan(spark, "marginals")


def test_new_months_is_an_anti_join(spark):
    assert "LeftAnti" in plan(spark, "new_months")


def test_top_n_is_not_a_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top3_bottom3")


def test_newest_month_filter_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(l_shipdate" in plan(spark, "sector_share_national")


@pytest.mark.parametrize("name", ["national_monthly", "marginals", "state_rank", "national_narrative",
                                  "employer_narrative", "sector_trend", "growth_by_group"])
def test_one_scan(spark, name):
    assert len(re.findall("FileScan", plan(spark, name))) == 1


def test_aggregation_starts_before_the_shuffle(spark):
    text = plan(spark, "national_monthly")
    assert text.index("functions=[sum") < text.index("Exchange") < text.index("partial_sum")


@pytest.mark.parametrize("name", ["sector_share_state", "sector_share_national",
                                  "sector_narrative", "sector_wage_table"])
def test_newest_month_takes_one_scan_and_one_column(spark, name):
    schemas = re.findall(r"ReadSchema: (\S+)", plan(spark, name))
    narrow = [x for x in schemas if x == "struct<l_shipdate:timestamp_ntz>"]
    assert len(set(schemas)) == 2 and len(schemas) - len(narrow) == 1


@pytest.mark.parametrize("name", ["state_narrative", "top3_bottom3", "ranking_text",
                                  "state_table"])
def test_rates_are_read_from_a_stored_table(spark, name):
    assert "l_shipdate" not in plan(spark, name)
