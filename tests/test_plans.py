"""Shape of the plans: native expressions, bounded windows and broadcasts, pruned groups."""

import re

import pytest

from grantlens.catalog import QUERIES


def plan(spark, folder, name):
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def unhinted(spark):
    """With automatic broadcasts off, only hinted ones remain."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# one unpartitioned window over at most 256 range totals
RANGES = {"win_project_no", "rpt_list_found"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_no_cross_join_no_global_window(spark, folder, unhinted, name):
    text = plan(spark, folder, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    assert "Exchange SinglePartition" not in text or name in SINGLE | RANGES, "rows of a table go to one task"


# global aggregates and limits: partially aggregated (or cut to n) before the one task
SINGLE = {"snk_table_stats", "flt_precount", "flt_guard_empty", "agg_table_totals", "top_then_enrich", "agg_approval_time",
          "top_n", "top_row_limit"}


@pytest.mark.parametrize("name", ["cat_codes_space", "cat_reviews", "cat_conflict_props", "cat_emails", "win_slots_panels",
                                  "win_slots_props", "win_slots_people", "rev_by_panel"])
def test_capped_groups_are_cut_before_the_shuffle(spark, folder, name):
    assert "WindowGroupLimit" in plan(spark, folder, name)


def test_hinted_broadcasts_are_fixed_dimensions(spark, folder, unhinted):
    text = plan(spark, folder, "rpt_coding_check")
    tables = set(re.findall(r"/(\w+)\.parquet", text))
    assert "lineitem" in tables
    for block in text.split("BroadcastExchange")[1:]:
        scans = re.findall(r"/(\w+)\.parquet", block.split("Exchange hashpartitioning")[0])
        assert not scans or scans[0] in {"nation", "region"}


@pytest.mark.parametrize("name", ["prj_iln", "prj_lead", "src_id_pad", "flt_date_range"])
def test_own_facts_need_one_scan(spark, folder, name):
    text = plan(spark, folder, name)
    assert set(re.findall(r"/(\w+)\.parquet", text)) == {"orders"} and "Exchange" not in text


@pytest.mark.parametrize("name", ["prj_totals", "prj_counts", "agg_scalar_subqueries", "rev_release_check", "jn_anti", "flt_attr_none", "prj_one_row"])
def test_no_join_with_investigators_that_nobody_asked_for(spark, folder, name):
    assert "customer.parquet" not in plan(spark, folder, name)
