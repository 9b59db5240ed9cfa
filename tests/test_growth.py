"""What a task holds and what is shuffled grows no faster than the tables."""

import re

import pytest
from pyspark.sql import functions as F

from grantlens.catalog import QUERIES
from grantlens.operators import budgets, reviews
from grantlens.plans import stages
from grantlens.session import MOST_PARTITIONS, expect, isolated, scan_bytes
from grantlens.sources.entities import Entities


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def subtree(text, of):
    """The first node of a printed plan that has this text, with what is below it."""
    lines = text.splitlines()
    first = next(i for i, x in enumerate(lines) if of in x)
    depth = lines[first].index(of)
    end = next((i for i in range(first + 1, len(lines)) if len(lines[i]) - len(lines[i].lstrip(" :+-")) <= depth), len(lines))
    return "\n".join(lines[first:end])


def test_partitions_grow_with_the_rows_of_the_tables(spark):
    own = isolated(spark)
    asked = []
    for gb in (0, 1, 6):
        expect(own, gb << 30)
        asked.append(int(own.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")))
    assert asked[0] == int(spark.conf.get("spark.sql.shuffle.partitions")) and asked[1] >= 60 and asked[2] >= 360


def test_a_tasks_share_is_the_same_at_any_size(spark):
    own, mb = isolated(spark), 1 << 20
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m", "adaptive execution merges what was cut"
    for gb in (1, 6):
        expect(own, gb << 30)
        assert (gb << 30) / int(own.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) <= 8 * mb
        assert int(own.conf.get("spark.sql.files.maxPartitionBytes")) == 8 * mb, "a task groups the rows that it reads"
    assert scan_bytes(0) == 8 * mb and scan_bytes(16 * mb * MOST_PARTITIONS) == 16 * mb and scan_bytes(1 << 60) == 128 * mb


def test_proposals_meet_their_panels_last(spark, folder):
    text = optimized(QUERIES["rpt_props_on_panels"](spark, folder))
    join = next(x for x in text.splitlines() if "Join " in x)
    assert join.count("lead#") == 2, "rows of proposals and panels are shuffled again"


def test_splits_meet_their_proposal_last(spark, folder):
    text = optimized(QUERIES["rpt_splits"](spark, folder))
    join = next(x for x in text.splitlines() if "Join " in x)
    assert "prop_id#" in join and "splt_id#" not in join and "budg_yr#" not in join, "rows of proposals and splits are shuffled again"


@pytest.fixture()
def shuffled(spark):
    """Shuffles of a frame, by their keys, where no table is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda df: [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", df._jdf.queryExecution().executedPlan().toString())]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_codes_are_shuffled_once_to_what_has_them(spark, folder, shuffled):
    e = Entities(spark, folder)
    assert [x for x in shuffled(stages.codes_space(e.atr)) if "partkey" not in x] == ["prop_id"]
    assert [x for x in shuffled(stages.split_codes(e.splt_code)) if "partkey" not in x] == ["prop_id, budg_yr, splt_id"]


def test_reviews_are_shuffled_once_to_their_proposal(spark, folder, shuffled):
    keys = shuffled(Entities(spark, folder).rev)
    assert keys.count("l_orderkey") == 1 and not any("l_suppkey" in x or x == "prop_id" for x in keys)


def carrying(df, column):
    """Keys of the shuffles that carry a column."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    pairs = [(re.search(r"Exchange hashpartitioning\((.*?), \d+\)", a), b) for a, b in zip(lines, lines[1:])]
    return [re.sub(r"#\d+L?", "", found.group(1)) for found, below in pairs if found and column in below]


@pytest.mark.parametrize(("name", "times"), [("rpt_coding_check", 1), ("rpt_project_wide", 1), ("rpt_props_on_panels", 2)])
def test_rows_of_proposals_are_shuffled_seldom_and_without_names_of_codes(spark, folder, shuffled, name, times):
    old = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    try:
        report = QUERIES[name](spark, folder)
        assert len(carrying(report, "prop_titl_txt")) == times and not carrying(report, "natr_rqst_abbr")
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", old)


def test_reviews_wait_at_their_project_for_the_credits(spark, folder, shuffled):
    (key, value), = stages.AT_ITS_PROJECT.items()
    before = spark.conf.get(key)
    assert "string" in stages.credited_reviews(Entities(spark, folder)).columns and spark.conf.get(key) == before, "for the write alone"
    spark.conf.set(key, value)
    try:
        assert "lead, revr_id" not in shuffled(stages.lead_reviews(Entities(spark, folder), True))
    finally:
        spark.conf.set(key, before)


def test_only_panels_of_heads_are_staged(spark, folder):
    e = Entities(spark, folder)
    whole = e.panl_prop
    own, heads = stages.with_head_panels(e), {r.prop_id for r in stages.heads(e).collect()}
    assert e.panl_prop is whole and own.rec.columns == e.rec.columns
    assert sorted(map(tuple, own.panl_prop.collect())) == sorted(tuple(r) for r in whole.collect() if r.prop_id in heads)


def test_copies_of_entities_expect_what_all_have_opened(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr("grantlens.sources.entities.expect", lambda spark, size: seen.append(size))
    e = Entities(spark, folder, sized=True)
    own = stages.with_head_panels(e)
    own.revr  # opens a further table
    assert len(seen) >= 4 and seen == sorted(seen)


def test_summary_of_single_reviews(spark):
    rows = [(1, 5, 0, 1, 2.0, "G", None), (1, 6, 0, 0, 4.5, "E", None), (1, None, 0, 0, None, None, None), (1, 7, 1, 1, 1.0, "P", None), (None, 5, 0, 0, 3.0, "V", None)]
    df = spark.createDataFrame(rows, "lead long, revr_id long, confl int, unmkd int, score double, string string, rev_rtrn_date timestamp_ntz")
    assert sorted(reviews.summary(df, once=True).collect(), key=repr) == sorted(reviews.summary(df).collect(), key=repr)
    assert "distinct" not in optimized(reviews.summary(df, once=True))


BUDGET = "prop_id long, revn_num long, budg_seq_yr int, budg_tot_dol double, " + ", ".join(f"{x} double" for x in budgets.LINES)


@pytest.fixture()
def budget(spark):
    rows = [(1, None, 1, 9.0), (1, 0, 1, 1.0), (1, 2, 1, None), (2, None, 1, 4.5), (2, None, 2, 1.5), (3, -7, 1, 3.0), (3, None, 1, 8.0)]
    return spark.createDataFrame([(*r, *[r[3]] * len(budgets.LINES)) for r in rows], BUDGET)


def test_totals_of_the_latest_revision_without_sorting(spark, budget):
    got = budgets.totals(budget)
    assert sorted((r.prop_id, r.RN, r["T"], r.part_tot_cnt) for r in got.collect()) == [(1, 2, None, None), (2, None, 6.0, 6.0), (3, -7, 3.0, 3.0)]
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_budget_lines_travel_as_they_are_and_once_more_to_their_proposal(spark, tmp_path):
    """Sums are made behind the shuffles, also for unknown keys and lines that come twice."""
    lines = [(1, 3, 1, 2.0, 10.0, 0.1, 0.2, "A", "F"), (1, 3, 1, 2.0, 10.0, 0.1, 0.2, "A", "F"), (1, 6, 3, 1.0, 5.0, None, 0.4, "R", "F"), (1, 4, 2, 4.0, 8.0, 0.5, 0.25, "N", "O"),
             (2, None, 1, 1.0, 7.0, 0.0, 0.0, None, None), (None, 5, None, 3.0, 9.0, 0.1, 0.1, "R", "O")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    budg = Entities(spark, str(tmp_path)).budg
    assert sorted(((r.prop_id, r.revn_num, r.budg_seq_yr, r.budg_tot_dol, r.sub_ctr_dol, r.cptr_serv_dol, r.part_dol, r.part_cnt, r.sr_pers_cnt, r.sr_summ_mnth_cnt) for r in budg.collect()), key=repr) == sorted([
        (1, 0, 1, 20.0, 2.0, 0.0, 0.0, 4.0, 2.0, 0.0), (1, 0, 3, 5.0, 0.0, 0.0, 2.0, 1.0, 0.0, 1.0), (1, 1, 2, 8.0, 0.0, 4.0, 0.0, 0.0, 0.0, 0.0),
        (2, None, 1, 7.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (None, 2, None, 9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], key=repr)
    got = budgets.totals(budg)
    assert {(r.prop_id, r.RN, r["T"], r.cptr_serv_tot) for r in got.collect()} == {(1, 1, 8.0, 4.0), (2, None, 7.0, None), (None, 2, 9.0, None)}
    plan = budgets.totals(budg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "sum(" not in plan[plan.rindex("Exchange"):]


def test_budget_lines_travel_once_for_sums_by_proposal(spark, folder, shuffled):
    e = Entities(spark, folder)
    got, plan = stages.budget_totals(e), stages.budget_totals(e)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "sum(" not in plan[plan.rindex("Exchange"):]
    was = budgets.totals(e.budg, {}).withColumn("T", F.round("T", 2))
    assert got.columns == was.columns and sorted(got.collect(), key=repr) == sorted(was.collect(), key=repr)
    assert "l_tax" not in plan


@pytest.mark.parametrize("name", ["prj_totals", "win_slots_props", "rpt_splits"])
def test_budget_lines_that_nobody_shows_are_not_summed(spark, folder, name):
    assert "l_tax" not in QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_only_keys_of_reviews_meet_the_panels(spark):
    rev = spark.createDataFrame([(1, 5, "VG"), (1, 5, "VG"), (1, 6, "E"), (2, None, "P"), (None, 5, "G")], "lead long, revr_id long, string string")
    on = spark.createDataFrame([("P02", 1), ("P01", 1), ("X00", 1), ("P03", 2)], "panl_id string, prop_id long")
    seated = spark.createDataFrame([("P01", 5), ("P02", 5), ("X00", 6)], "panl_id string, revr_id long")
    got = reviews.with_panel(rev, on, seated)
    assert got.columns == ["lead", "revr_id", "panl_id", "string"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 5, "P01", "VG"), (1, 6, ".ad hoc", "E"), (2, None, ".ad hoc", "P"), (None, 5, ".ad hoc", "G")], key=repr)
    assert "string#" not in "\n".join(x for x in subtree(optimized(got), "Join LeftSemi").splitlines() if "Project" in x or "Join" in x)
