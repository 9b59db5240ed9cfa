"""The criteria language: the documented inputs, edge cases, and that filters reach the scan."""

import pytest
from pyspark.sql import functions as F

from grantlens.functions import criteria
from grantlens.operators import children

CODES = ["1234", "2222", "3333", "1299", "1230", "0000", None]


@pytest.fixture(scope="module")
def codes(spark):
    return spark.createDataFrame([(x,) for x in CODES], "code string")


def chosen(df, spec):
    cond = criteria.predicate("code", spec)
    rows = df if cond is None else df.filter(cond)
    return {r[0] for r in rows.collect()}


@pytest.mark.parametrize("spec, expected", [
    ("1234", {"1234"}),
    ("'1234',\"2222\",3333", {"1234", "2222", "3333"}),
    ("'12%'", {"1234", "1299", "1230"}),
    ("1234::2222", {"1234", "1299", "2222"}),
    ("~'1234'", {"2222", "3333", "1299", "1230", "0000"}),
    ("~'1234',\"2222\",3333", {"1299", "1230", "0000"}),
    ("~'12%'", {"2222", "3333", "0000"}),
    ("~1234::2222", {"3333", "1230", "0000"}),
    (" 1234 , 2222 ", {"1234", "2222"}),
    ("12_[09]", {"1230", "1299"}),
    ("12_[^09]", {"1234"}),
    ("[1-2]2%", {"1234", "1299", "1230", "2222"}),
    ("", set(CODES)), (None, set(CODES)), ("eg: 1234", set(CODES)), ("   ", set(CODES)),
])
def test_inputs(codes, spec, expected):
    assert chosen(codes, spec) == expected


@pytest.mark.parametrize("spec", ["1234::2222", "~1234::2222"])
def test_negation_over_children_means_none(spark, spec):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "prop_id long")
    child = spark.createDataFrame([(1, "1300"), (1, "9999"), (2, "9999")], "prop_id long, code string")
    got = {r[0] for r in children.by_codes(parent, child, "code", spec).collect()}
    assert got == ({2, 3} if spec.startswith("~") else {1})


def test_other_child_is_weaker_than_none(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "prop_id long")
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "prop_id long, code string")
    assert {r[0] for r in children.other_child(parent, child, F.col("code") == "a").collect()} == {1}


@pytest.mark.parametrize("spec", ["'12%',2222,3333", "12%::13", "~a_,b"])
def test_wildcards_do_not_mix(spec):
    with pytest.raises(criteria.CriteriaError):
        criteria.predicate("code", spec)


def test_text_cannot_become_sql(codes):
    assert chosen(codes, "x' OR '1'='1") == set()


def test_regex_characters_are_literal(spark):
    df = spark.createDataFrame([("a.c",), ("abc",), ("a+c[1]",), ("a\\c",)], "code string")
    assert chosen(df, "a.[c]") == {"a.c"}
    assert chosen(df, "a\\%") == {"a\\c"}


def test_nothing_without_restriction(codes):
    assert criteria.apply(codes, {"code": " "}).count() == 0
    with pytest.raises(criteria.CriteriaError):
        criteria.apply(codes, {"code": "eg: x"}, when_empty="error")


def test_filters_reach_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    df = criteria.apply(orders, {"o_orderpriority": "1-URGENT,2-HIGH", "o_orderstatus": "F%", "o_custkey": "5::50"},
                        integers=("o_custkey",)).select("o_orderkey")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("In(o_orderpriority", "StringStartsWith(o_orderstatus,F)", "GreaterThanOrEqual(o_custkey,5)"):
        assert part in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
