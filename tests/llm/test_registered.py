"""All registered text queries run, and agree with their SQL where there is one."""

import pytest

import __spark_entry__ as entry
from grantlens.llm.queries import CHECKS, QUERIES
from tools.compare import compare, database


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_sql(spark, folder, name):
    ok, note, _ = compare(spark, database(folder), folder, name, QUERIES[name], CHECKS[name])
    assert ok, note
