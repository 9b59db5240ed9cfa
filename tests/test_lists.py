"""Complete lists against their checking SQL, and against the capped columns that they belong to."""

import pytest

from grantlens.catalog import LIST_CHECKS, LISTS, QUERIES
from tools.compare import compare, database


def test_lists_are_registered():
    import __spark_entry__ as entry

    assert set(LISTS) == set(LIST_CHECKS) and not set(LISTS) & set(QUERIES)
    assert {"all_ratings_by_panel", "all_conflict_people", "all_emails", "all_people", "all_recommendations"} <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(LISTS))
def test_list(spark, folder, name):
    ok, note, _ = compare(spark, database(folder), folder, name, LISTS[name], LIST_CHECKS[name])
    assert ok and not note.startswith("0 rows"), note


def test_all_ratings_are_listed_by_panel(spark, folder):
    """As many rows as a panel counts, beyond the places of the string."""
    listed = LISTS["all_ratings_by_panel"](spark, folder).groupBy("lead").count().collect()
    everything = QUERIES["all_ratings"](spark, folder).groupBy("lead").count().collect()
    assert sorted(map(tuple, listed)) == sorted(map(tuple, everything))
