"""Shuffle sizes, the caller's session, and the folder for intermediate tables."""

import pytest

from grantlens.catalog import QUERIES
from grantlens.functions.ordered import step_levels
from grantlens.session import initial_partitions, isolated
from grantlens.sources.tables import Catalog
from grantlens.sources.sinks import work_folder


def test_partitions_follow_what_is_read():
    assert initial_partitions(10 << 20, 8) == 8
    assert initial_partitions(500 << 30, 8) == 500
    assert 10_000 <= initial_partitions(100 << 40, 200) <= 40_000


def test_sizes_of_tables(spark, folder):
    known = Catalog(spark, folder)
    assert known.size("lineitem") > known.size("nation") > 0


def test_a_query_has_its_callers_settings_and_leaves_them(spark):
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "CORRECTED")
    own = isolated(spark)
    assert own.conf.get("spark.sql.legacy.timeParserPolicy") == "CORRECTED" and own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    own.conf.set("spark.sql.shuffle.partitions", "77")
    assert spark.conf.get("spark.sql.shuffle.partitions") != "77"
    spark.conf.unset("spark.sql.legacy.timeParserPolicy")


def test_the_callers_session_stays_as_it_is(spark, folder):
    before = dict(spark.conf.getAll)
    frame = QUERIES["prj_counts"](spark, folder)
    assert dict(spark.conf.getAll) == before
    assert frame.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_work_folder_is_shared(spark):
    assert work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_steps_of_running_numbers_grow_with_the_data():
    assert [step_levels(n) for n in (1, 8, 64, 200, 2000, 32_768)] == [8, 8, 8, 10, 13, 14]


def test_a_cluster_needs_a_shared_folder():
    from grantlens.sources.sinks import _in_warehouse

    assert _in_warehouse("hdfs://name/warehouse", "yarn") == "hdfs://name/warehouse/_work"
    assert _in_warehouse("file:/tmp/warehouse", "local[4]") == "file:/tmp/warehouse/_work"
    for warehouse in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse", "file:///x"):
        with pytest.raises(RuntimeError):
            _in_warehouse(warehouse, "spark://host:7077")
