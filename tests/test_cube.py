"""The cube of the dashboards: built once, merged exactly, rebuilt when files change."""

import shutil

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from grantlens.catalog import LISTS, QUERIES
from grantlens.operators import cube
from grantlens.plans import stages
from grantlens.session import isolated
from grantlens.sources.entities import Entities

PIVOTS = ["pvt_count_1d", "pvt_count_program", "pvt_count_request", "pvt_count_organisation", "pvt_program_request", "pvt_count_2d", "pvt_minavgmax", "pvt_filtered"]
MORE = ["pvt_count_class", "pvt_count_kind", "pvt_count_officer", "pvt_sliced"]


def test_pivots_read_the_cube_and_no_proposal(spark, folder):
    stages.proposal_cube(Entities(spark, folder))
    for name in PIVOTS + MORE:
        text = {**QUERIES, **LISTS}[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "orders.parquet" not in text and "customer.parquet" not in text, name


def test_the_cube_is_stored_once(spark, folder):
    first, again = (stages.proposal_cube(Entities(isolated(spark), folder)).inputFiles() for _ in range(2))
    assert first and first == again


def test_the_cube_follows_its_tables(spark, folder, tmp_path):
    for t in stages.CUBE_TABLES:
        shutil.copy(f"{folder}/{t}.parquet", tmp_path / f"{t}.parquet")
    whole = stages.proposal_cube(Entities(spark, str(tmp_path))).agg(F.sum("n")).first()[0]
    part = pq.read_table(f"{folder}/orders.parquet").slice(0, 100)
    (tmp_path / "orders.parquet").unlink()
    pq.write_table(part, tmp_path / "orders.parquet")
    assert whole > 100 and stages.proposal_cube(Entities(spark, str(tmp_path))).agg(F.sum("n")).first()[0] == 100


def test_averages_are_exact_halves_up(spark):
    """Sums are whole numbers, so no order of rows can move a half; amounts that are not there do not count."""
    rows = [("a", 0.00005), ("a", 0.0001), ("b", -1.00025), ("b", -1.0), ("c", None), ("d", 2.0), ("d", None)]
    base = spark.createDataFrame([(k, "x", v) for k, v in rows], "k string, other string, rqst_dol double")
    found = cube.measures()
    got = {r["k"]: r for r in cube.build(base, ["k", "other"]).groupBy("k").agg(*[found[m].alias(m) for m in found]).collect()}
    assert got["a"]["avg_dol"] == 0.0001 and got["b"]["avg_dol"] == -1.0002 and got["c"]["avg_dol"] is None and got["d"]["avg_dol"] == 2.0
    assert got["d"]["n"] == 2 and got["c"]["min_dol"] is None
