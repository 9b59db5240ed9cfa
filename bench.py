"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names, or all),
BENCH_RUNS (default 3). Each query runs once to warm up; the median of the following runs counts.
Set BENCH_DUCKDB=1 to time the checking SQL on the same tables as well.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rev_summary", "cat_codes_space", "prj_expand", "win_project_no", "flt_criteria", "agg_budget_totals",
    "rpt_panelist_stats", "rpt_reviewer_stats", "rpt_transfers", "rpt_new_institutions", "rpt_props_on_panels",
    "rpt_compliance_proj", "rpt_pi_pending", "txt_collect", "rpt_coding_check", "rpt_project_wide", "pvt_count_2d",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    from grantlens.catalog import CHECKS, QUERIES
    from grantlens.session import local_session
    from grantlens.sources.sinks import clear_work

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")

    def once(name):
        return lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        once(name)()
        times[name] = round(statistics.median(seconds(once(name)) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    out = {"metric": "total of headline queries, warm median", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}
    if os.environ.get("BENCH_DUCKDB") == "1":
        from tools.compare import database

        con = database(folder)
        duck = {}
        for name in names:
            con.execute(CHECKS[name]).fetchall()
            duck[name] = round(statistics.median(seconds(lambda: con.execute(CHECKS[name]).fetchall()) for _ in range(runs)), 3)
        out["duckdb"] = duck
    clear_work(spark)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
