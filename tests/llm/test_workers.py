"""Executors without a copy of this package: everything that tasks use travels with the job."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from grantlens.session import local_session
from grantlens.llm.queries import QUERIES
spark = local_session(4, "bare")
spark.conf.set("spark.sql.shuffle.partitions", "2")

def missing(batches):
    import importlib.util
    for b in batches:
        assert importlib.util.find_spec("grantlens") is None
        yield b

assert spark.range(1).mapInArrow(missing, "id long").count() == 1
for name in ("op1_decontaminate", "op3_ppm", "op4_quality", "op7_neighbours", "op8_main_text", "op11_centroids", "op12_near_duplicates", "op13_merkle"):
    assert QUERIES[name](spark, {folder!r}).count() > 0, name
print("all done")
"""


def test_workers_need_no_copy_of_the_package(folder, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, folder=folder)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all done" in done.stdout, done.stderr[-3000:]
