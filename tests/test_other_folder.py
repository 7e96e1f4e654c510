"""Workers find the package when the session starts in another folder, and
the entry module imports where the corpus operators' libraries are missing."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

KNN = f"""
import sys; sys.path.insert(0, {ROOT!r})
from riskframe.session import build_session
from riskframe.operators.knn import knn
spark = build_session("local[2]", shuffle_partitions=2)
spark.sparkContext.setCheckpointDir("ckpt")
df = spark.createDataFrame([(str(i), float(i * i % 17), float(i)) for i in range(40)], "id string, a double, b double")
print("rows", knn(df, ["a", "b"], "id", k=2).count())
"""

GUARD = f"""
import sys; sys.path.insert(0, {ROOT!r})
sys.modules["xxhash"] = sys.modules["ahocorasick"] = sys.modules["tokenizers"] = None
import __spark_entry__ as E
names = set(E.queries())
print("queries", len(names) >= 97, any(n.startswith("op") and n[2].isdigit() for n in names))
"""


def run(code, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=300)


def test_workers_find_the_package(tmp_path):
    done = run(KNN, tmp_path)
    assert "rows 80" in done.stdout, done.stderr[-2000:]


def test_entry_without_libraries(tmp_path):
    done = run(GUARD, tmp_path)
    assert "queries True False" in done.stdout, done.stderr[-2000:]
