"""A session that names no shared folder, started in a process of its own with an empty configuration folder."""

import os
import subprocess
import sys

import pytest

from conftest import SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code: str, folder) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"}
    env |= {"SPARK_CONF_DIR": str(folder), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_session_without_a_shared_folder_runs_settled_queries(tmp_path):
    out = run(f"""
import __spark_entry__ as e
from anemos.session import local_session, shared_dir
spark = local_session(cores="2", memory="2g")
assert spark.conf.get("spark.checkpoint.dir", None) is None
print(shared_dir(spark) == shared_dir(spark))
print(e.entry(spark).count() > 0)
for key in ("op4_perspectives", "drift_ks"):
    if key in e.queries():
        print(e.queries()[key](spark, "{SMALL}").count() > 0)
""", tmp_path)
    assert set(out.split()) == {"True"}


def test_a_cluster_must_name_a_shared_folder(monkeypatch):
    from anemos import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Spark:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "app"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Spark())
