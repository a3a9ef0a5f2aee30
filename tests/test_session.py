"""Session defaults and the checkpoint folder."""

import os
import subprocess
import sys

import pytest

from basketry import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code, **env):
    out = subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONPATH": ROOT, **env},
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.strip().splitlines()[-1]


def test_explicit_settings_survive():
    code = ("from basketry import get_spark; s = get_spark('local[1]', 3)\n"
            "print(s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.shuffle.partitions'),"
            " s.conf.get('spark.ui.enabled'), s.sparkContext.master)")
    args = "--conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.sql.shuffle.partitions=5 pyspark-shell"
    assert _run(code, PYSPARK_SUBMIT_ARGS=args) == "Asia/Tokyo 5 false local[1]"
    assert _run(code, PYSPARK_SUBMIT_ARGS="pyspark-shell") == "UTC 3 false local[1]"


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Conf:
    def get(self, key, default=None):
        return default


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_checkpoint_folder_must_be_named_on_a_cluster(master):
    class Spark:
        sparkContext, conf = _Context(master), _Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Spark())


def test_local_masters():
    assert all(map(session.is_local, ("local", "local[*]", "local[4]", "local[4,2]")))


def test_eval_sample_plan_has_no_single_task_sort(spark):
    from basketry.operators.prepare import eval_sample
    users = spark.range(1000).selectExpr("id % 300 as user_id")
    for n, want in ((1_000_000, 300), (40, 40), (None, 300)):
        sample = eval_sample(users, n)
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
        assert sample.count() == want
