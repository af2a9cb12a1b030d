"""Results stay exact when tasks fail and are retried (lost executors, preempted tasks)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_operators_survive_task_retries():
    job = os.path.join(ROOT, "tests", "jobs", "retry_job.py")
    out = subprocess.run([sys.executable, job, ROOT], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    res = json.loads(out.stdout.strip().splitlines()[-1])
    n = res["n"]
    assert res["dense_in_order"]
    assert res["clustered_rows"] == res["clustered_distinct"] == n
    assert res["parted_rows"] == res["parted_distinct"] == n
