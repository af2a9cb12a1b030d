"""The driver contract: bench.py prints one JSON line; entry/queries/oracle_sql agree."""

import json
import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="route_hash,check_pk",
               BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         env=env, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and set(res["queries"]) == {"route_hash", "check_pk"}
    assert res["value"] > 0 and res["sf"] == 0.001 and res["metric"]


def test_query_names_are_stable_identifiers():
    names = list(entry.queries())
    assert len(names) == len(set(names))
    assert all(n.isidentifier() and n.islower() for n in names)
    assert set(entry.oracle_sql()) <= set(names)
