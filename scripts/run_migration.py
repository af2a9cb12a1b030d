"""Run a whole load from a catalog snapshot stored as Parquet tables.

Usage:
  python scripts/run_migration.py --snapshot DIR --source "/data/{schema}/{table}" \
      --format parquet|orc|csv|json|copy --target DIR [--clusters DIR] [--functions FILE] [--parallelism N]

``DIR`` of the snapshot holds one Parquet table per catalog table (``tables``,
``columns``, ``partitions``, ``subpartitions``, ``keys``, ``foreign_keys``, ``checks``,
``indexes``, ``index_columns``, ``views``, ``sequences``; missing ones are skipped).
``--source`` is a path template filled with each table's schema and source name.
Tables land below ``--target/<schema>/<table>``; the run log and the constraint report
are written to ``--target/_log`` and ``--target/_report``.  ``--functions FILE`` names a
JSON list of SQL functions to create before the views, e.g.
``[{"name": "multiply", "args": [["a", "int"], ["b", "int"]], "returns": "int",
"body": "a * b"}]``.  Exit status 1 when anything failed.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableload.functions.sqlfuncs import FunctionSpec  # noqa: E402
from tableload.plans.migrate import migrate  # noqa: E402
from tableload.plans.runlog import append_log  # noqa: E402
from tableload.session import local_session  # noqa: E402
from tableload.sources import scan_declared, scan_delimited  # noqa: E402

SNAPSHOT_TABLES = ("tables", "columns", "partitions", "subpartitions", "keys", "foreign_keys", "checks",
                   "indexes", "index_columns", "views", "sequences")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--snapshot", required=True)
    ap.add_argument("--source", required=True, help='path template, e.g. "/data/{schema}/{table}.parquet"')
    ap.add_argument("--format", default="parquet", choices=["parquet", "orc", "csv", "json", "copy"])
    ap.add_argument("--target", required=True)
    ap.add_argument("--clusters", default=None, help="write clustered copies of plain indexes here")
    ap.add_argument("--parallelism", type=int, default=4)
    ap.add_argument("--functions", default=None, help="JSON file with SQL functions for the views")
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit inside spark-submit")
    args = ap.parse_args(argv)

    if args.master:
        spark = local_session(args.master.removeprefix("local[").removesuffix("]") or "*")
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.getOrCreate()

    snapshot = {}
    for name in SNAPSHOT_TABLES:
        path = os.path.join(args.snapshot, name)
        if os.path.exists(path) or "://" in args.snapshot:
            try:
                snapshot[name] = spark.read.parquet(path)
            except Exception:  # noqa: BLE001 - a catalog table that is not there is skipped
                pass

    def read(schema: str, table: str, columns):
        path = args.source.format(schema=schema, table=table)
        if args.format == "copy":
            return scan_delimited(spark, path, columns)
        return scan_declared(spark, args.format, path, columns)

    functions = []
    if args.functions:
        with open(args.functions) as f:
            functions = [FunctionSpec(d["name"], tuple(tuple(a) for a in d["args"]), d["returns"], d["body"],
                                      migrate=d.get("migrate", True)) for d in json.load(f)]
    failures, log, report = migrate(spark, snapshot, read, args.target, parallelism=args.parallelism,
                                    functions=functions, cluster_root=args.clusters)
    target = args.target.rstrip("/")
    append_log(log, f"{target}/_log")
    report.write.mode("overwrite").parquet(f"{target}/_report")
    report.orderBy("table_name", "constraint_name").show(200, truncate=False)
    print(f"failures: {failures}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
