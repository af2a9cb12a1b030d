"""Failure log (E1) and failure tally (A5).

Each step is one Spark action (a load, a validation).  A failing step becomes one log
row and the run goes on with the next step; the log is an ordinary DataFrame that can
be appended to a Parquet table.  Only the step bookkeeping lives on the driver (one
row per step); the data work of every step runs on the executors.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("run_id string, ordinal int, log_time timestamp, operation string, schema_name string, "
              "object_name string, failed_sql string, error_message string")


@dataclass
class Step:
    operation: str
    object_name: str
    action: Callable[[], Any]
    schema_name: str | None = None
    statement: str | None = None        # what was attempted, kept in ``failed_sql``


def error_text(exc: BaseException) -> str:
    """``message: detail`` -- the error's whole text, then its class or error condition."""
    message = str(exc).strip() or exc.__class__.__name__
    detail = None
    get_cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    if callable(get_cond):
        try:
            detail = get_cond()
        except Exception:  # noqa: BLE001 - best effort only
            detail = None
    return f"{message}: {detail or exc.__class__.__name__}"


def run_logged(spark: SparkSession, steps: Sequence[Step], parallelism: int = 1,
               run_id: str | None = None) -> tuple[dict[str, Any], DataFrame]:
    """Run every step; return ``(results by object name, log DataFrame)``.

    An object name that several steps share is keyed as (schema, name), and as (schema,
    name, place in the list) if that is not unique either.

    A failing step (``None`` results count as failures too) adds a log row and does not
    stop the others.  ``parallelism > 1`` submits steps from driver threads, so Spark
    runs their jobs side by side.
    """
    run_id = run_id or uuid.uuid4().hex
    results: dict[str, Any] = {}
    rows: list[tuple] = []
    lock = threading.Lock()
    names = Counter(s.object_name for s in steps)
    full = Counter((s.schema_name, s.object_name) for s in steps)

    def key(i: int, s: Step):
        if names[s.object_name] == 1:
            return s.object_name
        both = (s.schema_name, s.object_name)
        return both if full[both] == 1 else (*both, i)

    def one(i: int, step: Step):
        try:
            out = step.action()
            if out is None:
                raise RuntimeError("step returned no result")
            with lock:
                results[key(i, step)] = out
        except Exception as exc:  # noqa: BLE001 - every failure is logged, none stops the run
            with lock:
                rows.append((run_id, i, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
                             step.operation, step.schema_name, step.object_name, step.statement,
                             error_text(exc)))

    if parallelism <= 1:
        for i, s in enumerate(steps):
            one(i, s)
    else:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(lambda a: one(*a), enumerate(steps)))
    rows.sort(key=lambda r: r[1])
    return results, spark.createDataFrame(rows, LOG_SCHEMA)


def append_log(log: DataFrame, path: str) -> None:
    """Append log rows to a Parquet log table."""
    log.write.mode("append").parquet(path)


def failure_tally(log: DataFrame) -> DataFrame:
    """A5: failures per operation plus a total row (``operation = 'total'``, 0 for an empty log)."""
    failures = F.count(F.lit(1)).cast("bigint").alias("failures")
    total = log.agg(failures).select(F.lit("total").alias("operation"), "failures")
    return log.groupBy(F.col("operation").cast("string").alias("operation")).agg(failures).unionByName(total)
