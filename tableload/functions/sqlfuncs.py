"""UF1: register scalar SQL functions for queries, views, keys and checks.

Spark's SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN expr``) are inlined by
Catalyst into the calling plan, so they run JVM-side like built-ins.  Integer division
in function bodies written for the source database truncates toward zero; write it as
``a div b`` (``/`` in Spark always returns a fractional result).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..operators.project import spark_type


@dataclass(frozen=True)
class FunctionSpec:
    name: str
    args: tuple[tuple[str, str], ...]       # (argument name, type name)
    returns: str
    body: str                               # a Spark SQL expression over the arguments
    migrate: bool = False                   # functions are opt-in, as in the catalog


def register_sql_function(spark: SparkSession, name: str, args: Sequence[tuple[str, str]],
                          returns: str, body: str) -> None:
    arglist = ", ".join(f"{a} {spark_type(t)}" for a, t in args)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arglist}) "
              f"RETURNS {spark_type(returns)} RETURN {body}")


def register_functions(spark: SparkSession, specs: Sequence[FunctionSpec]) -> list[str]:
    """Register every flagged function; returns the registered names."""
    done = []
    for f in specs:
        if f.migrate:
            register_sql_function(spark, f.name, f.args, f.returns, f.body)
            done.append(f.name)
    return done
