"""Rules checked as tables arrive, key rules folded into one scan, load order."""

import threading

import pytest

from tableload.operators import integrity
from tableload.operators.integrity import RulesOnLoad, TableRules, constraint_jobs, constraint_report, load_order
from tableload.plans import materialize as mat
from tableload.specs import CheckSpec, ForeignKeySpec, KeySpec

from .conftest import rows


def test_load_order_puts_parents_first_and_cycles_last():
    order = load_order(["c", "a", "x", "b", "y", "z"], [("c", "b"), ("b", "a"), ("x", "y"), ("y", "x"), ("z", "x"), ("a", "a"),
                                                        ("a", "elsewhere")])
    assert order.index("a") < order.index("b") < order.index("c") < order.index("x") and set(order) == set("abcxyz")
    assert order[-3:] == ["x", "y", "z"]


def frames(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "id int, v string")
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, p int")
    return {"parent": parent, "child": child}


def rules(loaded, defer=False):
    return [
        TableRules("child", lambda: loaded["child"], keys=(KeySpec("child_pk", ("id",), True),),
                   foreign_keys=(ForeignKeySpec("child_fk", ("p",), "parent", ("id",)),
                                 ForeignKeySpec("late_fk", ("p",), "parent", ("id",), deferrable=True, deferred=True)),
                   checks=(CheckSpec("ck", "id < 3"), CheckSpec("broken", "no_such_column > 1")), parents=loaded),
        TableRules("parent", lambda: loaded["parent"], not_null=("id",),
                   keys=(KeySpec("parent_pk", ("id",), True), KeySpec("parent_uk", ("id",)),
                         KeySpec("parent_b", ("id",), where="v = 'b'"), KeySpec("parent_none", ("id",), where="v = 'a'"),
                         KeySpec("late", ("id",), deferrable=True, deferred=True)), parents=loaded)]


WANT = {("child", "child_pk"): 0, ("child", "child_fk"): 1, ("child", "late_fk"): 1, ("child", "ck"): 1, ("parent", "id_not_null"): 1,
        ("parent", "parent_pk"): 3, ("parent", "parent_uk"): 2, ("parent", "parent_b"): 2, ("parent", "parent_none"): 0, ("parent", "late"): 2}


def test_immediate_rules_follow_the_loads_and_deferred_ones_the_last(spark, tmp_path, monkeypatch):
    data, loaded, events, lock = frames(spark), {}, [], threading.Lock()
    plain = integrity.ConstraintJob.rows

    def watched(job):
        with lock:
            events.append(job.rules[0][0])
        return plain(job)
    monkeypatch.setattr(integrity.ConstraintJob, "rows", watched)
    on_load = RulesOnLoad(rules(loaded))

    def arrived(name, path):
        events.append(f"load {name}")
        loaded[name] = spark.read.parquet(path)
        on_load.loaded(name)
    for name in ("child", "parent"):
        mat.materialize_many(spark, [mat.TableLoad(name, lambda n=name: data[n], f"{tmp_path}/{name}",
                                                   after=lambda path, n=name: arrived(n, path))])
    done = len(events)
    report = on_load.finish(spark)
    assert events[:3] == ["load child", "child_pk", "ck"]                # the child's own rules, not its foreign key
    assert events[3] == "load parent" and set(events[4:done]) == {"child_fk", "parent_pk", "id_not_null"}
    assert set(events[done:]) == {"late_fk", "late"}
    got = {(r["table_name"], r["constraint_name"]): r for r in report.collect()}
    assert {k: r["violations"] for k, r in got.items() if r["error"] is None} == WANT
    assert "no_such_column" in got["child", "broken"]["error"] and len(got) == len(WANT) + 1
    # the report does not depend on when the rules ran
    whole = constraint_report(spark, rules(loaded), parallelism=3)
    assert rows(whole, "table_name", "constraint_name", "violations") == rows(report, "table_name", "constraint_name", "violations")


def test_rules_of_tables_that_never_came(spark):
    loaded = {"child": frames(spark)["child"]}
    on_load = RulesOnLoad(rules(loaded))
    on_load.loaded("child")
    got = {r["constraint_name"]: r for r in on_load.finish(spark).collect()}
    assert "was not loaded" in got["child_fk"]["error"] and "parent_pk" not in got and got["child_pk"]["violations"] == 0


def test_key_rules_on_the_same_columns_are_one_job(spark):
    data = frames(spark)
    jobs = [j for j in constraint_jobs(rules(data)) if j.table == "parent"]
    assert [len(j.rules) for j in jobs] == [5, 1]
    assert [len(j.rules) for j in constraint_jobs(rules(data), "timed") if j.table == "parent"] == [4, 1, 1]
    bad = TableRules("parent", data["parent"], keys=(KeySpec("pk", ("id",), True), KeySpec("u", ("id",), where="nope = 1")))
    got = {r["constraint_name"]: r for r in constraint_report(spark, [bad]).collect()}
    assert got["pk"]["violations"] == 3 and "nope" in got["u"]["error"]       # only the rule at fault fails


@pytest.mark.parametrize("mode", ["immediate", "deferred", "all"])
def test_modes(spark, mode):
    got = {r["constraint_name"] for r in constraint_report(spark, rules(frames(spark)), mode).collect()}
    late = {"late", "late_fk"}
    assert got == (late if mode == "deferred" else {n for _, n in WANT} | {"broken"} - late if mode == "all"
                   else ({n for _, n in WANT} | {"broken"}) - late)
