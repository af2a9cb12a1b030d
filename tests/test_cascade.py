"""Deletes through a graph of foreign keys, against a row-by-row model."""

import random

import pytest

from tableload.operators.cascade import DeleteBlocked, cascade_delete
from tableload.specs import ForeignKeySpec

from .conftest import rows


def fk(name, columns, parent, parent_columns, rule):
    return ForeignKeySpec(name, tuple(columns.split()), parent, tuple(parent_columns.split()), rule)


def model(tables, keys, named):
    """Rows left, one row at a time: {table: [dict]} after deleting the named row ids."""
    gone = {t: set(named.get(t, ())) for t in tables}
    while True:
        more = False
        for child, k in keys:
            if k.delete_rule != "CASCADE":
                continue
            dead = {tuple(tables[k.parent][i][c] for c in k.parent_columns) for i in gone[k.parent]}
            for i, r in enumerate(tables[child]):
                ref = tuple(r[c] for c in k.columns)
                if i not in gone[child] and None not in ref and ref in dead:
                    gone[child].add(i)
                    more = True
        if not more:
            break
    out = {}
    for t, rs in tables.items():
        out[t] = []
        for i, r in enumerate(rs):
            if i in gone[t]:
                continue
            r = dict(r)
            for child, k in keys:
                if child == t and k.delete_rule == "SET NULL":
                    dead = {tuple(tables[k.parent][j][c] for c in k.parent_columns) for j in gone[k.parent]}
                    if tuple(tables[t][i][c] for c in k.columns) in dead:
                        r.update({c: None for c in k.columns})
            out[t].append(r)
    return out


def frame(spark, rs, schema):
    return spark.createDataFrame([tuple(r.values()) for r in rs], schema)


@pytest.mark.parametrize("seed", [0, 3])
def test_self_reference_cycle_and_two_paths_equal_the_model(spark, seed):
    rng = random.Random(seed)
    n = 40
    pick = lambda k=n: rng.choice([None, *range(k)])
    a = [{"id": i, "up": pick(), "b": pick()} for i in range(n)]           # refers to itself and to b
    b = [{"id": i, "a": pick(), "note": f"n{i}"} for i in range(n)]        # refers back to a: a cycle
    c = [{"x": i % 7, "y": i, "a": pick(), "b": pick()} for i in range(n)]
    d = [{"k": i, "cx": rng.choice([None, *range(7)]), "cy": pick()} for i in range(n)]
    e = [{"k": i, "a": pick(), "d": pick()} for i in range(n)]
    tables = {"a": a, "b": b, "c": c, "d": d, "e": e}
    keys = [("a", fk("a_up", "up", "a", "id", "CASCADE")), ("a", fk("a_b", "b", "b", "id", "SET NULL")),
            ("b", fk("b_a", "a", "a", "id", "CASCADE")), ("c", fk("c_a", "a", "a", "id", "CASCADE")),
            ("c", fk("c_b", "b", "b", "id", "SET NULL")), ("d", fk("d_c", "cx cy", "c", "x y", "CASCADE")),
            ("e", fk("e_a", "a", "a", "id", "SET NULL")), ("e", fk("e_d", "d", "d", "k", "CASCADE"))]
    schemas = {"a": "id int, up int, b int", "b": "id int, a int, note string", "c": "x int, y int, a int, b int",
               "d": "k int, cx int, cy int", "e": "k int, a int, d int"}
    named = {"a": [i for i in range(n) if i % 29 == seed], "d": [3]}
    want = model(tables, keys, named)
    got = cascade_delete({t: frame(spark, r, schemas[t]) for t, r in tables.items()}, keys,
                         {"a": f"id % 29 = {seed}", "d": "k = 3"}).tables
    for t in tables:
        assert rows(got[t]) == sorted((tuple(r.values()) for r in want[t]), key=lambda r: tuple((x is None, x) for x in r)), t


def test_long_chain_ends_and_takes_all(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(13)], "id int, up int")
    keys = [("t", fk("up", "up", "t", "id", "CASCADE"))]
    assert cascade_delete({"t": chain}, keys, {"t": "id = 2"}).tables["t"].count() == 2


def tree(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (20, 2), (30, None)], "id int, p int")
    leaf = spark.createDataFrame([(100, 10, 1), (200, 20, 2)], "id int, c int, p int")
    return {"parent": parent, "child": child, "leaf": leaf}


def test_no_action_waits_for_the_end_and_restrict_does_not(spark):
    def keys(rule):
        return [("child", fk("cp", "p", "parent", "id", "CASCADE")), ("leaf", fk("lc", "c", "child", "id", "CASCADE")),
                ("leaf", fk("lp", "p", "parent", "id", rule))]
    left = cascade_delete(tree(spark), keys("NO ACTION"), {"parent": "id = 1"}).tables
    assert rows(left["leaf"]) == [(200, 20, 2)]
    with pytest.raises(DeleteBlocked, match="RESTRICT"):
        cascade_delete(tree(spark), keys("RESTRICT"), {"parent": "id = 1"})
    # rows of the delete itself never block
    left = cascade_delete(tree(spark), keys("RESTRICT"), {"parent": "id = 1", "leaf": "p = 1"}).tables
    assert rows(left["parent"]) == [(2,)] and rows(left["leaf"]) == [(200, 20, 2)]


def test_set_default_needs_a_parent_that_is_left(spark):
    keys = [("child", fk("cp", "p", "parent", "id", "SET DEFAULT"))]
    left = cascade_delete(tree(spark), keys, {"parent": "id = 1"}, {("child", "p"): "2"}).tables
    assert rows(left["child"]) == [(10, 2), (20, 2), (30, None)]
    with pytest.raises(DeleteBlocked, match="overwritten"):
        cascade_delete(tree(spark), keys, {"parent": "id = 1"}, {("child", "p"): "7"})
    left = cascade_delete(tree(spark), keys, {"parent": "true"}).tables
    assert rows(left["child"]) == [(10, None), (20, None), (30, None)]


def test_overwriting_a_referenced_column_must_not_orphan(spark):
    top = spark.createDataFrame([(1,)], "id int")
    mid = spark.createDataFrame([(5, 1)], "k int, t int")
    low = spark.createDataFrame([(1,)], "m int")
    keys = [("mid", fk("mt", "t", "top", "id", "SET NULL")), ("low", fk("lm", "m", "mid", "t", "CASCADE"))]
    with pytest.raises(DeleteBlocked, match="lm"):
        cascade_delete({"top": top, "mid": mid, "low": low}, keys, {"top": "id = 1"})


def test_nothing_deleted_and_bad_specs(spark):
    t = tree(spark)
    keys = [("child", fk("cp", "p", "parent", "id", "CASCADE"))]
    got = cascade_delete(t, keys, {"parent": "id = 9 OR id IS NULL"})
    assert rows(got.tables["child"]) == rows(t["child"]) and {r["rows"] for r in got.report.collect()} == {0}
    assert cascade_delete(t, keys, {}).report.count() == 0
    for bad in ([("child", fk("x", "p", "nowhere", "id", "CASCADE"))], [("child", fk("x", "p", "parent", "id", "MERGE"))],
                [("child", fk("x", "id p", "parent", "id", "CASCADE"))]):
        with pytest.raises(ValueError):
            cascade_delete(t, bad, {"parent": "id = 1"})
