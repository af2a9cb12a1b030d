"""Hard negatives, benchmark passages and the filter audit against brute force, and on odd input."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableload.llm import decontaminate, filter_audit, hard_negatives

from .test_text_operators import ODD, SCHEMA, documents


# --------------------------------------------------------------------------- filter audit

def failures(rows):
    """Set of failed filters of each (doc_id, text) row."""
    out = []
    for doc_id, text in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        failed |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        if doc_id is not None and any(o is not None and o < doc_id and (x or "") == t for o, x in rows):
            failed.add("E")
        out.append(failed)
    return out


def brute_audit(rows, parts, good, toxic):
    failed, out = failures(rows), {}
    for part in set(parts):
        mine = [i for i, p in enumerate(parts) if p == part]
        removed_in = {f: 0 for f in "ABCDE"}
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in failed[i]]
                left = [i for i in left if f not in failed[i]]
                removed_in[f] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone),
                              sum(f in failed[i] for i in mine) - len(gone), sum(failed[i] == {f} for i in mine),
                              sum(good[i] for i in gone), sum(toxic[i] for i in gone)))
        for line in lines:
            out[line[:3]] = (*line[3:], removed_in[line[1][line[2] - 1]])
    return out


@pytest.fixture(scope="module")
def audited(spark):
    rng = random.Random(5)
    long = [" ".join(rng.choice(["alpha", "Beta", "GAMMA", "x#y"]) + str(rng.randint(0, n)) for _ in range(220))
            for n in (2, 50, 400, 400)]
    plain = [" ".join(f"word{rng.randint(0, 900)}" for _ in range(230)) for _ in range(4)]
    texts = ODD + long + plain + plain[:2] + ["A\x0bb c", "a b", "", " ", "ÀÉ" * 300, None]
    ids = list(range(len(texts)))
    ids[3], ids[-2] = None, None                                           # unnamed rows
    rows = list(zip(ids, texts)) + [(ids[10], texts[10]), (ids[10], texts[10]), (7, texts[12])]
    parts = [("s1", None, "", "s2")[i % 4] for i in range(len(rows))]
    docs = spark.createDataFrame([(i, t, "en", p, None, 7, "k", "f", "t") for (i, t), p in zip(rows, parts)], SCHEMA)
    marks = [(i, i % 3 == 0, i % 4 == 0) for i in range(0, len(texts), 2)] + [(0, False, True), (None, True, True)]
    labels = spark.createDataFrame([(i, int(q), int(t)) for i, q, t in marks] + [(5, None, None)],
                                   "doc_id long, quality int, toxic int")
    return rows, [p or "" for p in parts], docs, labels, marks


def test_audit_equals_every_order_run_by_hand(audited):
    rows, parts, docs, labels, marks = audited
    good = [any(m[0] == i and m[1] for m in marks) if i is not None else False for i, _ in rows]
    toxic = [any(m[0] == i and m[2] for m in marks) if i is not None else False for i, _ in rows]
    got = filter_audit.audit(filter_audit.mask_counts(docs, labels)).collect()
    assert {(r[0], r[1], r[2]): tuple(r)[3:] for r in got} == brute_audit(rows, parts, good, toxic)
    assert len(got) == 600 * len(set(parts))


def test_swapping_levels_keeps_the_counts_and_shares_nodes():
    rng = random.Random(1)
    counts = {m: (rng.randint(1, 9), 0, 0) for m in rng.sample(range(32), 20)}
    root, order = filter_audit.diagram(counts, list(range(5))), list(range(5))
    seen = {tuple(order)}
    for level in filter_audit.neighbour_swaps(5):
        root = filter_audit.swap_levels(root, level)
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
        for mask, n in counts.items():
            node = root
            for name in order:
                node = node[2 if mask >> name & 1 else 1]
            assert node[0] == n
    assert len(seen) == 120 and root[0][0] == sum(n[0] for n in counts.values())


def test_audit_of_nothing(spark, audited):
    _, _, docs, labels, _ = audited
    assert filter_audit.audit(filter_audit.mask_counts(docs.limit(0), labels)).count() == 0
    none = filter_audit.audit(filter_audit.mask_counts(docs, labels.limit(0))).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(none) == (0, 0)


# --------------------------------------------------------------------------- benchmark passages

def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        n = min(10, len(own))
        for w in {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) == w:
                    hit |= set(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    runs = []
    for p in sorted(hit):
        if runs and p == sum(runs[-1]):
            runs[-1] = (runs[-1][0], runs[-1][1] + 1)
        else:
            runs.append((p, 1))
    return len(words), len(hit), runs, sorted(found)


def test_passages_equal_brute_force(spark):
    rng = random.Random(2)
    some = ["la", "lo", "Été", "ΑΣ", "ας", "x1", "I", "K", "İz", "Straße", "na"]
    line = lambda n: " ".join(rng.choice(some) for _ in range(n))
    items = [(i, line(rng.randint(10, 30))) for i in range(12)]
    items += [(20, "Short Item here"), (21, "la"), (22, ""), (None, line(12)), (23, None), (20, line(11)), (24, "la " * 40),
              (25, "ΑΣ.Α one two three four five six seven eight nine"), (5, items[5][1]), (26, "a-b_c")]
    texts = list(ODD) + [line(rng.randint(1, 60)) for _ in range(25)]
    for _, body in items:
        if body:
            own = words_of(body)
            at = rng.randint(0, max(0, len(own) - 10))
            texts += [line(5) + ", " + ";".join(own[at:at + 14]).upper().replace("É", "é") + " " + line(4), body + " " + body]
    texts += ["α ΑΣ Α ONE two. three four five six seven eight nine", "short, item: HERE", "la " * 300, "a b c", "A B_C", texts[9], None]
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id int, text string, _row string")
    got = decontaminate.contamination(docs, bench).select("_row.doc_id", "n_words", "n_hit", "spans", "items", "contaminated").collect()
    assert len(got) == len(texts)
    for r in got:
        n, hit, runs, found = brute_hits(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], [tuple(s) for s in r["spans"]], r["items"], r["contaminated"]) == \
            (n, hit, runs, found, hit > 0), texts[r["doc_id"]]
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not r["contaminated"] for r in got)


def test_joins_without_broadcast_give_the_same(spark, monkeypatch):
    body = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [f"start {body[i:i + 90]} end" for i in range(0, 100, 7)] + [body] * 3)
    bench = spark.createDataFrame([(1, body), (2, "w3 w4")], "item_id int, text string")
    result = lambda: sorted((r["_row"]["doc_id"], r["n_hit"], tuple(r["items"]))
                            for r in decontaminate.contamination(docs, bench).collect())
    once = result()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert result() == once and any(n for _, n, _ in once)


def test_no_items_or_no_documents(spark):
    docs = documents(spark, ["one two three four five six seven eight nine ten"])
    bench = spark.createDataFrame([(1, docs.first()["text"])], "item_id int, text string")
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    r = decontaminate.contamination(docs, bench.limit(0)).first()
    assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == (10, 0, [], False)


def test_winnowed_sides_share_a_hash_for_every_window(spark):
    rng = random.Random(3)
    span = [f"s{i}" for i in range(10)]
    texts = [" ".join([f"a{rng.random()}" for _ in range(rng.randint(0, 12))] + span + [f"b{rng.random()}"] * rng.randint(0, 9))
             for _ in range(30)]
    df = documents(spark, texts).select("doc_id", decontaminate.raw_words(F.col("text")).alias("w"))
    prints = decontaminate.fingerprints(df, "w", ["doc_id"], []).collect()
    sets = [{r["print"] for r in prints if r["doc_id"] == i} for i in range(30)]
    assert set.intersection(*sets)


# --------------------------------------------------------------------------- hard negatives

def brute_mine(rows, k=10):
    out = set()
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, label, v in rows:
        if i % 100:
            continue
        others = sorted(((-score(v, w), j, m) for j, m, w in rows if j != i))
        for negative, j, _ in [o for o in others if o[2] == label][:5]:
            p = -negative
            near = [(j2, -s) for s, j2, m in others if m != label and 30 * p <= -100 * s <= 90 * p][:k]
            out |= {(i, j, r + 1, j2, p, s) for r, (j2, s) in enumerate(near)}
    return out


def ints(v):
    return [int(np.floor(256 * x)) for x in v]


@pytest.mark.parametrize("shard_rows", [16384, 150])
def test_negatives_equal_brute_force(spark, shard_rows):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 24))
    rows = []
    for i in range(900):
        v = centres[i % 6] * (0.2 + i % 5) + rng.standard_normal(24)
        rows.append((int(i), int(i % 4), [float(x) for x in v[:24 if i % 11 else 20]]))     # some shorter
    rows += [(900, 1, [0.0] * 24), (901, 2, []), (1000, 2, rows[100][2]), (1001, 2, rows[100][2]), (1100, 9, [5.0] * 24)]
    odd = [(1200, None, [1.0]), (1300, 1, None), (1400, 1, [float("nan")] * 24), (1500, 1, [1.0, None]), (None, 1, [1.0]),
           (1600, 1, [float("inf")]), rows[3], rows[100]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id long, label int, embedding array<double>, id string, shard int")
    got = hard_negatives.mine(df, shard_rows=shard_rows).collect()
    want = brute_mine([(i, m, ints(v)) for i, m, v in rows])
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 100


def test_norm_bounds_lose_no_pair_and_leave_dimensions_out():
    rng = np.random.default_rng(6)
    x = np.floor(rng.standard_normal((500, 64)) * np.exp(-np.arange(64) / 6) * 400).astype(np.int64)
    q = np.floor(rng.standard_normal((40, 64)) * np.exp(-np.arange(64) / 6) * 400).astype(np.int64)
    shard = hard_negatives._Shard(np.arange(500), np.zeros(500), x, True)
    exact = q @ x.T
    for level in (0.2, 0.6, 0.95, -1.0):
        least = level * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).mean()
        query, row = shard.join(q.astype(float), least)
        assert {(a, b) for a, b in zip(*np.nonzero(exact >= least[:, None]))} <= set(zip(query.tolist(), row.tolist()))
    rows, ends = shard.inverted(300.0)
    assert 0 < len(rows) <= 500 and ends.max() < 64                          # short lists, omitted dimensions
    assert (shard.scores(q, query, row) == exact[query, row]).all()


def test_large_components_and_empty_tables(spark):
    big = [(0, 1, [2.0 ** 26, 1.0]), (1, 1, [2.0 ** 20, 3.0]), (2, 2, [2.0 ** 19, 5.0]), (3, 2, [1.0, 1.0])]
    df = spark.createDataFrame(big, "vec_id long, label int, embedding array<double>")
    assert {tuple(r) for r in hard_negatives.mine(df).collect()} == brute_mine([(i, m, ints(v)) for i, m, v in big]) != set()
    assert hard_negatives.mine(df.limit(0)).count() == 0
    assert hard_negatives.mine(df.where("vec_id > 0")).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        hard_negatives.mine(spark.createDataFrame([(0, 1, [2.0 ** 40]), (1, 1, [2.0 ** 40])], df.schema)).collect()
