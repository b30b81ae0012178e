import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tessera.operators import pairs as pr

SHAPES = [
    pr.Skew(),
    pr.Skew(large=True, block_rows=3),
    pr.Skew(hot=["k0"], large=True, block_rows=4),
    pr.Skew(hot=["k0", "k1", "k2"], large=False),
]


def _members(seed, ids=40, keys=12):
    """k0 is held by almost everyone, k1 and k2 by half."""
    rnd = random.Random(seed)
    out = {}
    for i in range(ids):
        held = {f"k{j}" for j in range(3, keys) if rnd.random() < 0.15}
        held |= {k for k, p in (("k0", 0.9), ("k1", 0.5), ("k2", 0.5)) if rnd.random() < p}
        if held:
            out[i] = held
    return out


def _frame(spark, sets):
    rows = [(i, k, float((i * 7 + len(k) + int(k[1:])) % 5 + 1)) for i, s in sets.items() for k in s]
    return spark.createDataFrame(rows, "id long, k string, v double"), {
        (i, k): v for i, k, v in rows
    }


@pytest.mark.parametrize("skew", SHAPES)
@pytest.mark.parametrize("need", [1, 2, 3])
def test_pair_sums_equal_brute_force(spark, skew, need):
    sets = _members(need)
    df, val = _frame(spark, sets)
    got = {
        (r.a, r.b): (r.n, r.sx, r.sy, r.sxy, r.sxx, r.syy)
        for r in pr.pair_sums(df, "id", "k", need, "v", skew).where(f"n >= {need}").collect()
    }
    want = {}
    for a, b in combinations(sorted(sets), 2):
        both = sets[a] & sets[b]
        if len(both) >= need:
            xy = [(val[a, k], val[b, k]) for k in both]
            want[a, b] = (
                len(both),
                sum(x for x, _ in xy),
                sum(y for _, y in xy),
                sum(x * y for x, y in xy),
                sum(x * x for x, _ in xy),
                sum(y * y for _, y in xy),
            )
    assert got == want


@pytest.mark.parametrize("skew", SHAPES)
@pytest.mark.parametrize("threshold", [0.2, 0.5, 1.0])
def test_jaccard_equals_brute_force(spark, skew, threshold):
    sets = _members(7)
    df, _ = _frame(spark, sets)
    got = {
        (r.b1, r.b2): r.sim for r in pr.jaccard_pairs(df, "id", "k", threshold, skew).collect()
    }
    want = {}
    for a, b in combinations(sorted(sets), 2):
        sim = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if sim >= threshold:
            want[a, b] = sim
    assert got == pytest.approx(want)


def test_probe_finds_hot_and_large_keys(spark):
    rows = [(i, "hot") for i in range(50)] + [(i, f"k{i % 25}") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, k string")
    skew = pr.probe_skew(df, "k", block_rows=10, hot_degree=20)
    assert skew.hot == ["hot"] and skew.large
    assert pr.probe_skew(df, "k") == pr.Skew()


def test_hot_key_alone_makes_no_pairs(spark):
    """A key that everyone holds yields no candidates when a pair needs a second key."""
    df = spark.createDataFrame([(i, "hot") for i in range(200)], "id long, k string")
    got = pr.pair_sums(df, "id", "k", 2, skew=pr.Skew(hot=["hot"], large=True))
    assert got.count() == 0


def test_missing_keys_join_nothing(spark):
    rows = [(i, None) for i in range(30)] + [(1, "k"), (2, "k")]
    df = spark.createDataFrame(rows, "id long, k string")
    assert pr.probe_skew(df, "k", block_rows=10, hot_degree=20) == pr.Skew(block_rows=10)
    assert [tuple(r) for r in pr.shared_counts(df, "id", "k", 1).collect()] == [(1, 2, 1)]


def test_pairs_are_counted_where_their_lists_meet(spark):
    """Pairs are not dealt out one by one, with values and without."""
    df = spark.createDataFrame([(i, f"k{(i * j) % 97}", 1.0) for i in range(60) for j in range(1, 4)], "id long, k string, v double").dropDuplicates(["id", "k"])
    for value in (None, "v"):
        plan = pr.pair_sums(df, "id", "k", 1, value)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(a#" in plan and not re.search(r"hashpartitioning\(a#\d+L?, b#", plan)


def test_sums_of_few_pairs_are_looked_up(spark):
    """Many pairs share one key and few share three: sums are those of all shared keys."""
    rows = [(i, f"k{(i * 7 + j * j) % 50}", float(i % 5 + j)) for i in range(80) for j in range(4)]
    rows += [(i, f"own{i // 2}-{j}", float((i + j) % 4)) for i in range(0, 20) for j in range(3)]
    val = {(i, k): v for i, k, v in rows}
    df = spark.createDataFrame([(i, k, v) for (i, k), v in val.items()], "id long, k string, v double")
    sets = {i: {k for j, k in val if j == i} for i in range(80)}
    want = {}
    for a, b in combinations(range(80), 2):
        both = sets[a] & sets[b]
        if len(both) >= 3:
            want[a, b] = (len(both), sum(val[a, k] for k in both), sum(val[a, k] * val[b, k] for k in both))
    got = {(r.a, r.b): (r.n, r.sx, r.sxy) for r in pr.pair_sums(df, "id", "k", 3, "v").where("n >= 3").collect()}
    assert want and got == want


def test_pairs_below_the_need_leave_before_sizes_are_joined(spark):
    """Two sets of ten that share one key cannot reach a third; they are not passed on."""
    rows = [(i, f"own{i}-{j}") for i in range(12) for j in range(9)] + [(i, "shared") for i in range(12)]
    rows += [(20 + i, f"alike{j}") for i in range(2) for j in range(10)]
    df = spark.createDataFrame(rows, "id long, k string")
    assert pr.pair_sums(df, "id", "k", F.lit(4)).count() == 1
    assert [tuple(r) for r in pr.jaccard_pairs(df, "id", "k", 1 / 3).collect()] == [(20, 21, 1.0)]


@pytest.mark.parametrize("block", [2048, 7])
def test_pairs_of_few_keys_are_counted_by_bits(spark, monkeypatch, block):
    """Keys that most ids share: no row is made for a pair and key, and any need is met."""
    monkeypatch.setattr(pr, "BIT_IDS", block)
    monkeypatch.setattr(pr, "_totals", None)
    rnd = random.Random(8)
    sets = {f"u{i}": {k for k in range(130) if rnd.random() < 0.4} for i in range(60)}
    df = spark.createDataFrame([(i, k) for i, ks in sets.items() for k in ks], "id string, k int")
    want = {(a, b): len(sets[a] & sets[b]) for a, b in combinations(sorted(sets), 2)}
    for need in (1, 22):
        got = {(r.a, r.b): r.n for r in pr.shared_counts(df, "id", "k", need).collect()}
        assert got == {p: n for p, n in want.items() if n >= need}


def test_tasks_follow_rows(spark, monkeypatch):
    """However few bytes they read: lists are dealt out by the pairs they stand for, plain rows by their number."""
    rows = [(i, k) for k in range(40) for i in range(k, k + 12)]
    members = spark.createDataFrame([(*r, 1) for r in rows], "_id long, _key long, _need int")
    monkeypatch.setattr(pr, "LIST_PAIRS", 100)
    lists = pr._lists(members, [], pr.probe_skew(members, "_key"))
    assert lists.rdd.getNumPartitions() == 40 * 66 // 100 + 1
    monkeypatch.setattr(pr, "TASK_ROWS", 20)
    parts = []
    monkeypatch.setattr(pr, "checkpointed", lambda df: parts.append(df.rdd.getNumPartitions()) or df.localCheckpoint())
    twice = spark.createDataFrame(rows + rows, "id long, key long")
    got = pr.shared_counts(twice, "id", "key", 3, rows=len(rows) * 2).collect()
    assert parts[0] == 2 * len(rows) // 20 + 1
    assert {tuple(r) for r in got} == {tuple(r) for r in pr.shared_counts(twice, "id", "key", 3).collect()}
