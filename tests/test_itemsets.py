import random
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tessera.operators import itemsets as it
from tessera.operators import pairs as pr

HAND = {1: "abc", 2: "ab", 3: "ac", 4: "bc", 5: "abc"}


def _frame(spark, sets):
    return spark.createDataFrame(
        [(b, i) for b, s in sets.items() for i in s], "basket_id long, item string"
    )


def _brute(sets, support):
    items = sorted({i for s in sets.values() for i in s})
    out = {}
    for size in range(1, len(items) + 1):
        found = {}
        for c in combinations(items, size):
            n = sum(set(c) <= set(s) for s in sets.values())
            if n >= support:
                found[c] = n
        if not found:
            break
        out |= found
    return out


def _got(df):
    return {tuple(r["items"]): r.support for r in df.collect()}


def _random(seed, n=60, items=9):
    rnd = random.Random(seed)
    weights = [0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.3, 0.2, 0.2][:items]
    sets = {b: {c for c, w in zip("abcdefghi", weights) if rnd.random() < w} for b in range(n)}
    return {b: s for b, s in sets.items() if s}


def test_hand_fixture(spark):
    rows = _frame(spark, HAND)
    assert _got(it.frequent_itemsets(rows, 3)) == {
        ("a",): 4,
        ("b",): 4,
        ("c",): 4,
        ("a", "b"): 3,
        ("a", "c"): 3,
        ("b", "c"): 3,
    }
    assert it.frequent_itemsets(rows, 6).count() == 0
    assert _got(it.frequent_itemsets(rows, 2, max_len=1)).keys() == {("a",), ("b",), ("c",)}
    assert len(_got(it.frequent_itemsets(rows, 2, max_len=2))) == 6


def test_min_size_is_strict_and_duplicates_collapse(spark):
    df = _frame(spark, HAND)
    rows = it.baskets(df.unionAll(df), "basket_id", "item", 2)
    assert {r.basket_id for r in rows.collect()} == {1, 5}
    assert rows.count() == 6


@pytest.mark.parametrize("seed,support", [(1, 8), (2, 15)])
def test_equals_brute_force(spark, seed, support):
    sets = _random(seed)
    rows = _frame(spark, sets)
    want = _brute(sets, support)
    assert _got(it.frequent_itemsets(rows, support)) == want
    for chunks in (1, 3):
        assert _got(it.son_itemsets(rows, support, chunks)) == want
        cand = {tuple(r["items"]) for r in it.son_candidates(rows, support, chunks).collect()}
        assert cand >= set(want)


def test_hot_basket(spark, monkeypatch):
    """One basket with every item is treated as a hot key and changes nothing."""
    sets = _random(3) | {1000: set("abcdefghi")}
    monkeypatch.setattr(it, "probe_skew", lambda df, key: pr.probe_skew(df, key, 4, 8))
    assert _got(it.frequent_itemsets(_frame(spark, sets), 9)) == _brute(sets, 9)


def test_equals_fp_growth(spark):
    sets = _random(4)
    rows = _frame(spark, sets)
    support, n = 12, len(sets)
    model = FPGrowth(itemsCol="items", minSupport=(support - 0.5) / n).fit(
        rows.groupBy("basket_id").agg(F.collect_set("item").alias("items"))
    )
    want = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect()}
    assert _got(it.frequent_itemsets(rows, support)) == want


def test_counted_sets_move_as_numbers(spark):
    """Rows of baskets carry numbers of sets and items, not the items of a set, and each set meets its baskets once."""
    rows = spark.createDataFrame([(b, f"i{k}") for b in range(40) for k in range(6) if (b + k) % 3 or b % 5 == 0], "basket_id int, item string")
    sets = spark.createDataFrame([(["i0"],), (["i0", "i1"],), (["i1", "i2", "i4"],), (["i1", "x"],), (["i0", "i1"],)], "items array<string>")
    out = it.count_itemsets(rows, sets)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "basket_id" in x and "items" in x], plan
    held = {}
    for r in rows.collect():
        held.setdefault(r.basket_id, set()).add(r.item)
    want = [["i0"], ["i0", "i1"], ["i1", "i2", "i4"]]
    assert sorted((r["items"], r.support) for r in out.collect()) == [(w, sum(set(w) <= h for h in held.values())) for w in want]
    assert it.count_itemsets(rows, sets.where("size(items) > 5")).collect() == []
