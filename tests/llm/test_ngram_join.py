import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from tessera.llm import ngram_join as nj

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def expected(rows, n, percent):
    sets = []
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else top(i)) for (i, _), s in zip(rows, sets)), key=str)


def check(df, n=3, percent=90):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted((tuple(r) for r in nj.similar_components(df, n, percent).collect()), key=str)
    assert got == expected(rows, n, percent)
    return got


def test_odd_rows(odd, none):
    check(odd)
    assert nj.similar_components(none).count() == 0
    assert nj.one_of_each(none).count() == 0


def test_documents(sample):
    check(sample)
    check(sample, 5, 80)


def test_near_copies_around_the_threshold(spark):
    rnd = random.Random(3)
    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(rnd.choice([4, 9, 12, 25, 60, 200]))]
        for _ in range(14):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                k = rnd.randrange(len(w))
                w[k : k + rnd.randint(0, 1)] = [f"x{rnd.random()}"] * rnd.randint(0, 2)
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = check(df)
    assert len({c for _, _, c in got}) < len(rows)
    check(df, 5, 80)


def test_large_group_in_blocks(spark, monkeypatch):
    """Chains of documents in one group, compared in blocks."""
    monkeypatch.setattr(nj, "BLOCK", 4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        w = list(base)
        w[3 * i % 120] = f"y{i}"
        w[(3 * i + 50) % 120] = f"z{i}"
        rows.append((1000 - i, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


@settings(max_examples=60, deadline=None)
@given(st.integers(9, 400), st.integers(0, 40), st.randoms())
def test_similar_sets_share_a_tile(size, changes, rnd):
    a = np.array(sorted(rnd.sample(range(1 << 62), size)), np.uint64)
    drop = rnd.sample(range(size), min(size - 1, rnd.randint(0, changes)))
    more = np.array([rnd.randrange(1 << 62) for _ in range(rnd.randint(0, changes))], np.uint64)
    b = np.unique(np.concatenate([np.delete(a, drop), more]))
    both = len(np.intersect1d(a, b))
    for percent in (90, 80):
        similar = 100 * both >= percent * (len(a) + len(b) - both)
        if similar and not np.array_equal(a, b):
            tops = nj.band_tops(1 << 10, percent)
            assert np.intersect1d(nj.tile_keys(a, tops, percent), nj.tile_keys(b, tops, percent)).size
    far = sum(int(x).bit_count() for x in (nj.bitmap(a) ^ nj.bitmap(b)).view(np.uint64))
    assert far <= len(a) + len(b) - 2 * both
    assert nj.differing_bits(nj.parity_map(a), nj.parity_map(b)) <= len(a) + len(b) - 2 * both


def test_maps_tell_unlike_sets_apart():
    rng = np.random.default_rng(1)
    for size in (100, 1000, 5000, 20_000):
        a, b = (np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64)) for _ in range(2))
        # More bits differ than sets that are similar to 0.8 may have elements apart.
        assert nj.differing_bits(nj.parity_map(a), nj.parity_map(b)) > nj.differing(2 * size, 80) * 1.5
        longer = np.unique(np.concatenate([a, b[: size // 8]]))
        assert nj.differing_bits(nj.parity_map(longer), nj.parity_map(a)) <= size // 8


def test_one_of_each(sample, odd):
    found = nj.similar_components(sample, 5, 80).collect()
    want = sorted(r.doc_id for r in found if r.doc_id == r.component_id)
    out = nj.one_of_each(sample)
    assert sorted(r.doc_id for r in out.collect()) == want and out.columns == sample.columns
    left = nj.one_of_each(odd)
    assert left.columns == odd.columns
    # Both texts of the repeated id stay; of the repeated row one does.
    ids = [r.doc_id for r in left.collect()]
    assert sorted(ids, key=str) == sorted([1, 3, 4, 5, 6, None, 8, 10, 11, 11], key=str)


def test_rows_of_one_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a, "y"), (1, b, "x"), (1, a, "x"), (2, a + " more", "z"), (3, "", "q"), (3, "", "q"), (None, a, "n"), (4, None, "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(4)
    got = sorted((tuple(r) for r in nj.one_of_each(df).collect()), key=str)
    first = min([(1, a), (2, a + " more")])
    assert got == sorted([(*first, "x"), (1, b, "x"), (3, "", "q"), (3, "", "q"), (None, a, "n"), (4, None, "m")], key=str)


def test_empty_and_single_parts_are_no_meeting_place():
    """Unlike sets that hold the same very common elements, one in a part or none, don't meet there, and
    sets that are as different as they may be still meet."""
    rng = np.random.default_rng(3)
    tops, common = nj.band_tops(1 << 10, 80), rng.integers(0, 1 << 62, 30).astype(np.uint64)
    made = lambda n: np.unique(np.concatenate([common, rng.integers(0, 1 << 62, n - len(common)).astype(np.uint64)]))
    keys = np.concatenate([nj.tile_keys(made(300), tops, 80) for _ in range(200)])
    _, members = np.unique(keys, return_counts=True)
    # Of 200 * 199 / 2 = 19,900 pairs; with a tile for every part there were 5441 meetings.
    assert (members * (members - 1) // 2).sum() < 3000
    for n in range(9, 120):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for gone in range(1, n // 5 + 1):
            b = a[gone:] if n % 2 else np.concatenate([a[gone // 2 :], np.arange(gone // 2, dtype=np.uint64)])
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert np.intersect1d(nj.tile_keys(a, tops, 80), nj.tile_keys(np.unique(b), tops, 80)).size
