import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def up(level):
    """All levels over the nodes."""
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def way(levels, i):
    """(left siblings, right siblings) from level to level."""
    out = []
    for level in levels[:-1]:
        run = level[i - i % 8 : i - i % 8 + 8]
        out.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return out


def brute(rows):
    trees = defaultdict(list)
    for r in rows:
        tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        new = leaf_of(r, r.text.translate(LOWER) if r.text is not None else None) if tampered else None
        trees[r.lang].append(((r.doc_id is not None, r.doc_id or 0), leaf_of(r, r.text), new, r.doc_id))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda x: x[:2])
        built[lang] = up([x[1] for x in trees[lang]])
    top = up([built[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, (_, leaf, new, doc_id) in enumerate(trees[lang]):
            steps = way(built[lang], i) + way(top, k)
            folded, copies = new or leaf, []
            for left, right in steps:
                folded = H(*left, folded, *right)
                copies.append(folded)
            proof = H(*[x for left, right in steps for x in left + right])
            row = (doc_id, leaf, built[lang][-1][0], top[-1][0], proof, folded, folded == top[-1][0], copies if new else [])
            out.append(row)
    return out


def check(docs):
    got = [tuple(r) for r in merkle.manifest(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(docs.collect()), key=str)
    return got


def test_odd_rows(odd, none):
    docs = odd.withColumn("n_chars", F.length("text")).selectExpr("*", "'x' as tree", "1 as total", "2 as digest", "3 as at", "4 as new")
    check(docs)
    assert merkle.manifest(docs.where("1 = 0")).count() == 0


def test_given_rows(sample):
    got = check(sample.repartition(5))
    assert {r[6] for r in got} == {True, False}


def test_one_row(sample):
    (row,) = check(sample.limit(1))
    assert row[1] == row[2] == row[3] and row[4] == H()


@pytest.mark.parametrize("langs", ["if(id % 3 = 0, 'a', null)", "if(id < 8, 'b', if(id < 4105, 'c', 'd'))", "if(id % 2 = 0, 'hot', concat('l', id))"])
def test_many_blocks_and_trees(spark, langs):
    docs = spark.range(9000).selectExpr(
        "id * 7 % 9000 as doc_id", "'s' as source", f"{langs} as lang", "cast(null as int) as n_chars", "concat('Text ', id) as text"
    )
    check(docs)


def test_own_change(sample):
    rows = merkle.manifest(sample, lambda d: {"source": F.lit("x")}, lambda d: d["doc_id"] == d.agg(F.min("doc_id")).scalar())
    assert rows.where("not verified").count() == 1
    changed = rows.where("not verified").first()
    assert changed.copies[-1] == changed.folded_root != changed.root
    assert rows.where("verified and size(copies) = 0").count() == sample.count() - 1
