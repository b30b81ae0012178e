import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import spelling

LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def brute_counts(rows):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            i = h % len(run)
            counts[run[:i] + run[i + 1 :] if h % 199 == 0 else run] += 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_pairs(words):
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    return {(a, b) for a in words for n in (len(a) - 1, len(a), len(a) + 1) for b in by_length[n] if one_edit(a, b)}


def brute(rows, min_length=6, min_count=5, ratio=5):
    words = {w: n for w, n in brute_counts(rows).items() if len(w) >= min_length and n >= min_count}
    near = defaultdict(list)
    for a, b in brute_pairs(words):
        near[a].append(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x))
        if words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_texts(sample):
    got = rows_of(spelling.variants(sample))
    assert got == brute(sample.collect()) and any(r[1] for r in got)


def test_odd_rows(odd, none):
    docs = odd.selectExpr("*", "'w' as word", "'h' as head", "'r' as runs", "'v' as vector")
    assert rows_of(spelling.variants(docs, 2, 1, 1)) == brute(docs.collect(), 2, 1, 1)
    assert rows_of(spelling.variants(none)) == []


def test_forms_are_followed_to_the_last(spark):
    # Each form is five times as frequent as the one before; ties go to the first in order.
    times = {"letter": 5, "lettre": 5, "lette": 5, "letters": 25, "lettersa": 125, "lettersb": 125, "lettersbc": 625, "apart": 9, "éclair": 5, "eclair": 25}
    docs = spark.createDataFrame([(None, " ".join([w.upper() if w.isascii() else w] * n)) for w, n in times.items()], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling.variants(docs).collect()}
    assert rows_of(spelling.variants(docs)) == brute(docs.collect())
    assert got["letter"] == ("letters", "lettersa") and got["lettersb"] == ("lettersbc", "lettersbc")
    assert got["éclair"] == ("eclair", "eclair") and "apart" not in got


@pytest.mark.parametrize("letters, lengths", [("ab", (1, 9)), ("abcdeé", (4, 7)), ("aà×ÿz", (6, 8))])
def test_no_pair_is_missed(spark, letters, lengths):
    rnd = random.Random(len(letters))
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(*lengths))) for _ in range(400)}
    words |= {w[:i] + rnd.choice(letters) + w[i:] for w in list(words)[:100] for i in (0, len(w) // 2, len(w))}
    words |= {"aaaaaaaaaaaa" * 200, "aaaaaaaaaaaa" * 200 + "b"}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = {(r.a, r.b) for r in spelling.near_pairs(df).collect()}
    assert found | {(b, a) for a, b in found} == brute_pairs(sorted(words)) and len(found) * 2 == len(brute_pairs(sorted(words)))


def test_signatures_cover_all_letters(spark):
    words = spark.createDataFrame([("banana", 1), ("ñandú", 1)], "word string, n long")
    parts = spelling.letter_parts(words, 4)
    assert sorted("".join(parts)) == sorted(set("bananañandú")) and all(parts)
    vector = F.array_join(F.array_sort(F.split("word", "")), "")
    made = words.where("word = 'banana'").select(*spelling.signatures(vector, parts, 2)).first()
    assert len(made) == 6 and sum(map(len, made)) == 3 * len("banana")
