import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from tessera.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return len(WORD.findall(t or ""))


def targets(sizes):
    """Shares by weight; what is above a source's limit is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, out = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            out[s] = Fraction(3 * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def check(docs, sample_error=1):
    rows = docs.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    want = targets(sizes)
    m = mixing.mix(docs)
    got = mixing.taken(m).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, words(r.text)) for r in rows)
    source = defaultdict(set)
    for r in rows:
        source[r.doc_id].add(r.source)
    taken, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        s = next(x for x in source[r.doc_id] if sizes[x] == r.source_size)
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        taken[s] += r.taken
        target[s] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= sample_error
    return m, got


def test_odd_rows(odd, none):
    check(odd)
    assert mixing.taken(mixing.mix(none)).count() == 0
    assert mixing.mixed_documents(none).count() == 0


def test_documents(sample):
    _, got = check(sample)
    assert sorted(got) == sorted(mixing.taken(mixing.mix(sample.repartition(3))).collect())


def test_limits_are_shared_again(spark):
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 1), ("b", 50), ("c", 900), (None, 3), ("", 7), ("d", 0)])]
    check(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))


def test_schedule_is_even_at_every_length(sample):
    m = mixing.mix(sample)
    slots = sorted((r.slot, r["rank"], r.block) for r in m.schedule.collect())
    quota = {r["rank"]: -(-r.take // m.block) for r in m.sources.collect()}
    seen = Counter()
    for i, (_, s, block) in enumerate(slots, 1):
        assert block == seen[s]
        seen[s] += 1
        if i % 997 == 0:
            for s2, q in quota.items():
                assert abs(seen[s2] - i * q / len(slots)) <= 12
    assert seen == Counter(quota)


def test_pieces_cover_each_stream(sample):
    m = mixing.mix(sample)
    source = {r["rank"]: r for r in m.sources.collect()}
    spans = defaultdict(list)
    for r in mixing.pieces(m).collect():
        at = r.repeat * source[r["rank"]].source_size + r.start
        spans[r["rank"]].append((at + r.from_word, at + r.to_word))
    for s, parts in spans.items():
        end = 0
        for a, b in sorted(parts):
            assert a == end and b > a
            end = b
        assert end == source[s].take


@pytest.mark.parametrize("many", [False, True])
def test_mixed_documents(sample, odd, many):
    docs = odd if many else sample
    m = mixing.mix(docs)
    want = Counter()
    for r in mixing.pieces(m).collect():
        want[r.doc_id] += r.to_word - r.from_word
    out = mixing.mixed_documents(docs)
    got = Counter()
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(r.text)
    for r in out.collect():
        assert any((t or "").startswith(r.text) for t in texts[r.doc_id]) and words(r.text)
        got[r.doc_id] += words(r.text)
    assert got == want and out.columns == docs.columns


def test_texts_are_shuffled_for_the_join_and_the_order_only(spark, sample, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mixing.mixed_documents(sample).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    # The branch of the texts comes before that of the runs.
    branch = plan[: plan.index("FileScan")]
    assert "Join [k#" in branch and branch.count("Exchange") == 2 + branch.count("BroadcastExchange")


def test_order_of_a_stream_is_a_hash(sample):
    m = mixing.mix(sample)
    rows = sorted((r["rank"], r.start, r.size, r.doc_id) for r in m.docs.where("size > 0").collect())
    key = lambda i: hashlib.md5(f"{i}\x01{mixing.SEED}".encode()).hexdigest()
    for a, b in zip(rows, rows[1:]):
        assert a[0] != b[0] or (key(a[3]) <= key(b[3]) and a[1] + a[2] == b[1])
