import hashlib
import re
from collections import Counter, defaultdict

from tessera.llm import common, exact_dedup, line_dedup

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def test_exact_dedup_of_odd_rows(odd, none):
    got = [tuple(r) for r in exact_dedup.exact_dedup(odd).collect()]
    rows = [(r.doc_id, BLANK.sub(" ", r.text or "")) for r in odd.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want = []
    for i, t in rows:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert exact_dedup.exact_dedup(none).count() == 0


def test_filter_never_clears_a_repeat(spark):
    rows = spark.range(20_000).selectExpr("cast(id % 15000 as string) as sha", "xxhash64(id % 15000) as h", "id as doc_id")
    bits = exact_dedup.filter_bits(20_000)
    marked = exact_dedup.probe(rows, exact_dedup.repeat_filter(rows, bits), bits)
    assert marked.count() == 20_000
    assert marked.where("cast(sha as int) < 5000 and not maybe").count() == 0
    # Few unique rows are suspected.
    assert marked.where("cast(sha as int) >= 5000 and maybe").count() < 1000


def test_long_filters_give_the_same(spark, odd, sample, monkeypatch):
    rows = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 15000 as string)) as sha", "xxhash64(if(id % 3 = 0, -1, id % 15000)) as h", "id as doc_id"
    )
    bits = exact_dedup.filter_bits(20_000)
    repeats = exact_dedup.repeat_filter(rows, bits)
    whole, split = (sorted(map(tuple, exact_dedup.probe(rows, repeats, bits, n).collect())) for n in (10**6, 0))
    assert whole == split and len(whole) == 20_000 and {r[3] for r in whole} == {True, False}
    for docs in (odd, sample):
        want = sorted(map(str, exact_dedup.exact_dedup(docs).collect()))
        with monkeypatch.context() as m:
            m.setattr(exact_dedup.probe, "__defaults__", (0,))
            assert sorted(map(str, exact_dedup.exact_dedup(docs).collect())) == want
    assert exact_dedup.filter_bits(1 << 40) == 1 << 44


def test_attach_splits_hot_keys(spark):
    rows = spark.range(5000).selectExpr("if(id < 3000, 'hot', cast(id as string)) as k", "id")
    groups = rows.groupBy("k").count().withColumnRenamed("count", "group_size").where("group_size > 1")
    out = common.attach(rows, groups, "k", 5000)
    assert out.count() == 5000 and out.where("group_size = 3000").count() == 3000


def expected_lines(rows, limit):
    sites, first = defaultdict(set), {}
    strip = lambda x: x.strip(common.BLANKS)
    for r in rows:
        for x in (r.text or "").split("\n"):
            if strip(x):
                sites[strip(x)].add(r.source or "")
                if r.doc_id is not None:
                    first[strip(x)] = min(first.get(strip(x), r.doc_id), r.doc_id)
    out = []
    for r in rows:
        if r.text is None:
            out.append((r.doc_id, None, 0, 0))
            continue
        all_lines = r.text.split("\n")
        stay = [x for x in all_lines if not strip(x) or len(sites[strip(x)]) < limit or first.get(strip(x)) == r.doc_id]
        out.append((r.doc_id, "\n".join(stay), len(all_lines), len(all_lines) - len(stay)))
    return out


def test_boilerplate_of_odd_rows(odd, none):
    out = line_dedup.remove_boilerplate(odd, min_sites=2)
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()]
    assert Counter(got) == Counter(expected_lines(odd.collect(), 2))
    assert set(odd.columns) | {"n_removed"} == set(out.columns)
    assert line_dedup.remove_boilerplate(none).count() == 0


def test_boilerplate_of_documents(sample):
    for limit in (2, 5, line_dedup.MIN_SITES):
        out = line_dedup.remove_boilerplate(sample, min_sites=limit)
        got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()]
        assert Counter(got) == Counter(expected_lines(sample.collect(), limit))


def test_sketches_of_two_loads_merge(spark):
    docs = spark.createDataFrame([(i, "shared\nown %d" % i, "s%d" % (i % 40)) for i in range(200)], "doc_id bigint, text string, source string")
    found = line_dedup.lines(docs)
    parts = [line_dedup.line_sketches(line_dedup.lines(docs.where(f"doc_id % 2 = {k}"))) for k in (0, 1)]
    merged = line_dedup.merge_sketches(*parts)
    for limit in (39, 40, 41):
        common_lines = line_dedup.boilerplate(found, merged, limit).collect()
        assert len(common_lines) == (limit <= 40)
    assert line_dedup.boilerplate(found, merged, 40).first().first_doc == 0
