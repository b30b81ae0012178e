import zlib
from collections import Counter, defaultdict

from tessera.llm import sharding


def check(docs, n, out):
    rows = [r.asDict() for r in out.collect()]
    source = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(source)
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(n)]
    assert max(counts) - min(counts) <= 1
    return rows


def cut_links(rows):
    """Links between copies and the first of their group that cross shards, at best placement."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[r["text_crc32"]][r["shard"]] += 1
    return sum(sum(c.values()) - max(c.values()) for c in groups.values()), sum(sum(c.values()) - 1 for c in groups.values())


def test_odd_rows(odd, none):
    check(odd, 3, sharding.balanced_shards(odd, 3))
    assert sharding.balanced_shards(none).count() == 0


def test_documents_keep_copies_together(sample):
    rows = check(sample, 8, sharding.balanced_shards(sample, 8))
    cut, links = cut_links(rows)
    assert links and cut == 0


def test_a_group_larger_than_a_shard(spark):
    docs = spark.range(1200).selectExpr("id as doc_id", "if(id % 3 = 0, 'copy', if(id % 3 = 1, concat('pair ', id div 6), concat('own ', id))) as text")
    rows = check(docs, 10, sharding.balanced_shards(docs, 10, rounds=8))
    big = Counter(r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"copy"))
    # 400 copies need at least four shards of 120 rows.
    assert len(big) <= 6
    cut, links = cut_links([r for r in rows if r["text_crc32"] != zlib.crc32(b"copy")])
    assert cut <= 0.1 * links


def test_reruns_agree(sample):
    one, two = (sorted(map(tuple, sharding.balanced_shards(sample, 8).collect())) for _ in range(2))
    assert one == two


def test_hot_groups_fill_few_shards_and_small_groups_meet(spark):
    """10,000 rows on 20 shards of 500: 1,500 copies of one text fit three shards, 700 of another two; the rest are
    groups of 4 and rows of their own."""
    text = "case when id < 1500 then 'hot' when id < 2200 then 'warm' when id < 6200 then concat('small ', id div 4) else concat('own ', id) end"
    docs = spark.range(10_000).selectExpr("id as doc_id", f"{text} as text")
    rows = check(docs, 20, sharding.balanced_shards(docs, 20))
    groups = defaultdict(Counter)
    for r in rows:
        groups[r["text_crc32"]][r["shard"]] += 1
    hot, warm = groups.pop(zlib.crc32(b"hot")), groups.pop(zlib.crc32(b"warm"))
    split = sum(len(c) > 1 for c in groups.values())
    assert len(hot) <= 5 and len(warm) <= 3 and split <= 3
