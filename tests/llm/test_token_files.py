import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import token_files as tf
from tessera.llm.common import work_path

PIECES = ["a", "The", "ing", " ", "  ", "\n", "\t", "é", "É", "İ", "ſ", "日本", "😀", "́", "é", "\x1c", "　", "\x85", "Σ", "ΑΣ", "<|endoftext|>",
          "<|startoftext|>", "'s", "'LL", "don't", ",", ".", "..", "1", "12", "#", "\r\n", "K", "x" * 50, "​", "\x0b"]
texts = st.lists(st.sampled_from(PIECES), max_size=30).map("".join)
# Runs of ids of every width, as selectors of all kinds need them.
runs = st.lists(st.tuples(st.sampled_from([0, 1, 2, 7, 15, 100, 254, 255, 1022, 4095, 32767, 49407, (1 << 20) - 1, (1 << 30) - 1, (1 << 32) - 1]), st.integers(1, 500)), max_size=20)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tf.vocabulary_path(tf.VOCABULARY))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [tf.END_ID]


@settings(max_examples=1500, deadline=None)
@given(texts)
def test_ids_equal_the_library(library, text):
    (raw,) = tf.encoder(tf.VOCABULARY).batch([text])
    assert np.frombuffer(raw, "<u2").tolist() == ids_of(library, text)


def test_batches_mix_kinds_of_texts(library):
    e = tf.encoder(tf.VOCABULARY)
    batch = ["it's A.B k Other#.", "", "<|endoftext|>x", "日本 word", " ", "don't''s 'LL “quoted” – €5", "<|start", "\x01\x00 a", "ÀÉŉſ×÷ĳ", "İ"]
    assert [np.frombuffer(x, "<u2").tolist() for x in e.batch(batch)] == [ids_of(library, t) for t in batch]
    assert e.batch([]) == [] and [e.plain(t) for t in batch] == [True, True, False, False, True, False, True, False, True, False]


def test_all_plain_characters(library):
    chars = [chr(x) for x in range(0x2100) if tf.LATIN.fullmatch(chr(x))]
    e = tf.encoder(tf.VOCABULARY)
    batch = [t for c in chars for t in (c, f"a{c}", f"{c}b", f"1{c}'s{c}{c} {c}")]
    assert [np.frombuffer(x, "<u2").tolist() for x in e.batch(batch)] == [ids_of(library, t) for t in batch] and all(map(e.plain, batch))


def test_every_piece_is_what_its_letters_merge_to():
    """So joining neighbours by the rank of what they make equals the listed merges."""
    with open(tf.vocabulary_path(tf.VOCABULARY), encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    order = {p: i for i, p in enumerate(pairs)}
    assert len({a + b for a, b in pairs}) == len(pairs)
    for piece in (a + b for a, b in pairs):
        body, last = (piece[:-4], True) if piece.endswith("</w>") else (piece, False)
        symbols = [*body[:-1], body[-1] + "</w>" * last]
        while len(symbols) > 1:
            rank, i = min((order.get(p, len(order)), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            assert rank < len(order), piece
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


@settings(max_examples=300, deadline=None)
@given(runs, st.randoms(use_true_random=False))
def test_round_trip(runs, rnd):
    ids = np.array([x for v, n in runs for x in [v] * n], "<u4")
    data = tf.encode(ids)
    assert tf.decode(data).tolist() == ids.tolist()
    first, last = sorted(rnd.randint(0, len(ids)) for _ in range(2))
    assert tf.decode(data, first, last).tolist() == ids[first:last].tolist()


def test_blocks_decode_alone():
    rnd = np.random.default_rng(3)
    ids = np.where(rnd.random(50_000) < 0.1, rnd.integers(0, 49408, 50_000), rnd.integers(0, 300, 50_000))
    data = tf.encode(ids)
    assert len(data) < 2 * len(ids)
    for first, last in ((0, 1), (4095, 4097), (8192, 12288), (20_001, 49_999), (49_999, 50_000), (7, 7), (0, 10**9)):
        assert tf.decode(data, first, last).tolist() == ids[first:last].tolist()
    with pytest.raises(ValueError, match="not a segment"):
        tf.decode(b"none" + data[4:])


def test_zeros_and_every_width():
    assert len(tf.encode(np.zeros(240, int))) == 20 + 8 + 8
    for w in range(33):
        ids = np.full(1000, max(0, (1 << w) - 1))
        assert tf.decode(tf.encode(ids)).tolist() == ids.tolist()


def check(spark, docs, library):
    path = work_path(spark, "files")
    tf.write_files(docs, path)
    got = sorted((tuple(r) for r in tf.read_files(spark, path).collect()), key=lambda r: r[1])
    want = [(r.doc_id, np.array(ids_of(library, r.text), "<u4").tobytes()) for r in docs.collect()]
    assert sorted(((r[0], bytes(r[3])) for r in got), key=str) == sorted(want, key=str)
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda x: (x is not None, x or 0))
    ends = np.cumsum([r[2] for r in got])
    assert [r[1] for r in got] == [0, *ends.tolist()][:-1] and all(4 * r[2] == len(r[3]) for r in got)
    return path, np.frombuffer(b"".join(bytes(r[3]) for r in got), "<u4")


def test_files(spark, odd, none, sample, library):
    check(spark, odd.selectExpr("*", "'p' as part", "'i' as ids", "'w' as width", "'t' as t"), library)
    path, stream = check(spark, sample.repartition(7), library)
    for first, last in ((0, 10), (5000, 70_000), (len(stream) - 3, len(stream) + 5), (0, len(stream))):
        rows = sorted(tf.read_ids(spark, path, first, last).collect())
        assert np.frombuffer(b"".join(bytes(r.ids) for r in rows), "<u4").tolist() == stream[first:last].tolist()
        assert rows[0].start == first
    path = work_path(spark, "files")
    tf.write_files(none, path)
    assert tf.read_files(spark, path).count() == 0


def test_segments_and_hot_ids(spark, library):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) as doc_id", "repeat(concat('w', id % 50, ' '), cast(id % 400 as int)) as text")
    path, _ = check(spark, docs, library)
    sizes = [r.n for r in spark.read.parquet(path).selectExpr("size(doc_ids) as n").collect()]
    assert len(sizes) > 2 and sum(sizes) == 3000
    parts = spark.read.parquet(path).groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n"))
    assert parts.agg(F.max("n")).first()[0] < 1500


def test_query(spark, library):
    from tessera.llm.queries import REGISTRY

    rows = REGISTRY["op12_token_files"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for r, d in zip(sorted(rows), docs, strict=True):
        ids = ids_of(library, d.text)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
