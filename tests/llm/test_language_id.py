import zlib

import numpy as np

from tessera.llm import language_id as li


def test_labels_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = li.identify(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in {*lang.values(), li.UNKNOWN}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in held) <= 0.1 * len(held)


def test_odd_rows(odd, none):
    rows = li.identify(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    for i in (3, 4, 5):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == (li.UNKNOWN, 0.0, True)
    assert by_id[6].lang_pred in ("en", "fr", "de", "zz")
    assert li.identify(none).count() == 0
    assert li.fit(none) is None


def test_held_out_rows_and_labels_do_not_matter(sample):
    from pyspark.sql import functions as F

    plain = li.identify(sample).orderBy("doc_id").collect()
    changed = sample.withColumn("lang", F.when(li.held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert li.identify(changed).orderBy("doc_id").collect() == plain


def test_counts_by_brute_force():
    def plain(text):
        out = np.zeros(li.DIMS, np.int64)
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split(" ")
        joined = " " + " ".join(w for w in words if w) + " "
        for n in li.GRAMS:
            for i in range(len(joined) - n + 1):
                h = n * 0x27D4EB2F & 0xFFFFFFFF
                for k in range(n):
                    h = ((h ^ (ord(joined[i + k]) * li.MULTIPLIERS[k] & 0xFFFFFFFF)) * 0x165667B1) & 0xFFFFFFFF
                out[h >> (32 - li.DIM_BITS)] += 1
        return out

    for text in ("a", "Hello, World 12 ñandú", "x1y2z3", "  ...один два?"):
        assert (li.gram_counts(text) == plain(text)).all()
    assert li.gram_counts("12 ...") is None and li.gram_counts("") is None


def test_a_strange_text_is_rejected(spark, sample):
    model = li.fit(sample.select("doc_id", "text", "lang"))
    odd = spark.createDataFrame([(1, "qqq zzz xxx qzx " * 50)], "doc_id bigint, text string")
    assert li.predict(odd, model).first().rejected
