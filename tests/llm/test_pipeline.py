import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import line_dedup, packing, quality
from tessera.llm.token_counts import vocabulary_path
from test_exact_and_lines import expected_lines
from test_mixing import targets, words
from test_ngram_join import expected

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The tables between the stages, the documents first."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, f in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        f(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_quality(stages):
    verdicts = {r.doc_id for r in quality.judged(stages[0]).where("kept").collect()}
    assert {tuple(r) for r in stages[1].collect()} == {tuple(r) for r in stages[0].collect() if r.doc_id in verdicts}


def test_lines(stages):
    want = [(i, t) for i, t, _, gone in expected_lines(stages[1].collect(), line_dedup.MIN_SITES) if not gone or WORD.search(t)]
    rows = stages[2].collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_similar(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    want = sorted(i for i, _, c in expected(rows, 5, 80) if i == c)
    assert sorted(r.doc_id for r in stages[3].collect()) == want


def test_mix(stages):
    sizes = Counter()
    rows = {r.doc_id: r for r in stages[3].collect()}
    for r in rows.values():
        sizes[r.source] += words(r.text)
    want, got, times = targets(sizes), Counter(), Counter()
    for r in stages[4].collect():
        assert rows[r.doc_id].text.startswith(r.text)
        got[r.source] += words(r.text)
        times[r.doc_id] += 1
    assert all(abs(got[s] - want[s]) <= 1 for s in want) and max(times.values()) <= 3


def test_packing(stages):
    library = Tokenizer.from_file(vocabulary_path(packing.VOCABULARY))
    want = Counter()
    for r in stages[4].collect():
        want.update(library.encode(r.text, add_special_tokens=False).ids + [packing.END_ID])
    rows = sorted(stages[5].collect())
    got = Counter(i for r in rows for i in r.ids)
    assert got == want
    assert [r.sequence_id for r in rows] == list(range(len(rows)))
    assert all(r.n_tokens == packing.WINDOW for r in rows[:-1])
    # Every document but those at a sequence's edges lies whole and in order between two ends.
    stream = np.concatenate([r.ids for r in rows])
    assert (stream == packing.END_ID).sum() >= stages[4].count()


def test_run_equals_the_stages(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    want = stages[5].selectExpr("count(*) as n", "sum(n_tokens) as t").first()
    assert out.columns == stages[5].columns
    assert out.selectExpr("count(*) as n", "sum(n_tokens) as t").first() == want


def test_odd_rows_through_all_stages(spark, odd):
    """Own columns with the operators' names stay as they are, and no unlike text is lost."""
    docs = odd.withColumn("n_chars", F.length("text")).withColumn("n_removed", F.lit("own"))
    seen = [docs.cache()]
    for _, f in corpus_pipeline.STAGES[:-1]:
        seen.append(f(spark, seen[-1], SF).cache())
        assert seen[-1].columns == docs.columns
    lines = seen[0].where("doc_id = 10 or doc_id = 11")
    out = corpus_pipeline.drop_boilerplate(spark, lines, SF)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, lines.collect()))
    assert {r.n_lines for r in out.collect()} == {7} and {r.n_removed for r in out.collect()} == {"own"}
    empty = docs.where("1 = 0")
    for _, f in corpus_pipeline.STAGES:
        empty = f(spark, empty, SF)
        assert empty.count() == 0
