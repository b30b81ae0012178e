import math
import random
import re
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import quality
from tessera.llm.token_counts import vocabulary_path

# The library for the same vocabulary as the rank file.
BYTES = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text, sp):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            hit |= {i, i + 1, i + 2}
    chars = sum(map(len, words))
    base = (len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 500 else len(lines) - len(set(lines)), len(hit))
    ids = [i for w in words for i in sp.encode(w)]
    if not ids:
        return base, (None,) * 6
    share = [c / len(ids) for c in Counter(ids).values()]
    most = math.log2(min(len(ids), sp.get_piece_size()))
    entropy = -sum(p * math.log2(p) for p in share) / most if most else 0.0
    return base, (chars / len(ids), sum(sp.is_byte(i) for i in ids) / len(ids), entropy, *byte_measures(words, chars))


def byte_measures(words, chars):
    ids = [i for w in words for i in BYTES.encode(" " + w, add_special_tokens=False).ids]
    pieces = Counter(ids)
    whole = {i for i in pieces if "\ufffd" not in BYTES.decode([i])}
    share = [c / len(ids) for c in pieces.values()]
    most = math.log2(min(len(ids), 50256))
    entropy = -sum(p * math.log2(p) for p in share) / most if most else 0.0
    return chars / len(ids), sum(i not in whole for i in ids) / len(ids), entropy


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())


def check(docs, sp):
    got = sorted((tuple(r) for r in quality.measure(docs).collect()), key=lambda r: (str(r[0]), r[2:7]))
    want = sorted(((r.doc_id, *expected(r.text, sp)) for r in docs.collect()), key=lambda r: (str(r[0]), r[1]))
    for g, (i, base, rest) in zip(got, want, strict=True):
        assert g[0] == i and g[2:7] == base
        assert all(a == b or abs(a - b) < 1e-9 for a, b in zip(g[7:], rest, strict=True))


def test_measures_of_odd_rows(odd, none, sp):
    check(odd, sp)
    assert quality.judged(none).count() == 0 and quality.kept_documents(none).count() == 0


def test_measures_of_documents(sample, sp):
    check(sample, sp)


def test_repeated_words_with_many_distinct():
    import numpy as np

    codes = np.array([5, 1, 2, 9, 5, 1, 2, 7])
    assert quality.repeated_words(codes, 10) == quality.repeated_words(codes, 1 << 31) == 6


def quartile(values, q):
    """The cell of the first value that q of all do not exceed."""
    cells = sorted(math.floor(v / quality.CELL) for v in values)
    return cells[math.ceil(q * len(cells)) - 1]


def test_bands_and_verdicts(spark, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r.asDict() for r in quality.judged(docs).collect()]
    good = [r for r in rows if not r["base_failed"]]
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
    measured = {r.doc_id: r for r in quality.measure(docs).collect()}
    limits = {}
    sizes = Counter(measured[r["doc_id"]].band for r in good)
    for band, n in sizes.items():
        # Every band is judged by its own quartiles; few texts have a longer reach.
        wider = 1 + quality.WIDENING * (max(quality.MIN_BAND / n, 1) - 1)
        for m in quality.MEASURES:
            v = [r[m] for r in good if measured[r["doc_id"]].band == band]
            a, b = quartile(v, 0.25), quartile(v, 0.75)
            reach = max(b - a, 1) * quality.SPREAD * wider
            high = (b + 1 + reach) * quality.CELL
            if m.startswith("byte_share"):
                high = max(high, quality.BYTE_SHARE)
            limits[band, m] = ((a - reach) * quality.CELL, high)
    assert min(sizes.values()) < quality.MIN_BAND < max(sizes.values())
    for r in rows:
        band = measured[r["doc_id"]].band
        bad = [m for m in quality.MEASURES if r[m] is not None and (band, m) in limits and not limits[band, m][0] <= r[m] <= limits[band, m][1]]
        assert r["rejected_by"] == (bad[0] if bad else None)
        assert r["kept"] == (not r["base_failed"] and not bad)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    clean = [r["kept"] for r in good if labels.get(r["doc_id"]) == 1]
    assert sum(clean) >= 0.97 * len(clean)


def test_kept_documents(odd, sample):
    want = Counter(r.doc_id for r in quality.judged(sample).where("kept").collect())
    out = quality.kept_documents(sample)
    assert Counter(r.doc_id for r in out.collect()) == want and out.columns == sample.columns
    assert quality.kept_documents(odd).columns == odd.columns
    assert {r.doc_id for r in quality.kept_documents(odd).collect()} <= {6, 7}


def test_script_bands():
    assert quality.script_of("абв abc де") == "CYRILLIC" and quality.script_of("12 ?!") == "none"


def test_clean_texts_with_rare_characters_are_kept(spark, sample):
    # Shares of about 0.03 to 0.1.
    base = [r for r in sample.where("lang = 'en'").orderBy("doc_id").collect()]
    kept = {r.doc_id for r in quality.judged(sample).where("kept").collect()}
    text = next(r.text for r in base if r.doc_id in kept)
    clean = " ".join(WORD.findall(text)[:58])
    rows = [(i, f"{clean} {c}", "en") for i, c in enumerate(("", "鑫", "🦆", "🥨", "鑫 🦆"), 10_000_000)]
    docs = sample.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    got = {r.doc_id: r for r in quality.judged(docs).where("doc_id >= 10000000").collect()}
    assert all(r.kept and (r.byte_share > 0.01 or i == 10_000_000) for i, r in got.items()) and len(got) == 5


def test_few_texts_are_not_judged_by_other_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    # Three clean texts of a script with few pieces, in another order of words each.
    ws = ["λόγος", "άνθρωπος", "θάλασσα", "ουρανός", "ποτάμι", "δέντρο", "χώρα", "γραφή", "βιβλίο", "φως"]
    texts = [" ".join(ws[(i * i * k + i + i // 7) % 10] for i in range(80)) for k in (1, 2, 3)]
    greek = spark.createDataFrame([(10_000_000 + k, t, None) for k, t in enumerate(texts)], docs.schema)
    rows = quality.judged(docs.unionByName(greek)).where("doc_id >= 10000000").collect()
    assert len(rows) == 3 and all(r.band == "script:GREEK" and r.rejected_by is None for r in rows)
    assert all(r.chars_per_token < 1.06 for r in rows)


def test_every_measure_can_reject(spark):
    """Under either vocabulary, on a corpus whose other texts are alike."""
    rnd = random.Random(2)
    # Long words of letters that both vocabularies know, in even numbers.
    ws = [a + b + c for a in ("inter", "under", "trans") for b in ("nation", "stand", "port") for c in ("al", "ing", "ed", "s")]
    rows = [(i, " ".join(rnd.sample(ws, 36) + rnd.sample(ws, 36)), "en") for i in range(300)]
    odd = {
        "chars_per_token": " ".join(rnd.choice("bcdfgh") for _ in range(30) for _ in range(3)),
        "byte_share": " ".join(rnd.sample(ws, 36) + [chr(0x1F980 + i) * 3 for i in range(30)]),
        "entropy": " ".join(x for i in range(25) for x in (ws[0], ws[0], ws[i % 2 + 1], ws[0])[: 2 + i % 3]),
    }
    rows += [(1000 + i, t, "en") for i, t in enumerate(odd.values())]
    limits = {}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    measured = quality.measure(docs)
    for r in quality.bands(measured.where("doc_id < 1000")).collect():
        limits[r.measure] = (r.low, r.high)
    got = {r.doc_id: r for r in measured.where("doc_id >= 1000").collect()}
    for i, m in enumerate(odd):
        for name in (m, {"chars_per_token": "chars_per_byte_token"}.get(m, f"{m}_of_bytes")):
            low, high = limits[name]
            assert not low <= got[1000 + i][name] <= high, (name, low, high, got[1000 + i][name])
    # Of a band of few texts each is judged by their own quartiles, with a longer reach.
    few = {r.measure: r.high - r.low for r in quality.bands(measured.where("doc_id < 50")).collect()}
    assert all(few[m] > 10 * (high - low) / 2 for m, (low, high) in limits.items() if not m.startswith("byte_share"))
