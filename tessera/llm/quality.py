"""Quality rules: tokeniser fertility with rejection bands per language or script."""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANKS, bounded, dealt, split_words, stored, wrapped
from .token_counts import vocabulary_path

# Symbols that are counted and the base limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# The public vocabularies that texts are measured under: pieces of characters, and of bytes.
VOCABULARY, BYTE_VOCABULARY = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
# A measure is rejected beyond so many quartile distances from the middle half of its band's texts.
SPREAD = 4.0
# Quartiles are read off cells of this width; a distance counts as one cell at least.
CELL = 0.002
# The upper limit of a share of bytes is this at least, in every language and script: a clean text may quote
# some names or emoji without pieces. Where a script has few pieces, its quartiles set a higher one.
BYTE_SHARE = 0.3
# Quartiles of fewer measured texts than MIN_BAND are uncertain: the reach is 1 + WIDENING * (MIN_BAND / n - 1)
# times as long, so it grows from one and few texts are as good as kept.
MIN_BAND, WIDENING = 100, 25
# The first three under the pieces of characters, the others under those of bytes.
MEASURES = ("chars_per_token", "byte_share", "entropy", "chars_per_byte_token", "byte_share_of_bytes", "entropy_of_bytes")
BATCH_ROWS = 1000

_vocabularies: dict = {}


def vocabulary(name: str) -> tuple[Callable[[list[str]], list[list[int]]], np.ndarray]:
    """How words are encoded, each on its own, and which pieces stand for a part of a character only;
    loaded once per worker process."""
    if name not in _vocabularies:
        _vocabularies[name] = rank_file(name) if name.endswith(".tiktoken") else piece_model(name)
    return _vocabularies[name]


def piece_model(name: str) -> tuple:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))
    is_byte = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
    return lambda words: sp.encode(words, num_threads=1), is_byte


def rank_file(name: str) -> tuple:
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    part = np.zeros(max(ranks.values()) + 1, bool)
    part[[i for raw, i in ranks.items() if "\ufffd" in raw.decode("utf-8", "replace")]] = True
    # As inside a text, a word comes with the space before it.
    return lambda words: [bpe.encode_ordinary(" " + w) for w in words], part


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words in windows of three that are found twice or more in the text, the first included."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1].astype(np.int64) * distinct + codes[1:]
    if distinct > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, which, counts = np.unique(pairs[:-1] * distinct + codes[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def script_of(text: str) -> str:
    """The script most of the first letters of distinct words belong to, by their Unicode names."""
    names: dict[str, int] = {}
    for c in sorted(set(text)):
        if c.isalpha():
            s = unicodedata.name(c, "OTHER").split(" ")[0]
            names[s] = names.get(s, 0) + text.count(c)
    return max(sorted(names), key=names.get) if names else "none"


def measure(docs: DataFrame, vocab: str = VOCABULARY, byte_vocab: str = BYTE_VOCABULARY, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and fertility of every whole text, one row per row of `docs`: doc_id, band,
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and three measures under either
    vocabulary.

    Each word is encoded on its own. chars_per_token: characters of words per token; byte_share:
    tokens that stand for a part of a character; entropy: of the text's token distribution, divided by
    what as many different tokens would have. All are null without words. The band is the
    language, or the script where no language is given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [vocabulary(vocab), vocabulary(byte_vocab)]
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                yield one(batch.slice(k, BATCH_ROWS), both)

    def one(b: pa.RecordBatch, both: list) -> pa.RecordBatch:
        texts = [t or "" for t in b.column(1).to_pylist()]
        words = [split_words(t) for t in texts]
        known: dict[str, int] = {}
        for ws in words:
            for w in ws:
                if w not in known:
                    known[w] = len(known)
        coded = []
        for encode, is_byte in both:
            ids = encode(list(known)) if known else []
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
            coded.append((lengths, np.cumsum(lengths) - lengths, flat, is_byte))
        out: list[list] = [[] for _ in range(6 + len(MEASURES))]
        for text, ws, lang in zip(texts, words, b.column(2).to_pylist()):
            codes = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
            chars = sum(map(len, ws))
            lines = [x for x in text.split("\n") if x.strip(BLANKS)]
            row = [
                lang if lang is not None else "script:" + script_of(text),
                len(ws),
                chars,
                sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)),
                repeated_words(codes, len(known)),
                *chain.from_iterable(fertility(codes, chars, *c) for c in coded),
            ]
            for to, v in zip(out, row):
                to.append(v)
        kinds = [pa.string(), *[pa.int64()] * 5, *[pa.float64()] * len(MEASURES)]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, t) for x, t in zip(out, kinds))], NAMES)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col), F.col(lang_col).cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} bigint" for c in NAMES[2:7])
    doubles = ", ".join(f"{c} double" for c in MEASURES)
    return dealt(rows).mapInArrow(run, f"doc_id {kind}, band string, {longs}, {doubles}")


NAMES = ["doc_id", "band", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *MEASURES]


def fertility(codes, chars, lengths, begins, flat, is_byte) -> tuple:
    """chars per token, byte share, entropy of the words' tokens."""
    if not len(codes):
        return None, None, None
    used, times = np.unique(codes, return_counts=True)
    size = lengths[used]
    total = int((size * times).sum())
    place = np.repeat(begins[used] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    tokens, weight = flat[place], np.repeat(times, size)
    counts = np.bincount(tokens, weights=weight)
    share = counts[counts > 0] / total
    bits = float(-(share * np.log2(share)).sum())
    most = np.log2(min(total, len(is_byte)))
    return chars / total, float(weight[is_byte[tokens]].sum()) / total, bits / most if most else 0.0


def bands(measured: DataFrame, spread: float = SPREAD) -> DataFrame:
    """(band, measure, low, high) from the texts that pass the base rules: `spread` quartile
    distances beyond the quartiles, more in a band with few texts. Counts per cell are summed over
    all texts, so the quartiles are the same however the rows are dealt out, and a band is never
    gathered."""
    cell = lambda c: F.floor(F.col(c) / CELL)
    long = measured.where(~base_failed()).select(
        "band", F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), cell(c).alias("cell")) for c in MEASURES])).alias("m")
    )
    cells = long.groupBy("band", "m.measure", "m.cell").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("band", "measure").orderBy("cell")
    whole = Window.partitionBy("band", "measure")
    ranked = cells.withColumns({"upto": F.sum("n").over(up), "all": F.sum("n").over(whole)})
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("cell")))
    q = ranked.groupBy("band", "measure").agg(at(0.25).alias("a"), at(0.75).alias("b"), F.max("all").alias("n_texts"))
    wider = 1 + WIDENING * (F.greatest(F.lit(MIN_BAND) / F.col("n_texts"), F.lit(1.0)) - 1)
    reach = F.greatest(F.col("b") - F.col("a"), F.lit(1)) * spread * wider
    high = (F.col("b") + 1 + reach) * CELL
    high = F.when(F.col("measure").startswith("byte_share"), F.greatest(high, F.lit(BYTE_SHARE))).otherwise(high)
    return q.select("band", "measure", ((F.col("a") - reach) * CELL).alias("low"), high.alias("high"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judged(docs: DataFrame, vocab: str = VOCABULARY, byte_vocab: str = BYTE_VOCABULARY, spread: float = SPREAD) -> DataFrame:
    """`measure` with base_failed, rejected_by (the first measure outside its band) and kept.

    A text with too few words or too many repeated ones fails; any other is kept if all measures lie
    in the bands of its language or script. Null and empty texts have no words and fail.
    Repeated rows are judged alike and each counts in the bands; an empty table gives no rows.
    """
    rows = stored(measure(docs, vocab, byte_vocab), "fertility")
    limits = stored(bands(rows, spread), "bands")
    wide = limits.groupBy("band").pivot("measure", list(MEASURES)).agg(F.struct(F.first("low").alias("low"), F.first("high").alias("high")))
    own = wide.select("band", *[F.col(c).alias(f"o_{c}") for c in MEASURES])
    reason = F.lit(None).cast("string")
    for c in reversed(MEASURES):
        low, high = F.col(f"o_{c}.low"), F.col(f"o_{c}.high")
        reason = F.when((F.col(c) < low) | (F.col(c) > high), c).otherwise(reason)
    return rows.join(own, "band", "left").select(
        *NAMES, base_failed().alias("base_failed"), reason.alias("rejected_by")
    ).withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept. Rows of one id are known apart by a hash of their text."""
    key = F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit("")), F.col("lang").cast("string")))
    rows = wrapped(docs, key=key)
    verdicts = judged(docs.select(key.alias("doc_id"), "text", "lang"))
    gone = stored(verdicts.where("not kept").select(F.col("doc_id").alias("gone")).distinct(), "rejected")
    left = rows.join(bounded(gone), rows["key"].eqNullSafe(gone["gone"]), "left_anti")
    return left.select("row.*")
