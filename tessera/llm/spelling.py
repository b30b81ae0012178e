"""Spelling variants: words one edit apart, found by partition-and-enumerate signatures.

A word is taken as a binary vector, one dimension per letter and its first, second ... occurrence.
Words with one letter replaced differ in two dimensions, words with one letter more in one. The
letters are dealt into parts; if two vectors differ in at most k dimensions, they agree on all but
k of the parts. A word has one signature for every choice of the parts that are kept, and words that
share a signature are verified.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, dealt, stored, text_of

# Fixed value: the characters of a word, after A-Z are lower-cased.
LETTERS = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 199
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
# Parts for pairs of the same length, which differ in two dimensions, and for the others.
PARTS_REPLACED, PARTS_INSERTED = 4, 3


def slipped(run: Column, h: Column) -> Column:
    """The run without the code point that the hash points at, if SLIP divides the hash."""
    at = (h % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % SLIP == 0, without).otherwise(run)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the runs of letters of all texts, with their slips, however short or rare."""
    text = F.translate(text_of("text"), UPPER, LOWER)
    head = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    rows = docs.select(head.alias("head"), F.regexp_extract_all(text, F.lit(LETTERS), 0).alias("runs"))
    runs = dealt(rows).select("head", F.explode("runs").alias("run"))
    h = F.crc32(F.concat("head", "run").cast("binary"))
    return runs.select(slipped(F.col("run"), h).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def letter_parts(words: DataFrame, parts: int) -> list[str]:
    """The alphabet in parts that hold about as many letters of the words; at most 90 letters exist."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").count()
    out, load = [""] * parts, [0] * parts
    for c, n in sorted(letters.collect(), key=lambda r: (-r[1], r[0])):
        k = load.index(min(load))
        out[k] += c
        load[k] += n
    return out


def signatures(vector: Column, parts: list[str], k: int) -> list[Column]:
    """One per choice of k parts to leave out: the letters of the others, in order. `vector` is the
    word's letters in order, so equal letters stand for its dimensions."""
    return [F.translate(vector, "".join(parts[i] for i in left_out), "") for left_out in combinations(range(len(parts)), k)]


def _rows(words: DataFrame, kind: str, short: Column, parts: list[str], k: int, longer: bool = False) -> DataFrame:
    """(key, word, n): the hash of every signature with each half of the word.

    `short` is the length of the shorter word of a pair. An edit lies in one half, so the first
    half or the last one is the same in both; a longer word's middle is left out.
    """
    half = (short / 2).cast("int")
    first = F.substring("word", F.lit(1), half)
    last = F.substring("word", half + (2 if longer else 1), short - half)
    vector = F.array_join(F.array_sort(F.split("word", "")), "")
    keys = [
        F.xxhash64(F.lit(kind), short, F.lit(side), affix, F.lit(i), signature)
        for side, affix in (("first", first), ("last", last))
        for i, signature in enumerate(signatures(F.col("vector"), parts, k))
    ]
    return words.withColumn("vector", vector).select(F.explode(F.array(*keys)).alias("key"), "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): all pairs of `words` (word, n) at one inserted, deleted or replaced letter,
    each once. Words that share a signature are compared in the join itself; hot signatures
    are the split of Spark's skewed joins."""
    length = F.length("word")
    two = letter_parts(words, PARTS_REPLACED)
    one = letter_parts(words, PARTS_INSERTED)
    same = _rows(words, "replaced", length, two, 2)
    shorter = _rows(words, "inserted", length, one, 1)
    longer = _rows(words, "inserted", length - 1, one, 1, longer=True)
    left = same.unionByName(shorter).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = same.unionByName(longer).select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    # Of a pair of the same length the smaller word is on the left, else the shorter one.
    ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    verified = F.levenshtein("a", "b", 1) == 1
    return left.join(right, "key").where(ordered & verified).groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))


def followed(steps: DataFrame) -> DataFrame:
    """(word, root): from `steps` (word, form), each form followed to the last. Ways double in every
    round, and counts grow five-fold with each step, so the rounds are few."""
    roots = steps.select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = stored(roots.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        roots = further.select("word", "root")
        if further.where("moved").isEmpty():
            return roots


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word long and frequent enough.

    A word's form is the most frequent word near it, the first in code-point order on a tie, if that
    is `ratio` times as frequent. Null and empty texts have no words; a null id hashes as an
    empty one. Repeated rows count again. Other columns are ignored, whatever their names. No
    words, as in an empty table, give no rows.
    """
    enough = (F.length("word") >= min_length) & (F.col("n") >= min_count)
    words = stored(word_counts(docs).where(enough), "words")
    pairs = stored(near_pairs(words), "pairs")
    both = pairs.selectExpr("a as word", "n_a as n", "b as other", "n_b as other_n").unionByName(
        pairs.selectExpr("b as word", "n_b as n", "a as other", "n_a as other_n")
    )
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form")))
    near = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    has_form = -F.col("best.rank") >= ratio * F.col("n")
    near = near.select(
        "word",
        "n_near",
        F.when(has_form, F.col("best.form")).alias("form"),
        F.when(has_form, -F.col("best.rank")).alias("form_n"),
    )
    near = stored(near, "near")
    roots = followed(near.where("form is not null"))
    out = words.join(near, "word", "left").join(bounded(roots), "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n"
    )
