"""Exact duplicates: two passes of a Bloom filter, then only possible repeats are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANK, HOT_SHARE, attach, stored, text_of

# Filter bits per row: two positions per row leave some 1.5 % of unique rows as possible repeats.
BITS_PER_ROW = 16
MIN_BITS = 1 << 16
# Rows of 16 bytes of a filter that may be sent to every executor: some 64 MB as a hash table. A
# longer filter stays where it is and is looked up by slim rows.
FILTER_ROWS = 1_000_000


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), BLANK, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sha, h): digest and 64-bit hash of each normalised text; null counts as empty."""
    n = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("n"))
    return n.select("doc_id", F.sha2("n", 256).alias("sha"), F.xxhash64("n").alias("h"))


def filter_bits(rows: int) -> int:
    return max(MIN_BITS, 1 << (rows * BITS_PER_ROW - 1).bit_length())


def positions(h: Column, bits: int) -> list[Column]:
    return [F.pmod(h, F.lit(bits)), F.pmod(F.xxhash64(h, F.lit(1)), F.lit(bits))]


def repeat_filter(rows: DataFrame, bits: int) -> DataFrame:
    """First pass, (word, bits): positions hit twice or more, 64 to a row. Sparse, so positions
    that only one row hits cost nothing."""
    hit = rows.select(F.explode(F.array(*positions(F.col("h"), bits))).alias("p"))
    twice = hit.groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    return twice.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def in_filter(rows: DataFrame, filter_words: DataFrame, position: Column) -> DataFrame:
    """`rows` with `hit`: whether the filter has the position."""
    words = filter_words.select(F.col("word").alias("_w"), F.col("bits").alias("_b"))
    at = rows.withColumn("_p", position)
    at = at.join(words, F.shiftright("_p", 6) == F.col("_w"), "left")
    hit = F.expr("coalesce(shiftrightunsigned(_b, cast(_p & 63 as int)) & 1L, 0L) = 1L")
    return at.select(*rows.columns, hit.alias("hit"))


def probe(rows: DataFrame, repeats: DataFrame, bits: int, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """Second pass: rows with `maybe`, true if all their positions are in the filter.

    Up to `filter_rows` words the filter goes to the rows. A longer one is looked up by them: hashes with
    more than 1/1000 of the rows, at most 1000, are repeats and need not look, so no word is asked
    for by many rows; the others look up one position, and those that hit the other one.
    """
    one, two = positions(F.col("h"), bits)
    own = rows.columns
    if repeats.count() <= filter_rows:
        side = F.broadcast(repeats)
        first = in_filter(rows, side, one).withColumnRenamed("hit", "hit0")
        return in_filter(first, side, two).select(*own, (F.col("hit0") & F.col("hit")).alias("maybe"))
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > max(1, rows.count() // HOT_SHARE)).select("h", F.lit(True).alias("hot"))
    split = rows.join(F.broadcast(hot), "h", "left")
    known = split.where("hot").select(*own, F.lit(True).alias("maybe"))
    looked = stored(in_filter(split.where("hot is null").select(*own), repeats, one), "looked")
    cleared = looked.where("not hit").select(*own, F.lit(False).alias("maybe"))
    again = in_filter(looked.where("hit").select(*own), repeats, two).select(*own, F.col("hit").alias("maybe"))
    return known.unionByName(cleared).unionByName(again)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each run of blanks became one space; null and empty are
    equal. The smallest doc_id of a group stays. Rows that repeat a doc_id and its text share
    its decision and count in group_size. A null doc_id stays only in a group without others
    and has a null keep_id there. Other columns are ignored; an empty table gives no rows.

    Only slim rows (id, digest, hash) are handled after the one pass over the texts. Rows that the
    filter clears go straight to the result; possible repeats are grouped by digest, with sums on
    the map side, and joined back. Groups above 1/1000 of the rows, at most 1000, are broadcast.
    """
    rows = stored(digests(docs, id_col, text_col), "digests")
    total = rows.count()
    bits = filter_bits(max(total, 1))
    # The filter is read twice: counted, then probed.
    marked = stored(probe(rows, stored(repeat_filter(rows, bits), "filter"), bits), "probed")
    maybe = marked.where("maybe")
    groups = (
        maybe.groupBy("sha")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    groups = stored(groups, "groups")
    found = attach(maybe, groups, "sha", total).select(
        "doc_id",
        "sha",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
    )
    one = F.lit(1).cast("bigint").alias("group_size")
    alone = marked.where("not maybe").select("doc_id", "sha", F.col("doc_id").alias("keep_id"), one)
    return alone.unionByName(found).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
