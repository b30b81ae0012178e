"""Boilerplate lines: lines found on many sites, counted by sketches and checked near the limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANKS, WORD, stored, text_of, wrapped

# A line on so many distinct sites is boilerplate.
MIN_SITES = 8
# Sketches of 2^12 registers have a relative error of 1.04 / 64 per standard deviation; within
# three of them of the limit, and at least one site, the sites are counted exactly.
LG_K = 12
MARGIN = 3 * 1.04 / 2 ** (LG_K / 2)


def line_key(line: Column) -> Column:
    """96 bits of hash of a line without the blanks at its ends."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    return F.struct(F.xxhash64(trimmed).alias("h"), F.hash(trimmed).alias("g"))


def doc_key() -> Column:
    """Equal rows of a document share their key, and so their lines."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64(text_of()).alias("t"))


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, dk, site, line): the keys of all lines that hold a word."""
    worded = F.filter(F.split(text_of(), "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    found = F.explode(F.transform(worded, line_key))
    site = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select("doc_id", doc_key().alias("dk"), site.alias("site"), found.alias("line"))


def line_sketches(found: DataFrame) -> DataFrame:
    """(line, first_doc, sites): one sketch of the sites per line, built on the map side."""
    return found.groupBy("line").agg(
        F.min("doc_id").alias("first_doc"), F.hll_sketch_agg("site", F.lit(LG_K)).alias("sites")
    )


def merge_sketches(*parts: DataFrame) -> DataFrame:
    """Sketch tables of several loads as one."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("line").agg(
        F.min("first_doc").alias("first_doc"), F.hll_union_agg("sites").alias("sites")
    )


def boilerplate(found: DataFrame, sketches: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line, first_doc): lines on `min_sites` sites or more.

    Estimates far from the limit decide. Lines near it have their distinct sites counted, from the
    rows of those lines alone.
    """
    near = max(1.0, min_sites * MARGIN)
    guess = sketches.select("line", "first_doc", F.hll_sketch_estimate("sites").alias("n"))
    # Few lines are on many sites: the table is short beside the lines.
    guess = stored(guess.where(F.col("n") >= min_sites - near), "sites")
    unsure = guess.where(F.col("n") <= min_sites + near).select("line", "first_doc")
    counted = (
        found.select("line", "site")
        .join(unsure, "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_sites)
    )
    sure = guess.where(F.col("n") > min_sites + near).select("line", "first_doc")
    return sure.unionByName(unsure.join(counted.select("line"), "line"))


def rewritten(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(row, text, n_lines, n_removed): every row as it was, beside its new text and the counts."""
    found = lines(docs)
    common = stored(boilerplate(found, line_sketches(found), min_sites), "boilerplate")
    hits = (
        found.join(common, "line")
        .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .groupBy("dk")
        .agg(F.collect_set("line").alias("gone"))
        .withColumnRenamed("dk", "known")
    )
    rows = wrapped(docs, dk=doc_key(), text=F.col("text"), lines=F.split("text", "\n"))
    rows = rows.join(hits, rows["dk"].eqNullSafe(hits["known"]), "left")
    stay = F.filter("lines", lambda x: ~F.array_contains(F.col("gone"), line_key(x)))
    rows = rows.withColumn("stay", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(stay))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("stay", "\n"))
    count = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("bigint")
    return rows.select(
        "row", text.alias("text"), count("lines").alias("n_lines"), (count("lines") - count("stay")).alias("n_removed")
    )


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """`docs` with text rewritten, and n_lines, n_removed (in place of columns so named): every row
    once, other columns kept.

    A line with a word that is on `min_sites` sources or more, blanks at its ends aside, goes
    from all documents but the one with the smallest id, which keeps all its copies of it. A null
    source is one site with the empty name. Null texts stay null with no lines; an empty text has
    one line and keeps it; lines without words are never removed. Rows of one id share their
    claim on a line.
    """
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    rows = rewritten(docs, min_sites)
    return rows.select(*[F.col("row")[c].alias(c) for c in own], "text", "n_lines", "n_removed")
