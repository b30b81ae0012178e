"""Frequent itemsets over baskets kept as long (basket_id, item) rows.

No basket is ever gathered into one row. Pairs come from the shared-key join with baskets as
keys; longer sets grow one item at a time: a set found in a basket is joined with its surviving
extensions, and the added item must be in the same basket. Inside the miner a frequent item is a
number that rises with its support, so sets start with their rarest item and few sets share
a prefix.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed, small_side, stored
from .dictionary import numbered
from .pairs import pair_sums, pairs_within, probe_skew
from .partitions import partition_of


def baskets(
    df: DataFrame, basket: str, item: str, min_size: int | None = None
) -> DataFrame:
    """Distinct (basket_id, item) rows; with `min_size`, only baskets of more items than that."""
    rows = df.select(F.col(basket).alias("basket_id"), F.col(item).alias("item")).distinct()
    if min_size is None:
        return rows
    kept = rows.groupBy("basket_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_size)
    return rows.join(kept.select("basket_id"), "basket_id", "left_semi")


def count_baskets(rows: DataFrame) -> int:
    return rows.select("basket_id").distinct().count()


def support_for(rows: DataFrame, fraction: float) -> int:
    """The absolute support that stands for a fraction of the baskets."""
    return max(1, math.ceil(fraction * count_baskets(rows)))


def _mined(rows: DataFrame, needs: DataFrame, max_len: int | None) -> DataFrame:
    """(grp, items, support) of all sets frequent within their group.

    `rows` holds distinct (grp, basket_id, item), a basket lying in one group; `needs` holds the
    support (grp, need) asked in each group.
    """
    counts = rows.groupBy("grp", "item").agg(F.count(F.lit(1)).alias("support"))
    # An item has a number of its own in every group, so the number also tells the group.
    asked_for = counts.join(needs, "grp").where(F.col("support") >= F.col("need"))
    singles = checkpointed(numbered(asked_for, ["support", "grp", "item"], "code"))
    names = small_side(singles, singles.count())
    # Tables in the shared folder: what their making shuffles goes with it.
    kept = stored(rows.join(names, ["grp", "item"]).select("basket_id", "code", "need"))
    levels = [singles.select(F.array("code").alias("items"), "support")]
    asked = names.select(F.col("code").alias("first"), "need")
    level = _frequent(
        pair_sums(
            kept, "code", "basket_id", F.col("need"), skew=probe_skew(kept, "basket_id")
        ).select(F.array("a", "b").alias("items"), F.col("n").alias("support")),
        asked,
    )
    item_rows = kept.select("basket_id", F.col("code").alias("last"))
    found = kept.select("basket_id", F.array("code").alias("items"))
    size = 2
    while max_len is None or size <= max_len:
        level = checkpointed(level)
        n_sets = level.count()
        if n_sets == 0:
            break
        levels.append(level)
        if size == max_len:
            break
        candidates = checkpointed(_candidates(level, size + 1))
        n_candidates = candidates.count()
        if n_candidates == 0:
            break
        sets = small_side(level.select("items"), n_sets)
        if size == 2:
            found = _occurrences(found, sets, item_rows)
        else:
            found = found.join(sets, "items", "left_semi")
        found = stored(_occurrences(found, small_side(candidates, n_candidates), item_rows))
        level = _frequent(
            found.groupBy("items").agg(F.count(F.lit(1)).alias("support")), asked
        )
        size += 1
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    # Back to items; the lists are as long as the sets.
    return (
        out.select("items", "support", F.explode("items").alias("code"))
        .join(names.select("code", "grp", "item"), "code")
        .groupBy("items", "grp", "support")
        .agg(F.array_sort(F.collect_list("item")).alias("names"))
        .select("grp", F.col("names").alias("items"), "support")
    )


def _frequent(counts: DataFrame, asked: DataFrame) -> DataFrame:
    return (
        counts.join(asked, F.col("items")[0] == F.col("first"))
        .where(F.col("support") >= F.col("need"))
        .select("items", "support")
    )


def _candidates(level: DataFrame, size: int) -> DataFrame:
    """Sets of `size` items: prefix join of the level below, then every subset must be in it."""
    head = F.slice("items", 1, size - 2)
    ext = level.select(
        head.alias("k"), head.alias("head"), F.element_at("items", -1).alias("last")
    )
    pairs = pairs_within(ext, "last", "k", ["head"], probe_skew(ext, "k"))
    made = pairs.select(F.concat("head_a", F.array("a", "b")).alias("items"))
    # The two sets that were joined are known to be frequent; the other size - 2 are checked.
    subsets = made.select(
        "items",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(size - 3)),
                lambda drop: F.filter("items", lambda x, i: i != drop),
            )
        ).alias("subset"),
    )
    known = level.select(F.col("items").alias("subset"))
    return (
        subsets.join(known, "subset")
        .groupBy("items")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(F.col("hits") == size - 2)
        .select("items")
    )


def _occurrences(found: DataFrame, sets: DataFrame, item_rows: DataFrame) -> DataFrame:
    """(basket_id, items): baskets that hold the sets, from baskets that hold their heads."""
    ext = sets.select(
        F.slice("items", 1, F.size("items") - 1).alias("head"),
        F.element_at("items", -1).alias("last"),
        "items",
    )
    return (
        found.withColumnRenamed("items", "head")
        .join(ext, "head")
        .select("basket_id", "items", "last")
        .join(item_rows, ["basket_id", "last"], "left_semi")
        .select("basket_id", "items")
    )


def frequent_itemsets(
    rows: DataFrame, support: int, max_len: int | None = None
) -> DataFrame:
    """(items, support): all sets of items that are together in at least `support` baskets."""
    needs = rows.sparkSession.createDataFrame([(0, support)], "grp int, need int")
    one = rows.select(F.lit(0).alias("grp"), "basket_id", "item")
    return _mined(one, needs, max_len).drop("grp")


def _chunked(rows: DataFrame, support: int, n_chunks: int) -> tuple[DataFrame, DataFrame]:
    total = count_baskets(rows)
    placed = rows.select(
        partition_of(rows, "basket_id", n_chunks).alias("grp"), "basket_id", "item"
    )
    # The scaled support s * |chunk| / N; the slack keeps rounding from raising it.
    local = F.ceil(F.col("n") * support / F.lit(total) - 1e-9).cast("int")
    needs = (
        placed.select("grp", "basket_id")
        .distinct()
        .groupBy("grp")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("grp", F.greatest(local, F.lit(1)).alias("need"))
    )
    return placed, checkpointed(needs)


def son_candidates(
    rows: DataFrame, support: int, n_chunks: int, max_len: int | None = None
) -> DataFrame:
    """(items): sets frequent in at least one chunk of baskets at the scaled-down support.

    A chunk is a group of one distributed job, not a Python list; all chunks are mined side by
    side, each against its own threshold.
    """
    placed, needs = _chunked(rows, support, n_chunks)
    return _mined(placed, needs, max_len).select("items").distinct()


def count_itemsets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(items, support): baskets that hold every item of the given sets.

    Of each set only the rarest item is met with the baskets; those that have it are held against the next
    item, one after the other, and what is left at the end is counted. Items and sets move as numbers.
    """
    freq = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    listed = checkpointed(sets.select("items").distinct().withColumn("set_id", F.monotonically_increasing_id()))
    wanted = listed.select("set_id", F.explode(F.array_distinct("items")).alias("item")).join(freq, "item")
    codes = checkpointed(numbered(wanted.select("item", "n").distinct(), ["n", "item"], "code").select("item", "code"))
    n_codes = codes.count()
    known = F.count(F.lit(1)) == F.max("size")
    order = (
        wanted.join(codes, "item")
        .join(listed.select("set_id", F.size(F.array_distinct("items")).alias("size")), "set_id")
        .groupBy("set_id")
        .agg(F.array_sort(F.collect_list("code")).alias("codes"), known.alias("known"))
    )
    order = checkpointed(order.where("known").select("set_id", "codes"))
    seen = order.agg(F.count(F.lit(1)), F.max(F.size("codes"))).first()
    held = stored(rows.join(small_side(codes, n_codes), "item").select("basket_id", "code"))
    left = held.join(small_side(order.withColumn("code", F.col("codes")[0]), seen[0]), "code").drop("code")
    counts = None
    for size in range(1, (seen[1] or 0) + 1):
        done = left.where(F.size("codes") == size).groupBy("set_id").agg(F.count(F.lit(1)).alias("support"))
        counts = done if counts is None else counts.unionByName(done)
        if size < seen[1]:
            more = left.where(F.size("codes") > size).withColumn("code", F.col("codes")[size])
            left = more.join(held, ["basket_id", "code"], "left_semi").drop("code")
    if counts is None:
        return listed.select("items", F.lit(0).cast("bigint").alias("support")).where(F.lit(False))
    return listed.join(counts, "set_id").select("items", "support")


def son_itemsets(
    rows: DataFrame, support: int, n_chunks: int, max_len: int | None = None
) -> DataFrame:
    """Both phases: candidates per chunk, exact counts over all baskets, inclusive threshold."""
    candidates = son_candidates(rows, support, n_chunks, max_len)
    return count_itemsets(rows, candidates).where(F.col("support") >= support)
