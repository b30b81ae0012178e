"""Pairs of ids that share keys: the join under co-rating, similarity, graphs and itemsets.

Four measures keep it within bounds when keys are unevenly filled.

* A key with many members is cut into blocks of members, and every pair of blocks becomes a
  join key of its own, so the pairs of one key are made by many tasks.
* Pairs are not shuffled one by one. A key sends each of its ids the list of the greater ids, dealt out
  by that id, and pairs are made and counted in the task that holds all lists of an id.
* Where keys are few and two ids share one as a rule, there are more pair rows than pairs. Ids then carry a bit
  per key, and blocks of ids are counted against each other: only pairs that share enough leave a task.
* The heaviest keys (a bounded number) are not expanded at all when a pair needs more than one
  shared key. Ordered from heavy to light, an id may leave out its first `need - 1` keys:
  two ids that share `need` keys still meet on one of the others. What the left-out keys add
  is then looked up for the pairs that did meet. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed, small_side

BLOCK_ROWS = 2_000
HOT_DEGREE = 5_000
MAX_HOT_KEYS = 64
# Pair rows that one task makes and counts, those whose lists one task writes, and plain rows made distinct in one.
TASK_PAIRS, LIST_PAIRS, TASK_ROWS = 1_000_000, 16_000_000, 1_000_000
# Keys that an id may carry a bit of, and ids that are counted against as many others at a time.
BIT_KEYS, BIT_IDS = 4096, 2048
# With so many rows for each pair that there can be, most pairs are summed up before they leave a task.
REPEATED = 8


@dataclass(frozen=True)
class Skew:
    """What a look at the key sizes found: the heaviest keys, and whether any key needs blocks."""

    hot: list = field(default_factory=list)
    large: bool = False
    block_rows: int = BLOCK_ROWS
    # Pair rows of all keys, None if they were not counted.
    pairs: float | None = field(default=None, compare=False)


def probe_skew(
    members: DataFrame,
    key: str,
    block_rows: int = BLOCK_ROWS,
    hot_degree: int = HOT_DEGREE,
    max_hot: int = MAX_HOT_KEYS,
) -> Skew:
    """One count per key; at most `max_hot` keys come back to the driver."""
    n, least = F.col("degree"), min(block_rows, hot_degree)
    degrees = members.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("degree"))
    pairs = F.sum(n.cast("double") * (n - 1) / 2)
    seen = degrees.agg(pairs.alias("pairs"), F.max(n).alias("most")).first()
    heavy = []
    if (seen.most or 0) > least:
        heavy = degrees.where(n > least).orderBy(F.desc("degree"), F.asc(key)).limit(max_hot).collect()
    return Skew(
        hot=[r[0] for r in heavy if r.degree > hot_degree],
        large=any(r.degree > block_rows for r in heavy),
        block_rows=block_rows,
        pairs=float(seen.pairs or 0.0),
    )


def task_count(df: DataFrame, rows: float, task_rows: int) -> int:
    """Tasks that take `task_rows` each, as many as there are cores at least."""
    return max(int(rows // task_rows) + 1, df.sparkSession.sparkContext.defaultParallelism)


def _suffixed(cols: Sequence[str], side: str) -> list[Column]:
    return [F.col(c).alias(f"{c}_{side}") for c in cols]


def pairs_within(
    members: DataFrame,
    id_col: str,
    key: str,
    carry: Sequence[str] = (),
    skew: Skew = Skew(),
) -> DataFrame:
    """(a, b, <carry>_a, <carry>_b) with a < b, once per shared key. Rows must be distinct."""
    if not skew.large:
        left = members.select(
            F.col(key).alias("_k"), F.col(id_col).alias("a"), *_suffixed(carry, "a")
        )
        right = members.select(
            F.col(key).alias("_k"), F.col(id_col).alias("b"), *_suffixed(carry, "b")
        )
        return left.join(right, "_k").where(F.col("a") < F.col("b")).drop("_k")

    base = members.select(F.col(key).alias("_k"), F.col(id_col).alias("_id"), *carry)
    wide = (
        base.groupBy("_k")
        .agg(F.count(F.lit(1)).alias("_d"))
        .where(F.col("_d") > skew.block_rows)
        .select("_k", F.ceil(F.col("_d") / skew.block_rows).cast("int").alias("_n"))
    )
    base = base.join(wide, "_k", "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    base = base.withColumn("_blk", F.pmod(F.xxhash64("_id"), F.col("_n")).cast("int"))
    left = base.select(
        "_k",
        F.col("_blk").alias("_i"),
        F.explode(F.sequence(F.col("_blk"), F.col("_n") - 1)).alias("_j"),
        F.col("_id").alias("_x"),
        *_suffixed(carry, "x"),
    )
    right = base.select(
        "_k",
        F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_i"),
        F.col("_blk").alias("_j"),
        F.col("_id").alias("_y"),
        *_suffixed(carry, "y"),
    )
    met = left.join(right, ["_k", "_i", "_j"]).where(
        (F.col("_i") < F.col("_j")) | (F.col("_x") < F.col("_y"))
    )
    ordered = F.col("_x") < F.col("_y")
    out = [
        F.least("_x", "_y").alias("a"),
        F.greatest("_x", "_y").alias("b"),
    ]
    for c in carry:
        x, y = F.col(f"{c}_x"), F.col(f"{c}_y")
        out.append(F.when(ordered, x).otherwise(y).alias(f"{c}_a"))
        out.append(F.when(ordered, y).otherwise(x).alias(f"{c}_b"))
    return met.select(*out)


def _lists(members: DataFrame, carry: Sequence[str], skew: Skew) -> DataFrame:
    """(a, _need, <carry>_a, others): per key and id `a`, the greater ids of the key with what they carry."""
    entry = F.struct("_id", "_need", *carry)
    if not skew.large:
        # By pair rows, not by bytes read: lists are much longer than the rows they are made of.
        members = members.repartition(task_count(members, skew.pairs or 0.0, LIST_PAIRS), "_key")
        held = members.groupBy("_key").agg(F.array_sort(F.collect_list(entry)).alias("held"))
        placed = held.where(F.size("held") > 1).select("held", F.posexplode("held").alias("pos", "x"))
        others = F.slice(F.col("held"), F.col("pos") + 2, F.size("held"))
    else:
        wide = members.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / skew.block_rows).cast("int").alias("_n"))
        block = F.pmod(F.xxhash64("_id"), F.col("_n")).cast("int").alias("_blk")
        blocks = members.join(wide, "_key").groupBy("_key", "_n", block).agg(F.collect_list(entry).alias("held"))
        left = blocks.select("_key", F.col("_blk").alias("_i"), F.explode(F.sequence("_blk", F.col("_n") - 1)).alias("_j"), F.col("held").alias("l"))
        right = blocks.select("_key", F.explode(F.sequence(F.lit(0), "_blk")).alias("_i"), F.col("_blk").alias("_j"), F.col("held").alias("r"))
        met = left.join(right, ["_key", "_i", "_j"])
        ways = F.when(F.col("_i") == F.col("_j"), F.array(F.struct("l", "r"))).otherwise(
            F.array(F.struct("l", "r"), F.struct(F.col("r").alias("l"), F.col("l").alias("r")))
        )
        placed = met.select(F.explode(ways).alias("w")).select(F.col("w.r").alias("held"), F.explode("w.l").alias("x"))
        others = F.filter("held", lambda e: e["_id"] > F.col("x._id"))
    rows = placed.select(F.col("x._id").alias("a"), F.col("x._need").alias("_need"), *[F.col(f"x.{c}").alias(f"{c}_a") for c in carry], others.alias("others"))
    rows = rows.where(F.size("others") > 0)
    return rows.select(
        "a", "_need", *[f"{c}_a" for c in carry], F.col("others._id").alias("b"), *[F.col(f"others.{c}").alias(f"{c}_b") for c in carry]
    )


# The sums a pair needs for a correlation over its shared keys.
SUMS = ("sx", "sy", "sxy", "sxx", "syy")


def _products(x: Column, y: Column) -> dict[str, Column]:
    return {"sx": x, "sy": y, "sxy": x * y, "sxx": x * x, "syy": y * y}


def _totals(members: DataFrame, value: str | None, skew: Skew) -> DataFrame:
    """(a, b, _need, n[, sums]) of all pairs that share a key; `_need` is that of a."""
    carry = [value] if value else []
    aggs = [F.max("_need").alias("_need"), F.count(F.lit(1)).alias("n")]
    if value:
        terms = _products(F.col(f"{value}_a"), F.col(f"{value}_b"))
        aggs += [F.sum(t).alias(s) for s, t in terms.items()]
    rows = skew.pairs or 0.0
    ids = members.agg(F.approx_count_distinct("_id")).first()[0]
    if rows > REPEATED * ids * (ids - 1) / 2:
        met = pairs_within(members, "_id", "_key", ["_need", *carry], skew).withColumnRenamed("_need_a", "_need")
    else:
        dealt = _lists(members, carry, skew).repartition(task_count(members, rows, TASK_PAIRS), "a")
        zipped = F.explode(F.arrays_zip("b", *[f"{c}_b" for c in carry])).alias("e")
        met = dealt.select("a", "_need", *[f"{c}_a" for c in carry], zipped).select(
            "a", "_need", *[f"{c}_a" for c in carry], F.col("e.b").alias("b"), *[F.col(f"e.{c}_b").alias(f"{c}_b") for c in carry]
        )
        met = met.where(F.col("a") < F.col("b"))
    return met.groupBy("a", "b").agg(*aggs)


def _bit_counts(members: DataFrame) -> DataFrame:
    """(a, b, _need, n) of all pairs with n >= `_need` (that of a) shared keys, from a bit per key and id.

    Every pair of blocks of ids is one row of a join; its counts are made some ids at a time.
    """
    codes = members.select("_key").distinct().withColumn("_code", F.row_number().over(Window.orderBy("_key")) - 1)
    codes = checkpointed(codes)
    n_words = codes.count() // 64 + 1
    bit = F.expr("shiftleft(1L, _code % 64)")
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("_code") / 64) == i, bit)), F.lit(0).cast("bigint")) for i in range(n_words)]
    sets = members.join(F.broadcast(codes), "_key").groupBy("_id").agg(F.max("_need").alias("_need"), F.array(*words).alias("_bits"))
    sets = checkpointed(sets)
    n_blocks = sets.count() // BIT_IDS + 1
    last = F.lit(n_blocks - 1)
    block = F.pmod(F.xxhash64("_id"), F.lit(n_blocks)).cast("int").alias("_blk")
    blocks = sets.groupBy(block).agg(F.collect_list(F.struct("_id", "_need", "_bits")).alias("m"))
    held = lambda p: [F.col("m._id").alias(f"{p}_id"), F.col("m._need").alias(f"{p}_need"), F.flatten("m._bits").alias(f"{p}_bits")]
    left = blocks.select(F.col("_blk").alias("_i"), F.explode(F.sequence("_blk", last)).alias("_j"), *held("x"))
    right = blocks.select(F.explode(F.sequence(F.lit(0), "_blk")).alias("_i"), F.col("_blk").alias("_j"), *held("y"))
    kind = sets.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                same = batch["_i"][r] == batch["_j"][r]
                x, y = ([batch[f"{p}_{c}"][r].values for c in ("id", "need", "bits")] for p in "xy")
                xs, ys = (v[2].to_numpy().view(np.uint64).reshape(len(v[0]), -1) for v in (x, y))
                need_x, need_y = x[1].to_numpy(), y[1].to_numpy()
                for k in range(0, len(xs), 256):
                    part = xs[k : k + 256]
                    n = np.zeros((len(part), len(ys)), np.int64)
                    for w in range(xs.shape[1]):
                        n += np.bitwise_count(part[:, w, None] & ys[None, :, w])
                    # Pairs that share nothing are none; within a block each is taken once.
                    good = (n > 0) & (n >= np.minimum(need_x[k : k + 256, None], need_y[None]))
                    if same:
                        good &= np.arange(k, k + len(part))[:, None] < np.arange(len(ys))
                    i, j = np.nonzero(good)
                    columns = [x[0].take(pa.array(i + k)), y[0].take(pa.array(j)), pa.array(need_x[i + k]), pa.array(need_y[j]), pa.array(n[i, j])]
                    yield pa.RecordBatch.from_arrays(columns, ["x", "y", "need_x", "need_y", "n"])

    met = left.join(right, ["_i", "_j"]).mapInArrow(run, f"x {kind}, y {kind}, need_x int, need_y int, n bigint")
    need = F.when(F.col("x") < F.col("y"), F.col("need_x")).otherwise(F.col("need_y"))
    met = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), need.alias("_need"), "n")
    return met.where(F.col("n") >= F.col("_need"))


def pair_sums(
    members: DataFrame,
    id_col: str,
    key: str,
    need: int | Column = 1,
    value: str | None = None,
    skew: Skew | None = None,
) -> DataFrame:
    """(a, b, n[, sx, sy, sxy, sxx, syy]) with a < b for all pairs that may share enough keys.

    `members` holds distinct (id, key) rows, with a numeric `value` if sums are wanted. `need` is
    the number of keys a pair must share, a number or a column that is constant per id. Every
    pair that shares at least that many keys is there with exact n and sums; pairs that share
    fewer may be missing. Callers filter on n.

    With a `need` above 1, pairs are counted first, without values. If looking those that share enough up again
    makes fewer rows than all pairs do, only their sums are taken.
    """
    if skew is None:
        skew = probe_skew(members, key)
    several = isinstance(need, int) and need > 1
    if isinstance(need, int):
        need = F.lit(need)
    cols = [F.col(id_col).alias("_id"), F.col(key).alias("_key"), need.cast("int").alias("_need")]
    if value:
        cols.append(F.col(value).cast("double").alias(value))
    members = members.select(*cols).where(F.col("_key").isNotNull() & F.col("_id").isNotNull())
    if not value or not several:
        return _summed(members, value, skew).where(F.col("n") >= F.col("_need")).drop("_need")
    members = checkpointed(members)
    found = _summed(members.drop(value), None, skew).where(F.col("n") >= F.col("_need"))
    found = checkpointed(found.select("a", "b", "n"))
    sizes = checkpointed(members.groupBy("_id").agg(F.count(F.lit(1)).alias("size")))
    n_found = found.count()
    sized = found.select("a", "b")
    for side in ("a", "b"):
        of = sizes.select(F.col("_id").alias(side), F.col("size").alias(f"size_{side}"))
        sized = small_side(sized, n_found).join(of, side)
    rows = sized.agg(F.sum(F.least("size_a", "size_b"))).first()[0] or 0
    if rows >= (skew.pairs or 0.0):
        return _summed(members, value, skew).drop("_need")
    # The keys of the smaller set are looked up in the larger one.
    first = F.col("size_a") <= F.col("size_b")
    work = sized.select("a", "b", F.when(first, F.col("a")).otherwise(F.col("b")).alias("s"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("l"))
    met = small_side(work, n_found).join(members.select(F.col("_id").alias("s"), "_key", F.col(value).alias("_vs")), "s")
    met = small_side(met, int(rows)).join(members.select(F.col("_id").alias("l"), "_key", F.col(value).alias("_vl")), ["l", "_key"])
    of_a = F.col("s") == F.col("a")
    x = F.when(of_a, F.col("_vs")).otherwise(F.col("_vl"))
    y = F.when(of_a, F.col("_vl")).otherwise(F.col("_vs"))
    terms = [F.sum(t).alias(s) for s, t in _products(F.col("x"), F.col("y")).items()]
    met = met.select("a", "b", x.alias("x"), y.alias("y"))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), *terms)


def _summed(members: DataFrame, value: str | None, skew: Skew) -> DataFrame:
    """(a, b, _need, n[, sums]) from (_id, _key, _need[, value]), the heaviest keys looked up."""
    sums = list(SUMS) if value else []
    if value is None and skew.pairs is not None:
        ids, keys = members.agg(F.approx_count_distinct("_id"), F.approx_count_distinct("_key")).first()
        if keys <= BIT_KEYS and skew.pairs > ids * (ids - 1) / 2:
            return _bit_counts(members)
    if not skew.hot:
        return _totals(members, value, skew)

    hot = members.where(F.col("_key").isin(skew.hot))
    cold = members.where(~F.col("_key").isin(skew.hot))
    rank = F.array_position(F.array(*[F.lit(k) for k in skew.hot]), F.col("_key")).cast("int")
    entry = F.struct(
        rank.alias("rank"), (F.col(value) if value else F.lit(1.0)).alias("v")
    )
    # At most MAX_HOT_KEYS entries per id, heaviest key first.
    held = hot.groupBy("_id").agg(
        F.array_sort(F.collect_list(entry)).alias("held"), F.max("_need").alias("_need")
    )
    indexed = held.select(
        "_id",
        F.col("_need"),
        F.explode(
            F.when(
                F.size("held") >= F.col("_need"),
                F.slice("held", F.col("_need"), F.size("held")),
            )
        ).alias("e"),
    ).select("_id", F.col("e.rank").alias("_key"), "_need")
    by_hot = pairs_within(indexed, "_id", "_key", ("_need",), Skew(large=True, block_rows=skew.block_rows))
    by_hot = by_hot.select("a", "b", F.col("_need_a").alias("_need")).distinct()
    zero = [F.lit(0).cast("bigint").alias("n")] + [F.lit(0.0).alias(s) for s in sums]
    # The hot keys cannot add more than there are.
    near = _totals(cold, value, _cold(skew, cold)).where(F.col("n") + len(skew.hot) >= F.col("_need"))
    met = (
        near.unionByName(by_hot.select("a", "b", "_need", *zero))
        .groupBy("a", "b")
        .agg(F.max("_need").alias("_need"), *[F.sum(c).alias(c) for c in ["n", *sums]])
    )
    lookup = held.select("_id", F.map_from_entries("held").alias("m"))
    met = met.join(lookup.select(F.col("_id").alias("a"), F.col("m").alias("ma")), "a", "left")
    met = met.join(lookup.select(F.col("_id").alias("b"), F.col("m").alias("mb")), "b", "left")
    common = F.array_intersect(F.map_keys("ma"), F.map_keys("mb"))
    met = met.withColumn("_c", F.coalesce(common, F.array().cast("array<int>")))

    def over_common(which: str) -> Column:
        def term(k: Column) -> Column:
            return _products(F.col("ma")[k], F.col("mb")[k])[which]

        return F.aggregate(F.transform("_c", term), F.lit(0.0), lambda s, x: s + x)

    return met.select(
        "a",
        "b",
        "_need",
        (F.col("n") + F.size("_c")).alias("n"),
        *[(F.col(s) + over_common(s)).alias(s) for s in sums],
    )


def _cold(skew: Skew, cold: DataFrame) -> Skew:
    """The look at the keys that are left when the hot ones are taken out."""
    n = F.col("n")
    degrees = cold.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    seen = degrees.agg(F.sum(n.cast("double") * (n - 1) / 2).alias("pairs"), F.max(n).alias("most")).first()
    return Skew(large=(seen.most or 0) > skew.block_rows, block_rows=skew.block_rows, pairs=float(seen.pairs or 0.0))


def shared_counts(
    members: DataFrame, id_col: str, key: str, min_shared: int, skew: Skew | None = None, rows: int | None = None
) -> DataFrame:
    """(a, b, n): pairs of ids with at least `min_shared` common keys. `rows` is about how many rows
    `members` has; if it is known, they are made distinct in tasks of that many rows whatever their bytes."""
    members = members.select(id_col, key)
    if rows is not None:
        members = members.repartition(task_count(members, rows, TASK_ROWS), id_col, key)
    distinct = checkpointed(members.distinct())
    return pair_sums(distinct, id_col, key, min_shared, skew=skew).where(
        F.col("n") >= min_shared
    )


def jaccard_pairs(
    members: DataFrame, id_col: str, key: str, threshold: float, skew: Skew | None = None
) -> DataFrame:
    """(b1, b2, sim): all pairs with Jaccard similarity >= threshold > 0, exactly."""
    return set_pairs(checkpointed(members.select(id_col, key).distinct()), id_col, key, threshold, skew)


def set_pairs(
    distinct: DataFrame, id_col: str, key: str, threshold: float, skew: Skew | None = None
) -> DataFrame:
    """`jaccard_pairs` of rows that are distinct already."""
    sizes = checkpointed(distinct.groupBy(id_col).agg(F.count(F.lit(1)).alias("size")))
    if skew is None:
        skew = probe_skew(distinct, key)
    # |x & y| >= t * |x | y| >= t * |x|; the slack keeps rounding from raising the bound. Pairs that share
    # fewer keys leave where they are counted, before the sizes are joined.
    need = F.greatest(F.lit(1), F.ceil(F.col("size") * threshold - 1e-9).cast("int"))
    counts = pair_sums(distinct.join(sizes, id_col), id_col, key, need, skew=skew)
    return with_jaccard(counts, sizes, id_col).where(F.col("sim") >= threshold)


def with_jaccard(counts: DataFrame, sizes: DataFrame, id_col: str) -> DataFrame:
    """(b1, b2, sim) from (a, b, n) and the set sizes."""
    sa = sizes.select(F.col(id_col).alias("a"), F.col("size").alias("na"))
    sb = sizes.select(F.col(id_col).alias("b"), F.col("size").alias("nb"))
    return (
        counts.join(sa, "a")
        .join(sb, "b")
        .select(
            F.col("a").alias("b1"),
            F.col("b").alias("b2"),
            (F.col("n") / (F.col("na") + F.col("nb") - F.col("n"))).alias("sim"),
        )
    )
