"""Dense numbers for values: 0, 1, 2 ... in order, without a driver's map or a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed, small_side


def numbered(df: DataFrame, order: list[Column | str], out: str) -> DataFrame:
    """`df` with `out`: the place of each row in the order, from 0 without gaps.

    Rows are sorted in ranges; a range's rows know their place in it, and one count per range tells
    how many come before. Rows that are equal in the order get different numbers.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits are the range, the lower ones the place in it.
    ranges = checkpointed(ranges.withColumn("_at", F.monotonically_increasing_id()))
    counts = ranges.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = checkpointed(counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = ranges.withColumn("_range", F.shiftright("_at", 33)).join(small_side(base, base.count()), "_range")
    return joined.withColumn(out, (F.col("_base") + place).cast("bigint")).drop("_at", "_range", "_base")


def dense_ids(df: DataFrame, column: str, out: str = "code") -> DataFrame:
    """(column, out): every value that is not null once, with its number in ascending order."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return numbered(values, [column], out)


def encoded_edges(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (src, dst) between numbers in place of ids of any type, and the dictionary (id, code).
    The order of ids is kept, so src < dst stays."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    names = checkpointed(dense_ids(ends, "id"))
    known = small_side(names, names.count())
    src, dst = (known.select(F.col("id").alias(c), F.col("code").alias(f"_{c}")) for c in ("src", "dst"))
    coded = edges.join(src, "src").join(dst, "dst")
    return coded.select(F.col("_src").alias("src"), F.col("_dst").alias("dst")), names


def decoded(df: DataFrame, columns: list[str], names: DataFrame) -> DataFrame:
    """`df` with the given columns of numbers as ids again."""
    out = df
    for c in columns:
        out = out.join(names.select(F.col("code").alias(c), F.col("id").alias("_id")), c, "left").withColumn(c, F.col("_id")).drop("_id")
    return out.select(*df.columns)
