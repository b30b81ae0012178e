"""What the text operators share: words, work tables, order by hash and prefix sums."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import shared_dir

# What separates words, and a word.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

# Hex digits of a hash that name a bucket: 4096 buckets per group bound every window below.
BUCKET_DIGITS = 3


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def split_words(text: str) -> list[str]:
    """Words of a text: runs without blanks (Python's own split knows more kinds of blanks)."""
    for c in BLANKS[1:]:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Run the plan once: its rows as a compressed table in the shared folder, read back.

    What follows starts from those files, so a lost executor costs no more than its own tasks.
    """
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """Rows over all cores when the input has fewer splits than that; else unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def wrapped(docs: DataFrame, **more: Column) -> DataFrame:
    """One column `row` with a row's own columns, and the given ones: their names can't clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


def order_hash(*columns: Column | str) -> Column:
    """32 hex digits that give rows an order unrelated to their content."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("\x01", *parts))


def prefix_sum(
    df: DataFrame, group: list[str], by: list[str], value: Column, out: str, bucket: Column | None = None
) -> DataFrame:
    """`out`: the sum of `value` over the rows that come before in the group, ordered by `by`.

    The first of `by` is a hex hash and its first digits the bucket, or `bucket` is given and
    grows with the order. Bucket totals are added up first, so no window holds more rows than
    one bucket, or one total per bucket, however large the group is. Group columns aren't null.
    """
    keyed = df.withColumns(
        {
            "_b": F.substring(by[0], 1, BUCKET_DIGITS) if bucket is None else bucket,
            "_v": value.cast("bigint"),
        }
    )
    before = (Window.unboundedPreceding, -1)
    totals = keyed.groupBy(*group, "_b").agg(F.sum("_v").alias("_t"))
    over = Window.partitionBy(*group).orderBy("_b").rowsBetween(*before)
    base = totals.select(*group, "_b", F.coalesce(F.sum("_t").over(over), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group, "_b").orderBy(*by).rowsBetween(*before)
    return (
        keyed.join(base, [*group, "_b"])
        .withColumn(out, F.col("_base") + F.coalesce(F.sum("_v").over(inside), F.lit(0)))
        .drop("_b", "_v", "_base")
    )


def ordered_number(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """`out`: 0, 1, 2 ... in the given order, from sorted ranges and one count per range."""
    ranges = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    over = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_range", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranges.join(base, "_range")
        .withColumn(out, (F.col("_base") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("_range", "_base")
    )


# A key with more than rows / HOT_SHARE rows is hot, so there are at most HOT_SHARE of them.
HOT_SHARE = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, total: int, size: str = "group_size") -> DataFrame:
    """`rows` left-joined to `groups`, which has `key` once and the number of its rows in `size`.

    The hot keys, at most HOT_SHARE of them by their share of the `total` rows, are sent to every
    task, so no key's rows meet in one; the others are joined as Spark sees fit.
    """
    more = [c for c in groups.columns if c != key]
    hot = F.col(size) > total / HOT_SHARE
    first = rows.join(F.broadcast(groups.where(hot).withColumnsRenamed({c: f"_hot_{c}" for c in more})), key, "left")
    is_hot = F.col(f"_hot_{size}").isNotNull()
    done = first.where(is_hot).select(*rows.columns, *[F.col(f"_hot_{c}").alias(c) for c in more])
    rest = first.where(~is_hot).select(*rows.columns).join(groups.where(~hot), key, "left")
    return done.unionByName(rest.select(*rows.columns, *more))


# Rows of some 100 bytes that may be sent to every task.
BROADCAST_ROWS = 200_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if it is counted and short; else the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df
