"""Inputs of the registered queries, derived from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import ngrams, non_empty_words
from ..session import spread

# First day of the held-out period of the recommender.
SPLIT_DATE = "2001-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_partkey").alias("business_id"),
        ((F.col("l_quantity").cast("int") - 1) % 5 + 1).cast("double").alias("stars"),
        F.col("l_linenumber").alias("line_no"),
    )
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("date")
    )
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "user_id",
        "business_id",
        "stars",
        "date",
        F.col("l_orderkey").alias("order_key"),
        "line_no",
    )


def train_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).where(F.col("date") < F.lit(SPLIT_DATE).cast("date"))


def test_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).where(F.col("date") >= F.lit(SPLIT_DATE).cast("date"))


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.when(F.col("p_brand") != "Brand#13", F.replace("p_name", F.lit(" "), F.lit(", "))).alias(
            "categories"
        ),
    )


def order_items(spark: SparkSession, sf_dir: str, item: str) -> DataFrame:
    """(basket_id, item): the part attribute `item` of every line of an order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", F.col(item).alias("item"))
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket_id"), "item"
    )


def user_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, business_id) of all reviews, duplicates kept."""
    return reviews(spark, sf_dir).select("user_id", "business_id")


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, hour): distinct hours in which a user was active."""
    return (
        table(spark, sf_dir, "events")
        .select("user_id", F.date_trunc("hour", "ts").alias("hour"))
        .distinct()
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five round groups, tight side groups and scatter, laid out from orders."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("p"),
    )
    c = F.col("k") % 5
    kind = (
        F.when(F.col("k") % 211 == 0, "scatter").when(F.col("k") % 97 == 0, "mini").otherwise("core")
    )

    def near(mult: int, q: int, shift: float):
        jitter = (F.col("p") % q).cast("double") * 4 / q - 2
        centre = (20 * ((mult * c) % 5)).cast("double") + jitter
        return centre + F.when(F.col("kind") == "mini", F.lit(shift)).otherwise(F.lit(0.0))

    def far(q: int):
        return (F.col("p") % q).cast("double") / 50 - 300

    def feature(mult: int, q: int, shift: float, q_far: int):
        return F.when(F.col("kind") == "scatter", far(q_far)).otherwise(near(mult, q, shift))

    return o.withColumn("kind", kind).select(
        F.col("k").alias("point_id"),
        F.array(
            feature(1, 1009, 9.0, 50021), feature(2, 997, -9.0, 49999), feature(3, 991, 0.0, 49991)
        ).alias("features"),
        c.cast("int").alias("centre"),
        "kind",
        (F.floor(F.col("k") / 5) % 5).cast("int").alias("chunk"),
    )


def wide_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"),
        F.col("embedding").cast("array<double>").alias("features"),
        "label",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def doc_shingle_sets(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """(doc_id, shingles): distinct word n-grams of the whole text; a shorter text is one."""
    tokens = documents(spark, sf_dir).select(
        "doc_id", non_empty_words(F.col("text")).alias("tokens")
    )
    return tokens.select("doc_id", ngrams(F.col("tokens"), n).alias("shingles"))


def doc_shingles(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """(doc_id, shingle): `doc_shingle_sets`, a row per shingle."""
    return doc_shingle_sets(spark, sf_dir, n).select("doc_id", F.explode("shingles").alias("shingle"))


def block_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item), distinct: customers in blocks of 150, each with 200 items of its own. How often
    two customers of a block meet does not depend on the number of blocks."""
    block = F.floor(F.col("user_id") / 150)
    item = (block * 200 + F.col("business_id") % 200).alias("item")
    return user_items(spark, sf_dir).select("user_id", item).distinct()


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, key), distinct: the parts of an order and its line states. The states are held by
    half of all orders or more, the parts by few."""
    li = table(spark, sf_dir, "lineitem")
    parts = li.select(F.col("l_orderkey").alias("order_id"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("key"))
    states = li.select("l_orderkey", F.concat(F.lit("s"), "l_linestatus"))
    flags = li.select("l_orderkey", F.concat(F.lit("f"), "l_returnflag"))
    return parts.union(states).union(flags).distinct()


def users(spark: SparkSession, sf_dir: str, rated: DataFrame, unseen: bool = False) -> DataFrame:
    """Customer columns with review count and mean stars; with `unseen`, customers without ratings
    too, with no reviews and the mean of all stars."""
    per = rated.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("review_count_user"), F.avg("stars").alias("user_avg_rate")
    )
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_nationkey").alias("nationkey"),
    )
    return _with_means(c, per, "user_id", rated, unseen)


def business_profile(
    spark: SparkSession, sf_dir: str, rated: DataFrame, unseen: bool = False
) -> DataFrame:
    """Part columns with review count and mean stars; `unseen` as for users."""
    per = rated.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("review_count_bus"), F.avg("stars").alias("bus_avg_rate")
    )
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_retailprice").alias("retailprice"),
        F.col("p_size").alias("size"),
    )
    return _with_means(p, per, "business_id", rated, unseen)


def _with_means(
    rows: DataFrame, per: DataFrame, key: str, rated: DataFrame, unseen: bool
) -> DataFrame:
    if not unseen:
        return rows.join(per, key)
    _, count, mean = per.columns
    overall = rated.agg(F.avg("stars")).first()[0] or 0.0
    return rows.join(per, key, "left").na.fill({count: 0, mean: float(overall)})
