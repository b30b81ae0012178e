"""Counts, top-k reports and category averages over reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as T


def review_count(reviews: DataFrame) -> DataFrame:
    return reviews.agg(F.count(F.lit(1)).alias("n_reviews"))


def year_predicate(date: Column, year: int) -> Column:
    """A half-open range, so that it reaches the scan and prunes row groups."""
    return (date >= F.lit(f"{year}-01-01").cast("date")) & (
        date < F.lit(f"{year + 1}-01-01").cast("date")
    )


def year_count(reviews: DataFrame, year: int) -> DataFrame:
    return reviews.where(year_predicate(F.col("date"), year)).agg(
        F.count(F.lit(1)).alias("n_reviews")
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.countDistinct(key).alias("n_distinct"))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def keys_over(df: DataFrame, key: str, threshold: int) -> DataFrame:
    """Keys with strictly more than `threshold` rows."""
    return key_counts(df, key).where(F.col("n") > threshold)


def top_by(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """The k rows with the greatest value, ties by name, with a rank. Ranks run over k rows."""
    best = df.orderBy(F.desc(value), F.asc(name)).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc(value), F.asc(name)))
    return best.withColumn("rank", rank)


def top_keys(df: DataFrame, key: str, m: int) -> DataFrame:
    return top_by(key_counts(df, key), "n", key, m)


def word_counts(df: DataFrame, text: str, stop_words: DataFrame) -> DataFrame:
    """Words are counted first; stop words then leave a table of distinct words."""
    tokens = df.select(F.explode(T.words(T.strip_punctuation(F.col(text)))).alias("word"))
    counts = tokens.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(stop_words.select("word"), "word", "left_anti")


def top_words(df: DataFrame, text: str, stop_words: DataFrame, n: int) -> DataFrame:
    return top_by(word_counts(df, text, stop_words), "n", "word", n)


def category_avg(reviews: DataFrame, business: DataFrame) -> DataFrame:
    """Mean stars per category.

    Stars are summed per business before the join, so a business with a large share of the
    reviews is one row when it meets its categories.
    """
    per_business = reviews.groupBy("business_id").agg(
        F.sum("stars").alias("total"), F.count("stars").alias("n")
    )
    cats = business.where(F.col("categories").isNotNull()).select(
        "business_id", F.explode(T.categories(F.col("categories"))).alias("category")
    )
    return (
        per_business.join(cats, "business_id")
        .groupBy("category")
        .agg((F.sum("total") / F.sum("n")).alias("avg_stars"))
    )


def top_categories(reviews: DataFrame, business: DataFrame, n: int) -> DataFrame:
    return top_by(category_avg(reviews, business), "avg_stars", "category", n)
