"""Item-based collaborative filtering: Pearson model, prediction, blend with averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .pairs import Skew, pair_sums, shared_counts


def ratings(reviews: DataFrame) -> DataFrame:
    """One row per (user, item): the greatest (date, order_key, line_no, stars) wins."""
    latest = F.max(F.struct("date", "order_key", "line_no", "stars"))
    return (
        reviews.groupBy("user_id", "business_id")
        .agg(latest.alias("last"))
        .select("user_id", "business_id", F.col("last.stars").alias("stars"))
    )


def corated_pairs(rated: DataFrame, min_corated: int, skew: Skew | None = None) -> DataFrame:
    """(b1, b2, n): items with at least `min_corated` users in common."""
    return shared_counts(rated, "business_id", "user_id", min_corated, skew).select(
        F.col("a").alias("b1"), F.col("b").alias("b2"), "n"
    )


# Below this share of its sum of squares a variance is rounding, and so is a weight below the other.
NO_SPREAD, NO_WEIGHT = 1e-10, 1e-12


def _level(value: str) -> Column:
    """The mean, rounded to the power of two below the standard deviation; of equal values, the value.
    Where some values are null, the plain mean: sums of pairs leave nulls out that their counts have."""
    spread = F.stddev_pop(value)
    step = F.pow(F.lit(2.0), F.floor(F.log2(spread)))
    near = F.when(spread > 0, F.rint(F.avg(value) / step) * step).otherwise(F.min(value))
    return F.when(F.count(value) < F.count(F.lit(1)), F.avg(value)).otherwise(near)


def pearson_model(rated: DataFrame, min_corated: int, skew: Skew | None = None) -> DataFrame:
    """(b1, b2, sim): positive Pearson correlation over the users both items share.

    Sums are taken of the stars' distance from the item's level, so no digits are lost on it. The level is a
    short binary fraction: sums of whole and half stars stay exact, and equal correlations are equal numbers.
    Items whose shared stars are all the same have no correlation, with whole stars and others.
    """
    levels = rated.groupBy("business_id").agg(_level("stars").alias("_level"))
    centred = rated.join(levels, "business_id").select("business_id", "user_id", (F.col("stars") - F.col("_level")).alias("stars"))
    sums = pair_sums(centred, "business_id", "user_id", min_corated, "stars", skew).where(
        F.col("n") >= min_corated
    )
    c = F.col
    num = c("n") * c("sxy") - c("sx") * c("sy")
    va = c("n") * c("sxx") - c("sx") * c("sx")
    vb = c("n") * c("syy") - c("sy") * c("sy")
    spread = (va > NO_SPREAD * c("n") * c("sxx")) & (vb > NO_SPREAD * c("n") * c("syy"))
    sim = F.least(num / F.sqrt(va * vb), F.lit(1.0))
    return sums.where(spread).select(c("a").alias("b1"), c("b").alias("b2"), sim.alias("sim")).where(c("sim") > NO_WEIGHT)


def averages(rated: DataFrame, key: str) -> DataFrame:
    return rated.groupBy(key).agg(F.avg("stars").alias("avg_stars"))


def _global_mean(rated: DataFrame) -> Column:
    return rated.agg(F.avg("stars")).scalar()


def neighbours(wanted: DataFrame, rated: DataFrame, model: DataFrame) -> DataFrame:
    """(user_id, business_id, neighbour, sim, stars): rated items the model ties to the wanted one.

    A wanted pair can start from the user's ratings or from the item's model rows. Each takes the
    shorter list, so neither a user nor an item with a great share of the rows is multiplied out
    against the wanted pairs it takes part in.
    """
    both_ways = model.select(
        F.col("b1").alias("business_id"), F.col("b2").alias("neighbour"), "sim"
    ).unionByName(
        model.select(F.col("b2").alias("business_id"), F.col("b1").alias("neighbour"), "sim")
    )
    n_rated = rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rated"))
    n_tied = both_ways.groupBy("business_id").agg(F.count(F.lit(1)).alias("n_tied"))
    # A pair without ratings or without model rows has no neighbours and leaves here.
    routed = wanted.join(n_rated, "user_id").join(n_tied, "business_id")
    by_user = F.col("n_rated") <= F.col("n_tied")
    had = rated.select("user_id", F.col("business_id").alias("neighbour"), "stars")
    from_user = (
        routed.where(by_user)
        .select("user_id", "business_id")
        .join(had, "user_id")
        .join(both_ways, ["business_id", "neighbour"])
    )
    from_item = (
        routed.where(~by_user)
        .select("user_id", "business_id")
        .join(both_ways, "business_id")
        .join(had, ["user_id", "neighbour"])
    )
    cols = ["user_id", "business_id", "neighbour", "sim", "stars"]
    return from_user.select(*cols).unionByName(from_item.select(*cols))


def top_neighbours(near: DataFrame, n: int) -> DataFrame:
    """The n most similar neighbours of each wanted pair, ties by neighbour id."""
    w = Window.partitionBy("user_id", "business_id").orderBy(F.desc("sim"), F.asc("neighbour"))
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def predict(wanted: DataFrame, rated: DataFrame, model: DataFrame, n: int = 3) -> DataFrame:
    """(user_id, business_id, stars) for every distinct wanted pair.

    Weighted mean over the top-n neighbours; without any, the user's mean; for a user without
    ratings, the mean of all ratings.
    """
    wanted = wanted.select("user_id", "business_id").distinct()
    best = top_neighbours(neighbours(wanted, rated, model), n)
    weighted = best.groupBy("user_id", "business_id").agg(
        (F.sum(F.col("stars") * F.col("sim")) / F.nullif(F.sum("sim"), F.lit(0.0))).alias("cf")
    )
    user_mean = averages(rated, "user_id").withColumnRenamed("avg_stars", "user_mean")
    return (
        wanted.join(weighted, ["user_id", "business_id"], "left")
        .join(user_mean, "user_id", "left")
        .select(
            "user_id",
            "business_id",
            F.coalesce("cf", "user_mean", _global_mean(rated)).alias("stars"),
        )
    )


def blend(predicted: DataFrame, rated: DataFrame) -> DataFrame:
    """Mean of user mean, item mean and prediction; unknown users and items use the overall mean."""
    user_mean = averages(rated, "user_id").withColumnRenamed("avg_stars", "user_mean")
    item_mean = averages(rated, "business_id").withColumnRenamed("avg_stars", "item_mean")
    overall = _global_mean(rated)
    return (
        predicted.join(user_mean, "user_id", "left")
        .join(item_mean, "business_id", "left")
        .select(
            "user_id",
            "business_id",
            (
                (F.coalesce("user_mean", overall) + F.coalesce("item_mean", overall) + F.col("stars"))
                / 3
            ).alias("stars"),
        )
    )
