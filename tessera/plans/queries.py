"""The registered queries: every callable takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.hashing import coefficients, id_bin
from ..operators import betweenness as bt
from ..operators import cf, clustering as cl, dictionary as dc, explore as ex, graph as gr
from ..operators import itemsets as it, lsh, pairs, partitions as pt, prefix_join, regression as rg
from ..session import checkpointed, shared_dir, stored
from ..sources import views as vw
from ..sources.readers import read_points
from ..sources.writers import write_model
from ..streaming.bfr_stream import run_rounds

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL side.
YEAR = 1998
TOP = 10
STOP_WORDS = ("the", "a", "an", "and", "of", "to", "in", "is", "de", "la", "und", "der")
REVIEW_THRESHOLD = 40
N_PARTITIONS = 10
MIN_BASKET = 45
MIN_BRANDS = 3
TYPE_SUPPORT = 0.115
BRAND_SUPPORT = 0.01
SON_CHUNKS = 4
BANDS, ROWS, JACCARD = 50, 2, 0.1
DOC_BANDS, DOC_ROWS, DOC_JACCARD = 32, 4, 0.7
MIN_CORATED = 3
NEIGHBOURS = 3
EDGE_THRESHOLD = 7
SMALL_EDGE_THRESHOLD = 8
HOUR_THRESHOLD = 12
LPA_ROUNDS = 5
BLOCK_THRESHOLD = 16
SPARSE_BLOCK_THRESHOLD = 22
BLOCK_JACCARD = 0.2
HOT_SHARED = 7
N_CLUSTER, N_CHUNKS, ALPHA = 5, 5, 3.0
MERGE_THRESHOLD = 15.0
# Takes points far from zero, where sums of squares lose all digits of a spread.
SHIFT = 1e8
NUM_BINS = 1000
FOLDS = 5


def _r(col: Column | str, digits: int = 6) -> Column:
    return F.round(col, digits)


# -- exploration ----------------------------------------------------------------------------


def review_count(spark: SparkSession, d: str) -> DataFrame:
    return ex.review_count(vw.reviews(spark, d))


def year_count(spark: SparkSession, d: str) -> DataFrame:
    return ex.year_count(vw.reviews(spark, d), YEAR)


def distinct_users(spark: SparkSession, d: str) -> DataFrame:
    return ex.distinct_keys(vw.reviews(spark, d), "user_id")


def top_users(spark: SparkSession, d: str) -> DataFrame:
    return ex.top_keys(vw.reviews(spark, d), "user_id", TOP)


def top_words(spark: SparkSession, d: str) -> DataFrame:
    stop = spark.createDataFrame([(w,) for w in ("", *STOP_WORDS)], "word string")
    return ex.top_words(vw.documents(spark, d), "text", stop, TOP)


def category_avg(spark: SparkSession, d: str) -> DataFrame:
    avg = ex.category_avg(vw.reviews(spark, d), vw.business(spark, d))
    return avg.select("category", _r("avg_stars").alias("avg_stars"))


def top_categories(spark: SparkSession, d: str) -> DataFrame:
    top = ex.top_categories(vw.reviews(spark, d), vw.business(spark, d), TOP)
    return top.select("category", _r("avg_stars").alias("avg_stars"), "rank")


def keys_over_threshold(spark: SparkSession, d: str) -> DataFrame:
    return ex.keys_over(vw.reviews(spark, d), "business_id", REVIEW_THRESHOLD)


def user_averages(spark: SparkSession, d: str) -> DataFrame:
    avg = cf.averages(cf.ratings(vw.reviews(spark, d)), "user_id")
    return avg.select("user_id", _r("avg_stars").alias("avg_stars"))


def item_averages(spark: SparkSession, d: str) -> DataFrame:
    avg = cf.averages(cf.ratings(vw.reviews(spark, d)), "business_id")
    return avg.select("business_id", _r("avg_stars").alias("avg_stars"))


def partition_profile_keyed(spark: SparkSession, d: str) -> DataFrame:
    return pt.keyed_profile(vw.reviews(spark, d), "business_id", N_PARTITIONS)


def partition_profile_default(spark: SparkSession, d: str) -> DataFrame:
    return pt.default_profile(vw.table(spark, d, "lineitem").select("l_partkey"))


# -- itemsets -------------------------------------------------------------------------------


def baskets_all(spark: SparkSession, d: str) -> DataFrame:
    return it.baskets(vw.user_items(spark, d), "user_id", "business_id")


def baskets_by_user(spark: SparkSession, d: str) -> DataFrame:
    return it.baskets(vw.user_items(spark, d), "user_id", "business_id", MIN_BASKET)


def baskets_by_item(spark: SparkSession, d: str) -> DataFrame:
    return it.baskets(vw.user_items(spark, d), "business_id", "user_id", MIN_BASKET)


def _type_baskets(spark: SparkSession, d: str) -> DataFrame:
    return checkpointed(it.baskets(vw.order_items(spark, d, "p_type"), "basket_id", "item"))


def _flat(sets: DataFrame, *more: str) -> DataFrame:
    return sets.select(
        F.size("items").alias("length"), F.array_join("items", "|").alias("itemset"), *more
    )


def frequent_itemsets(spark: SparkSession, d: str) -> DataFrame:
    rows = _type_baskets(spark, d)
    return _flat(it.frequent_itemsets(rows, it.support_for(rows, TYPE_SUPPORT)), "support")


def frequent_itemsets_min_basket(spark: SparkSession, d: str) -> DataFrame:
    brands = vw.order_items(spark, d, "p_brand")
    rows = checkpointed(it.baskets(brands, "basket_id", "item", MIN_BRANDS))
    return _flat(it.frequent_itemsets(rows, it.support_for(rows, BRAND_SUPPORT)), "support")


def son_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = _type_baskets(spark, d)
    return _flat(it.son_candidates(rows, it.support_for(rows, TYPE_SUPPORT), SON_CHUNKS))


def son_itemsets(spark: SparkSession, d: str) -> DataFrame:
    rows = _type_baskets(spark, d)
    return _flat(it.son_itemsets(rows, it.support_for(rows, TYPE_SUPPORT), SON_CHUNKS), "support")


# -- similarity -----------------------------------------------------------------------------


def _signatures(spark: SparkSession, d: str) -> DataFrame:
    members = vw.user_items(spark, d).distinct()
    return lsh.signatures(members, "business_id", "user_id", coefficients(BANDS * ROWS))


def minhash_signatures(spark: SparkSession, d: str) -> DataFrame:
    return _signatures(spark, d).select(
        F.col("id").alias("business_id"),
        F.col("size").alias("n_members"),
        F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"),
    )


def lsh_candidates(spark: SparkSession, d: str) -> DataFrame:
    banded = lsh.bands(checkpointed(_signatures(spark, d)), BANDS, ROWS)
    return lsh.candidate_pairs(banded).select(F.col("a").alias("b1"), F.col("b").alias("b2"))


def similar_pairs(spark: SparkSession, d: str) -> DataFrame:
    found = lsh.similar_pairs(
        vw.user_items(spark, d), "business_id", "user_id", JACCARD, BANDS, ROWS
    )
    return found.withColumn("sim", _r("sim"))


def jaccard_pairs_exact(spark: SparkSession, d: str) -> DataFrame:
    found = prefix_join.jaccard_pairs(vw.user_items(spark, d), "business_id", "user_id", JACCARD)
    return found.withColumn("sim", _r("sim"))


def near_duplicate_documents(spark: SparkSession, d: str) -> DataFrame:
    found = lsh.similar_pairs(
        vw.doc_shingles(spark, d),
        "doc_id",
        "shingle",
        DOC_JACCARD,
        DOC_BANDS,
        DOC_ROWS,
        copies="link",
    )
    return found.withColumn("sim", _r("sim"))


def similar_documents_exact(spark: SparkSession, d: str) -> DataFrame:
    """What `near_duplicate_documents` looks for, complete by construction."""
    found = prefix_join.similar_arrays(vw.doc_shingle_sets(spark, d), "doc_id", "shingles", DOC_JACCARD)
    return found.withColumn("sim", _r("sim"))


# -- collaborative filtering ----------------------------------------------------------------


def corated_pairs_all(spark: SparkSession, d: str) -> DataFrame:
    return cf.corated_pairs(cf.ratings(vw.reviews(spark, d)), MIN_CORATED)


def pearson_weights_all(spark: SparkSession, d: str) -> DataFrame:
    model = cf.pearson_model(cf.ratings(vw.reviews(spark, d)), MIN_CORATED)
    return model.withColumn("sim", _r("sim"))


def hot_shared_keys(spark: SparkSession, d: str) -> DataFrame:
    """Orders that share many keys, of which some are held by half of all orders."""
    return pairs.shared_counts(vw.order_keys(spark, d), "order_id", "key", HOT_SHARED)


def corated_pairs(spark: SparkSession, d: str) -> DataFrame:
    return cf.corated_pairs(cf.ratings(vw.train_reviews(spark, d)), MIN_CORATED)


def pearson_weights(spark: SparkSession, d: str) -> DataFrame:
    model = cf.pearson_model(cf.ratings(vw.train_reviews(spark, d)), MIN_CORATED)
    return model.withColumn("sim", _r("sim"))


def _predicted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rated = checkpointed(cf.ratings(vw.train_reviews(spark, d)))
    # Building and predicting are two steps with the model as a table between them.
    path = os.path.join(shared_dir(spark), f"model-{uuid.uuid4().hex}")
    write_model(cf.pearson_model(rated, MIN_CORATED), path)
    model = spark.read.parquet(path)
    return cf.predict(vw.test_reviews(spark, d), rated, model, NEIGHBOURS), rated


def cf_predict(spark: SparkSession, d: str) -> DataFrame:
    return _predicted(spark, d)[0].withColumn("stars", _r("stars"))


def cf_blend(spark: SparkSession, d: str) -> DataFrame:
    return cf.blend(*_predicted(spark, d)).withColumn("stars", _r("stars"))


def cf_rmse(spark: SparkSession, d: str) -> DataFrame:
    actual = cf.ratings(vw.test_reviews(spark, d)).withColumnRenamed("stars", "actual")
    both = _predicted(spark, d)[0].join(actual, ["user_id", "business_id"])
    return rg.rmse(both, "actual", "stars").withColumn("rmse", _r("rmse"))


# -- graph ----------------------------------------------------------------------------------


def _customer_edges(spark: SparkSession, d: str, threshold: int) -> DataFrame:
    # A line has one order, so there are about as many rows as lines; that count takes the files' footers only.
    lines = vw.table(spark, d, "lineitem").count()
    return gr.corating_edges(vw.user_items(spark, d), "user_id", "business_id", threshold, rows=lines)


def corating_edges(spark: SparkSession, d: str) -> DataFrame:
    return _customer_edges(spark, d, EDGE_THRESHOLD)


def corating_vertices(spark: SparkSession, d: str) -> DataFrame:
    return gr.vertices(_customer_edges(spark, d, EDGE_THRESHOLD))


def label_propagation(spark: SparkSession, d: str) -> DataFrame:
    edges = checkpointed(_customer_edges(spark, d, EDGE_THRESHOLD))
    return gr.label_propagation(edges, LPA_ROUNDS)


def label_communities(spark: SparkSession, d: str) -> DataFrame:
    return gr.community_sizes(gr.communities(label_propagation(spark, d)))


def connected_components(spark: SparkSession, d: str) -> DataFrame:
    return gr.connected_components(checkpointed(_customer_edges(spark, d, EDGE_THRESHOLD)))


def modularity(spark: SparkSession, d: str) -> DataFrame:
    edges = checkpointed(_customer_edges(spark, d, EDGE_THRESHOLD))
    parts = gr.connected_components(edges).withColumnRenamed("component", "community")
    newman = gr.modularity(edges, parts).select(
        F.lit("newman").alias("formula"), _r("modularity", 9).alias("modularity")
    )
    legacy = gr.modularity(edges, parts, "legacy").select(
        F.lit("legacy").alias("formula"), _r("modularity", 9).alias("modularity")
    )
    return newman.unionByName(legacy)


def _block_edges(spark: SparkSession, d: str, threshold: int = BLOCK_THRESHOLD) -> DataFrame:
    return gr.corating_edges(vw.block_items(spark, d), "user_id", "item", threshold)


def block_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of a graph whose degrees do not depend on the scale."""
    return _block_edges(spark, d)


def block_label_propagation(spark: SparkSession, d: str) -> DataFrame:
    return gr.label_propagation(checkpointed(_block_edges(spark, d)), LPA_ROUNDS)


def block_components(spark: SparkSession, d: str) -> DataFrame:
    return gr.connected_components(checkpointed(_block_edges(spark, d)))


def block_betweenness(spark: SparkSession, d: str) -> DataFrame:
    edges = checkpointed(_block_edges(spark, d))
    return bt.edge_betweenness(edges).withColumn("score", _r("score"))


def block_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    found = prefix_join.jaccard_pairs(vw.block_items(spark, d), "user_id", "item", BLOCK_JACCARD)
    return found.withColumn("sim", _r("sim"))


def edge_betweenness(spark: SparkSession, d: str) -> DataFrame:
    hours = vw.event_hours(spark, d)
    edges = checkpointed(gr.corating_edges(hours, "user_id", "hour", HOUR_THRESHOLD))
    return bt.edge_betweenness(edges).withColumn("score", _r("score"))


def girvan_newman(spark: SparkSession, d: str) -> DataFrame:
    return bt.girvan_newman(_customer_edges(spark, d, SMALL_EDGE_THRESHOLD))


def dense_ids(spark: SparkSession, d: str) -> DataFrame:
    return dc.dense_ids(vw.table(spark, d, "customer"), "c_name")


def coded_components(spark: SparkSession, d: str) -> DataFrame:
    """Components of a graph whose ids are text, worked on as numbers."""
    edges = _block_edges(spark, d, BLOCK_THRESHOLD)
    named = edges.select(*[F.concat(F.lit("u"), F.lpad(F.col(c).cast("string"), 12, "0")).alias(c) for c in ("src", "dst")])
    coded, names = dc.encoded_edges(checkpointed(named))
    return dc.decoded(gr.connected_components(coded), ["node", "component"], names)


# -- clustering -----------------------------------------------------------------------------


def _flat_stats(stats: DataFrame) -> DataFrame:
    dims = F.posexplode(F.arrays_zip("mean", "std")).alias("dim", "z")
    return stats.select("cluster", "n", dims).select(
        "cluster",
        "dim",
        "n",
        _r("z.mean").alias("mean"),
        _r("z.std").alias("std"),
    )


def cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    core = vw.points(spark, d).where("kind = 'core'")
    return _flat_stats(cl.cluster_stats(core, "centre"))


def cluster_stats_all(spark: SparkSession, d: str) -> DataFrame:
    return _flat_stats(cl.cluster_stats(vw.points(spark, d), "centre"))


def wide_cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    return _flat_stats(cl.cluster_stats(vw.wide_points(spark, d), "label"))


def _shifted(points: DataFrame) -> DataFrame:
    return points.withColumn("features", F.transform("features", lambda x: x + SHIFT))


def cluster_stats_shifted(spark: SparkSession, d: str) -> DataFrame:
    """Spread of points far from zero; the shift is taken off the means again."""
    stats = cl.cluster_stats(_shifted(vw.points(spark, d)), "centre")
    dims = F.posexplode(F.arrays_zip("mean", "std")).alias("dim", "z")
    return stats.select("cluster", "n", dims).select(
        "cluster", "dim", "n", _r(F.col("z.mean") - SHIFT, 3).alias("mean"), _r("z.std", 4).alias("std")
    )


def mahalanobis_assign_shifted(spark: SparkSession, d: str) -> DataFrame:
    """A shift of all points changes no assignment."""
    pts = _shifted(vw.points(spark, d))
    core = cl.Summary.of(cl.cluster_stats(pts.where("kind = 'core'"), "centre"))
    return cl.assign_nearest(pts, core, ALPHA * 3**0.5).select("point_id", "cluster")


def _small_groups(spark: SparkSession, d: str) -> DataFrame:
    """Summaries of groups of which several lie close together, scatter included."""
    grp = F.col("centre") * 6 + (F.col("point_id") % 3) * 2 + (F.col("kind") == "mini").cast("int")
    grp = F.when(F.col("kind") == "scatter", 30 + F.col("point_id") % 4).otherwise(grp)
    return checkpointed(cl.cluster_stats(vw.points(spark, d).withColumn("grp", grp.cast("int")), "grp"))


def cs_greedy_merges(spark: SparkSession, d: str) -> DataFrame:
    return cl.greedy_matching(cl.close_pairs(_small_groups(spark, d), MERGE_THRESHOLD))


def cs_merged_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = _small_groups(spark, d)
    return _flat_stats(cl.merged_stats(stats, cl.merged_clusters(stats, MERGE_THRESHOLD)))


def mahalanobis_assign(spark: SparkSession, d: str) -> DataFrame:
    pts = vw.points(spark, d)
    core = cl.Summary.of(cl.cluster_stats(pts.where("kind = 'core'"), "centre"))
    near = cl.assign_nearest(pts, core, ALPHA * 3**0.5)
    return near.select("point_id", "cluster", _r("distance", 5).alias("distance"))


def cs_merge_pairs(spark: SparkSession, d: str) -> DataFrame:
    group = F.col("centre") * 2 + (F.col("kind") == "mini").cast("int")
    pts = vw.points(spark, d).where("kind <> 'scatter'").withColumn("grp", group)
    found = cl.close_pairs(checkpointed(cl.cluster_stats(pts, "grp")), MERGE_THRESHOLD)
    return found.select(
        F.col("first").cast("int").alias("first"),
        F.col("second").cast("int").alias("second"),
        _r("distance", 5).alias("distance"),
    )


def _bfr(spark: SparkSession) -> cl.Bfr:
    return cl.Bfr(spark, os.path.join(shared_dir(spark), f"bfr-{uuid.uuid4().hex}"), N_CLUSTER, ALPHA)


def _bfr_run(spark: SparkSession, d: str) -> tuple[cl.Bfr, cl.State]:
    bfr = _bfr(spark)
    pts = vw.points(spark, d)
    return bfr, bfr.run([pts.where(F.col("chunk") == c) for c in range(N_CHUNKS)])


def bfr_assign(spark: SparkSession, d: str) -> DataFrame:
    bfr, state = _bfr_run(spark, d)
    return bfr.labels(state)


def bfr_rounds(spark: SparkSession, d: str) -> DataFrame:
    bfr, state = _bfr_run(spark, d)
    return bfr.metrics(state)


def _round_folder(spark: SparkSession, d: str, folder: str) -> None:
    """The chunks as text files, a folder for each, written in one job."""
    line = F.concat_ws(",", F.col("point_id").cast("string"), F.col("features").cast("array<string>"))
    rows = vw.points(spark, d).select(F.col("chunk").alias("round"), line.alias("value"))
    rows.write.partitionBy("round").text(folder)


def bfr_stream_rounds(spark: SparkSession, d: str) -> DataFrame:
    """The chunks are written as text, one folder per round, and read back as a stream."""
    bfr = _bfr(spark)
    folder = f"{bfr.work_dir}/files"
    _round_folder(spark, d, folder)

    def numbered(session: SparkSession, path: str) -> DataFrame:
        # Ids are numbers, as in the batch form: the seed sample is a hash of them.
        return read_points(session, path).withColumn("point_id", F.col("point_id").cast("bigint"))

    return bfr.metrics(run_rounds(spark, folder, bfr, f"{bfr.work_dir}/stream", numbered))


# -- regression -----------------------------------------------------------------------------


def _frames(spark: SparkSession, d: str, keep: Callable[[DataFrame], DataFrame] = stored) -> tuple[DataFrame, DataFrame]:
    """Training rows with folds, and held-out rows. In training rows the mean stars of user and
    business leave out the row's fold; held-out rows without a match get the overall mean. Ratings are kept by `keep`."""
    # Read several times below, as rows and as profiles of both sides.
    fold = rg.fold_of(["user_id", "business_id"], FOLDS).alias("fold")
    rated = keep(cf.ratings(vw.train_reviews(spark, d)).select("*", fold))
    wanted = cf.ratings(vw.test_reviews(spark, d))
    users, business = vw.users(spark, d, rated), vw.business_profile(spark, d, rated)
    # The rows that find both sides. As a rule each rating does so once, and need not be dealt out for it.
    n_rated = rated.count()
    slim = rated
    if not all(_each_once(side, key, n, n_rated) for side, key, n in ((users, "user_id", "review_count_user"), (business, "business_id", "review_count_bus"))):
        slim = stored(rg.feature_frame(rated, users, business, NUM_BINS).select(*rated.columns))
    # Users' columns are joined where rows lie by user, those of a business where they lie by business.
    train = rg.out_of_fold_means(rated, "user_id", "fold", "stars", "user_avg_rate", slim)
    train = rg.feature_frame(train, users.drop("user_avg_rate"), business.drop("bus_avg_rate"), NUM_BINS)
    train = rg.out_of_fold_means(train, "business_id", "fold", "stars", "bus_avg_rate", slim)
    val = rg.feature_frame(
        wanted,
        vw.users(spark, d, rated, unseen=True),
        vw.business_profile(spark, d, rated, unseen=True),
        NUM_BINS,
    )
    return train, val


def _each_once(side: DataFrame, key: str, n_rows: str, n_rated: int) -> bool:
    """Whether each rating finds one row of the side."""
    seen = side.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("keys"), F.sum(n_rows).alias("rated")).first()
    return seen.n == seen.keys and seen.rated == n_rated


def unseen_rows(spark: SparkSession, d: str) -> DataFrame:
    """Held-out rows, and those whose user or business has no training rating."""
    _, val = _frames(spark, d)
    new = (F.col("review_count_user") == 0) | (F.col("review_count_bus") == 0)
    return val.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(new.cast("bigint")).alias("n_unseen"))


def id_bins(spark: SparkSession, d: str) -> DataFrame:
    c = vw.table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"), id_bin(F.col("c_custkey"), NUM_BINS).alias("user_bin")
    )


def feature_frame(spark: SparkSession, d: str) -> DataFrame:
    rated = checkpointed(cf.ratings(vw.train_reviews(spark, d)))
    users, business = vw.users(spark, d, rated), vw.business_profile(spark, d, rated)
    return (
        rg.feature_frame(rated, users, business, NUM_BINS)
        .withColumn("user_avg_rate", _r("user_avg_rate"))
        .withColumn("bus_avg_rate", _r("bus_avg_rate"))
    )


def linreg_rmse(spark: SparkSession, d: str) -> DataFrame:
    train, val = (stored(f) for f in _frames(spark, d))
    return rg.linear_regression(train, val, rg.FEATURES, "stars")[2]


def pca_linreg_cv(spark: SparkSession, d: str) -> DataFrame:
    train, val = (stored(f) for f in _frames(spark, d))
    return rg.pca_regression_grid(train, val, rg.FEATURES, "stars", "fold")


def nonneg_linreg(spark: SparkSession, d: str) -> DataFrame:
    train, val = (stored(f) for f in _frames(spark, d))
    w, b, error = rg.nonneg_regression(train, val, rg.FEATURES, "stars")
    rows = [("intercept", float(b)), *[(f, float(x)) for f, x in zip(rg.FEATURES, w)]]
    return spark.createDataFrame([*rows, ("rmse", error)], "term string, value double")


def linear_svr(spark: SparkSession, d: str) -> DataFrame:
    train, val = _frames(spark, d)
    return rg.linear_svr_grid(train, val, rg.FEATURES, "stars", "fold", FOLDS)


def rbf_svr(spark: SparkSession, d: str) -> DataFrame:
    train, val = (stored(f) for f in _frames(spark, d))
    return rg.rbf_svr_grid(train, val, rg.FEATURES, "stars", "fold", FOLDS)


def random_forest_cv(spark: SparkSession, d: str) -> DataFrame:
    # A forest draws by the places of rows, which a checkpoint keeps.
    train, val = _frames(spark, d, checkpointed)
    return rg.random_forest_grid(train, val, rg.FEATURES, "stars", "fold", FOLDS)


REGISTRY: dict[str, Query] = {
    f.__name__: f
    for f in (
        review_count,
        year_count,
        distinct_users,
        top_users,
        top_words,
        category_avg,
        top_categories,
        keys_over_threshold,
        user_averages,
        item_averages,
        partition_profile_keyed,
        partition_profile_default,
        baskets_all,
        baskets_by_user,
        baskets_by_item,
        frequent_itemsets,
        frequent_itemsets_min_basket,
        son_candidates,
        son_itemsets,
        minhash_signatures,
        lsh_candidates,
        similar_pairs,
        jaccard_pairs_exact,
        near_duplicate_documents,
        similar_documents_exact,
        corated_pairs,
        corated_pairs_all,
        pearson_weights,
        pearson_weights_all,
        hot_shared_keys,
        cf_predict,
        cf_blend,
        cf_rmse,
        corating_edges,
        corating_vertices,
        label_propagation,
        label_communities,
        connected_components,
        modularity,
        block_edges,
        block_label_propagation,
        block_components,
        block_betweenness,
        block_jaccard_pairs,
        edge_betweenness,
        girvan_newman,
        dense_ids,
        coded_components,
        cluster_stats,
        cluster_stats_all,
        wide_cluster_stats,
        cluster_stats_shifted,
        mahalanobis_assign,
        mahalanobis_assign_shifted,
        cs_merge_pairs,
        cs_greedy_merges,
        cs_merged_stats,
        bfr_assign,
        bfr_rounds,
        bfr_stream_rounds,
        id_bins,
        feature_frame,
        unseen_rows,
        linreg_rmse,
        pca_linreg_cv,
        nonneg_linreg,
        linear_svr,
        rbf_svr,
        random_forest_cv,
    )
}
