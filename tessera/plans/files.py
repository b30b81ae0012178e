"""Queries that send given tables through a sink into the shared folder and read them back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import graph as gr, itemsets as it, pairs
from ..session import shared_dir
from ..sources import readers, views as vw, writers
from . import queries as q


def _path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a folder of text files, in the order of their names. Lines are numbered
    within their file, and the files by one count each."""
    lines = spark.read.text(path, wholetext=False).select(
        F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("id"), "value"
    )
    counts = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("file").orderBy("id")
    return lines.withColumn("no", F.row_number().over(inside)).join(starts, "file").select(
        (F.col("start") + F.col("no")).alias("line_no"), "value"
    )


def file_json_reviews(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "reviews")
    text = F.concat_ws(" ", F.lit("order"), F.col("order_key").cast("string"), F.lit("line"), F.col("line_no").cast("string"))
    rows = vw.reviews(spark, d).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("business_id").cast("string").alias("business_id"),
        "stars",
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
        text.alias("text"),
    )
    writers.write_json_lines(rows, path)
    return readers.read_reviews(spark, path).where("_corrupt_record is null").drop("_corrupt_record")


def file_json_business(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "business")
    rows = vw.business(spark, d).withColumn("business_id", F.col("business_id").cast("string"))
    writers.write_json_lines(rows, path)
    return readers.read_business(spark, path).select("business_id", "categories")


def file_json_users(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "users")
    c = vw.table(spark, d, "customer")
    rows = c.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_nationkey").cast("bigint").alias("fans"),
        F.length("c_name").cast("bigint").alias("review_count"),
        F.col("c_acctbal").alias("average_stars"),
    )
    writers.write_json_lines(rows, path)
    return readers.read_users(spark, path).drop("_corrupt_record")


def file_csv_interactions(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "interactions")
    vw.user_items(spark, d).distinct().write.option("header", True).csv(path)
    return readers.read_interactions(spark, path)


def file_point_chunks(spark: SparkSession, d: str) -> DataFrame:
    """One folder of point files per round, taken in the order of their names."""
    path = _path(spark, "chunks")
    write_chunks(vw.points(spark, d), path)
    out = None
    for rnd, chunk in enumerate(readers.read_chunks(spark, path), 1):
        x = [F.round(F.col("features")[j], 6).alias(f"f{j}") for j in range(3)]
        one = chunk.select(F.lit(rnd).alias("round_id"), F.col("point_id").cast("bigint").alias("point_id"), *x)
        out = one if out is None else out.unionByName(one)
    return out


def write_chunks(points: DataFrame, path: str) -> None:
    """Point lines in one folder per chunk, of as many files as there are tasks."""
    line = F.concat_ws(",", F.col("point_id").cast("string"), F.col("features").cast("array<string>"))
    name = F.format_string("%04d", F.col("chunk"))
    points.select(name.alias("chunk"), line.alias("value")).write.partitionBy("chunk").text(path)


def file_stop_words(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "words")
    vw.table(spark, d, "nation").select(F.concat("n_name", F.lit("  ")).alias("value")).write.text(path)
    return readers.read_stop_words(spark, path)


def file_pair_model(spark: SparkSession, d: str) -> DataFrame:
    """Similar pairs as JSON lines, the larger name first, and read as a model."""
    path = _path(spark, "model")
    found = pairs.jaccard_pairs(vw.user_items(spark, d), "business_id", "user_id", q.JACCARD)
    rows = found.select(F.col("b2").cast("string").alias("b1"), F.col("b1").cast("string").alias("b2"), "sim")
    writers.write_json_lines(rows, path)
    return readers.read_pair_model(spark, path).withColumn("sim", F.round("sim", 6))


def file_report(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "report")
    counts = vw.reviews(spark, d).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("u")).first()
    top = [[r["user_id"], r["n"]] for r in q.top_users(spark, d).orderBy("rank").collect()]
    writers.write_report(spark, {"n_review": counts["n"], "n_user": counts["u"], "top10_user": top}, path)
    text = spark.read.text(path, wholetext=True)
    found = F.from_json("value", "n_review bigint, n_user bigint, top10_user array<array<bigint>>").alias("j")
    return text.select(found).select("j.n_review", "j.n_user", F.posexplode("j.top10_user").alias("pos", "t")).select(
        "n_review", "n_user", (F.col("pos") + 1).alias("rank"), F.col("t")[0].alias("user_id"), F.col("t")[1].alias("n")
    )


def file_round_metrics(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "metrics")
    kind = lambda k: F.sum((F.col("kind") == k).cast("bigint"))
    groups = lambda k: F.countDistinct(F.when(F.col("kind") == k, F.col("centre")))
    rows = vw.points(spark, d).groupBy((F.col("chunk") + 1).alias("round_id")).agg(
        groups("core").alias("nof_cluster_discard"),
        kind("core").alias("nof_point_discard"),
        groups("mini").alias("nof_cluster_compression"),
        kind("mini").alias("nof_point_compression"),
        kind("scatter").alias("nof_point_retained"),
    )
    writers.write_round_metrics(rows, path)
    return numbered_lines(spark, path)


def file_cluster_map(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "map")
    writers.write_cluster_map(vw.points(spark, d).withColumnRenamed("centre", "cluster"), path)
    return spark.read.schema("point_id bigint, cluster int").json(path)


def file_betweenness_lines(spark: SparkSession, d: str) -> DataFrame:
    """Scored edges as text lines, by score and then by name."""
    path = _path(spark, "betweenness")
    edges = pairs.shared_counts(vw.event_hours(spark, d), "user_id", "hour", q.HOUR_THRESHOLD)
    scored = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("n").cast("double").alias("score"))
    writers.write_betweenness(scored, path)
    return numbered_lines(spark, path)


def file_community_lines(spark: SparkSession, d: str) -> DataFrame:
    """Customers of a nation as one community and line, the smallest first."""
    path = _path(spark, "communities")
    members = vw.table(spark, d, "customer").select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("community"))
    writers.write_communities(members, path)
    # The parts in name order are one text; a line may go on in the next part.
    parts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    whole = parts.agg(F.array_sort(F.collect_list(F.struct("file", "value"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["value"]), "")
    lines = whole.select(F.posexplode(F.split(text, "\n")).alias("pos", "value"))
    return lines.select((F.col("pos") + 1).cast("bigint").alias("line_no"), "value").where("value <> ''")


def file_itemset_lines(spark: SparkSession, d: str) -> DataFrame:
    """Frequent sets written in the order of their length and items."""
    path = _path(spark, "itemsets")
    rows = q._type_baskets(spark, d)
    found = it.frequent_itemsets(rows, it.support_for(rows, q.TYPE_SUPPORT))
    groups = writers.itemset_groups(found)
    writers.write_json_lines(groups, path)
    parsed = F.from_json("value", "length int, items array<string>, support bigint").alias("j")
    lines = numbered_lines(spark, path).select("line_no", parsed)
    return lines.select("line_no", "j.length", F.array_join("j.items", "|").alias("itemset"), "j.support")


def edge_max(spark: SparkSession, d: str) -> DataFrame:
    """The heaviest edges: all with the greatest number of shared hours."""
    edges = pairs.shared_counts(vw.event_hours(spark, d), "user_id", "hour", q.HOUR_THRESHOLD)
    top = edges.agg(F.max("n").alias("top"))
    return edges.join(F.broadcast(top), F.col("n") == F.col("top")).select(F.col("a").alias("src"), F.col("b").alias("dst"), "n")


def retained_union(spark: SparkSession, d: str) -> DataFrame:
    """Scatter of all chunks, each appended to what was kept before, with the round it came in."""
    pts = vw.points(spark, d).where("kind = 'scatter'")
    kept = None
    for c in range(q.N_CHUNKS):
        fresh = pts.where(F.col("chunk") == c).select("point_id", F.lit(c + 1).alias("round_id"))
        kept = fresh if kept is None else kept.unionByName(fresh)
    return kept


REGISTRY = {
    f.__name__: f
    for f in (
        file_json_reviews,
        file_json_business,
        file_json_users,
        file_csv_interactions,
        file_point_chunks,
        file_stop_words,
        file_pair_model,
        file_report,
        file_round_metrics,
        file_cluster_map,
        file_betweenness_lines,
        file_community_lines,
        file_itemset_lines,
        edge_max,
        retained_union,
    )
}


def oracle() -> dict[str, str]:
    from . import oracle as o

    shared_hours = f"""WITH had AS (SELECT DISTINCT user_id AS u, date_trunc('hour', ts) AS h FROM events),
edges AS (SELECT x.u AS src, y.u AS dst, count(*) AS n FROM had x JOIN had y ON x.h = y.h AND x.u < y.u
          GROUP BY 1, 2 HAVING count(*) >= {q.HOUR_THRESHOLD})"""
    itemsets = o._itemsets(o._order_baskets("p_type"), q.TYPE_SUPPORT, 5)
    return {
        "file_json_reviews": f"""WITH {o.REVIEWS}
SELECT user_id::VARCHAR AS user_id, business_id::VARCHAR AS business_id, stars, date::DATE AS date,
       'order ' || order_key || ' line ' || line_no AS text FROM reviews""",
        "file_json_business": f"WITH {o.BUSINESS} SELECT business_id::VARCHAR AS business_id, categories FROM business",
        "file_json_users": """SELECT c_custkey::VARCHAR AS user_id, c_nationkey::BIGINT AS fans,
  length(c_name) AS review_count, c_acctbal AS average_stars FROM customer""",
        "file_csv_interactions": f"""WITH {o.REVIEWS}
SELECT DISTINCT user_id::VARCHAR AS user_id, business_id::VARCHAR AS business_id FROM reviews""",
        "file_point_chunks": f"""WITH {o._points()}
SELECT (point_id // 5) % 5 + 1 AS round_id, point_id, round(f0, 6) AS f0, round(f1, 6) AS f1, round(f2, 6) AS f2
FROM points""",
        "file_stop_words": "SELECT n_name AS word FROM nation UNION SELECT ''",
        "file_pair_model": f"""WITH {o.MEMBERS}, pairs AS (
  SELECT DISTINCT x.business_id AS b1, y.business_id AS b2 FROM members x
  JOIN members y ON x.user_id = y.user_id AND x.business_id < y.business_id),
found AS ({o._verified('pairs')})
SELECT least(b1::VARCHAR, b2::VARCHAR) AS b1, greatest(b1::VARCHAR, b2::VARCHAR) AS b2, sim FROM found""",
        "file_report": f"""WITH {o.REVIEWS},
c AS (SELECT user_id, count(*) AS n FROM reviews GROUP BY 1),
t AS (SELECT count(*) AS n_review, count(DISTINCT user_id) AS n_user FROM reviews)
SELECT n_review, n_user, row_number() OVER (ORDER BY n DESC, user_id) AS rank, user_id, n FROM c, t
ORDER BY n DESC, user_id LIMIT {q.TOP}""",
        "file_round_metrics": f"""WITH {o._points()},
m AS (SELECT (point_id // 5) % 5 + 1 AS r,
  count(DISTINCT CASE WHEN kind = 'core' THEN centre END) || ',' || count(*) FILTER (kind = 'core') || ',' ||
  count(DISTINCT CASE WHEN kind = 'mini' THEN centre END) || ',' || count(*) FILTER (kind = 'mini') || ',' ||
  count(*) FILTER (kind = 'scatter') AS v FROM points GROUP BY 1)
SELECT 1 AS line_no, '{",".join(writers.METRIC_COLUMNS)}' AS value
UNION ALL SELECT 1 + row_number() OVER (ORDER BY r), r || ',' || v FROM m""",
        "file_cluster_map": "SELECT o_orderkey AS point_id, (o_orderkey % 5)::INTEGER AS cluster FROM orders",
        "file_betweenness_lines": f"""{shared_hours}
SELECT row_number() OVER (ORDER BY n DESC, src, dst) AS line_no,
       '(''' || src || ''', ''' || dst || '''), ' || n::DOUBLE AS value FROM edges""",
        "file_community_lines": """WITH m AS (SELECT c_nationkey AS c, c_custkey::VARCHAR AS node FROM customer),
g AS (SELECT count(*) AS size, min(node) AS head, string_agg('''' || node || '''', ', ' ORDER BY node) AS value FROM m GROUP BY c)
SELECT row_number() OVER (ORDER BY size, '''' || head || '''') AS line_no, value FROM g""",
        "file_itemset_lines": f"""SELECT row_number() OVER (ORDER BY length, string_split(itemset, '|')) AS line_no,
  length, itemset, support FROM ({itemsets})""",
        "edge_max": f"{shared_hours} SELECT src, dst, n FROM edges WHERE n = (SELECT max(n) FROM edges)",
        "retained_union": f"""WITH {o._points()}
SELECT point_id, (point_id // 5) % 5 + 1 AS round_id FROM points WHERE kind = 'scatter'""",
    }
