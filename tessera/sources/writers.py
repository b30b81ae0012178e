"""Sinks: JSON report, JSON lines, round metrics, cluster map, betweenness and community text."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_report(spark: SparkSession, report: Mapping[str, object], path: str) -> None:
    """One indented JSON document of bounded values (counts, top-k lists)."""
    text = json.dumps(report, indent=4)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_model(df: DataFrame, path: str) -> None:
    """The pair model between building and predicting, columnar."""
    df.select("b1", "b2", "sim").write.mode("overwrite").parquet(path)


# The columns of the round metrics file.
METRIC_COLUMNS = (
    "round_id",
    "nof_cluster_discard",
    "nof_point_discard",
    "nof_cluster_compression",
    "nof_point_compression",
    "nof_point_retained",
)


def write_round_metrics(df: DataFrame, path: str) -> None:
    df.select(*METRIC_COLUMNS).coalesce(1).orderBy("round_id").write.mode("overwrite").option(
        "header", True
    ).csv(path)


def write_cluster_map(df: DataFrame, path: str) -> None:
    df.select("point_id", "cluster").write.mode("overwrite").json(path)


def write_betweenness(df: DataFrame, path: str) -> None:
    """Lines "('a', 'b'), score", highest score first."""
    line = F.format_string(
        "('%s', '%s'), %s",
        F.col("src").cast("string"),
        F.col("dst").cast("string"),
        F.col("score").cast("string"),
    )
    df.orderBy(F.desc("score"), "src", "dst").select(line.alias("value")).write.mode(
        "overwrite"
    ).text(path)


def write_communities(members: DataFrame, path: str) -> None:
    """Lines "'a', 'b', 'c'", one per community, smallest community first.

    Input is (node, community). No community is gathered in one row: every member is a row of
    its own that ends in a quote mark, the quote mark is the record separator, and the text
    before a member says whether it opens a line. The part files in name order make the file.
    """
    m = members.select(F.col("node").cast("string").alias("node"), "community")
    per = m.groupBy("community").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("first")
    )
    opener = F.concat(F.lit("'"), "first", F.lit("'"))
    rows = m.join(per, "community").select(
        "size",
        opener.alias("line"),
        "node",
        (F.col("node") == F.col("first")).alias("opens"),
    )
    head = per.orderBy("size", opener).select(F.col("first").alias("node")).limit(1)
    rows = rows.join(
        head.withColumn("at_top", F.lit(True)), "node", "left"
    ).orderBy("size", "line", "node")
    before = (
        F.when(F.col("at_top"), "'").when(F.col("opens"), "\n'").otherwise(", '")
    )
    rows.select(F.concat(before, "node").alias("value")).write.mode("overwrite").option(
        "lineSep", "'"
    ).text(path)


def itemset_groups(itemsets: DataFrame) -> DataFrame:
    """(length, itemset, support) rows sorted by length, then by the sorted items."""
    return itemsets.select(
        F.size("items").alias("length"), F.array_sort("items").alias("items"), "support"
    ).orderBy("length", "items")
