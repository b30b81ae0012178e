"""Co-rating graph, label propagation, connected components and modularity.

A graph is a table of undirected edges (src, dst) with src < dst, each once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed
from .pairs import Skew, shared_counts


def corating_edges(
    df: DataFrame, node: str, shared: str, threshold: int, skew: Skew | None = None, rows: int | None = None
) -> DataFrame:
    """Edges between nodes that share at least `threshold` distinct values; `rows` as in `shared_counts`."""
    return shared_counts(df, node, shared, threshold, skew, rows).select(
        F.col("a").alias("src"), F.col("b").alias("dst")
    )


def both_directions(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )


def vertices(edges: DataFrame) -> DataFrame:
    """(id): endpoints of edges; isolated nodes are not part of the graph."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def label_propagation(edges: DataFrame, max_iter: int = 5) -> DataFrame:
    """(node, label) after synchronous rounds; a node takes its neighbours' most frequent label,
    the smallest one on a tie."""
    arcs = both_directions(edges)
    labels = vertices(edges).select(F.col("id").alias("node"), F.col("id").alias("label"))
    for _ in range(max_iter):
        votes = (
            arcs.join(labels, arcs.src == labels.node)
            .groupBy("dst", "label")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        best = F.min(F.struct((-F.col("n")).alias("n"), "label"))
        labels = checkpointed(
            votes.groupBy("dst")
            .agg(best.alias("best"))
            .select(F.col("dst").alias("node"), F.col("best.label").alias("label"))
        )
    return labels


def communities(labels: DataFrame, node: str = "node", label: str = "label") -> DataFrame:
    """(node, community): every community is named by its least member."""
    names = labels.groupBy(label).agg(F.min(node).alias("community"))
    return labels.join(names, label).select(F.col(node).alias("node"), "community")


def community_sizes(members: DataFrame) -> DataFrame:
    return (
        members.groupBy("community")
        .agg(F.count(F.lit(1)).alias("size"))
        .orderBy("size", "community")
    )


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, component): the component's least node.

    Alternates two rewirings until the edges stand still: every node's larger neighbours are tied
    to the least node of its neighbourhood, then its smaller ones are. The number of rounds
    grows with the logarithm of the path lengths, and a minimum per node is a plain aggregate.
    """
    current = checkpointed(edges.where(F.col("src") != F.col("dst")).distinct())
    before = None
    while True:
        current = checkpointed(_star(_star(current, larger=True), larger=False))
        seen = current.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("src", "dst")).alias("h1"),
            F.bit_xor(F.xxhash64("dst", "src")).alias("h2"),
        ).first()
        if seen == before:
            break
        before = seen
    # Every edge now leads from a component's least node to a member.
    members = current.select(F.col("dst").alias("node"), F.col("src").alias("component"))
    ids = vertices(edges) if nodes is None else nodes.select(F.col(nodes.columns[0]).alias("id"))
    return ids.join(members, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("node"), F.coalesce("component", "id").alias("component")
    )


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One rewiring; edges have src < dst before and after."""
    if larger:
        arcs = both_directions(edges).select(F.col("src").alias("v"), F.col("dst").alias("u"))
    else:
        arcs = edges.select(F.col("dst").alias("v"), F.col("src").alias("u"))
    least = arcs.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("low"))
    tied = arcs.join(least, "v")
    if larger:
        out = tied.where(F.col("u") > F.col("v")).select(
            F.col("low").alias("src"), F.col("u").alias("dst")
        )
    else:
        out = tied.select(F.col("low").alias("src"), F.col("u").alias("dst")).unionByName(
            least.select(F.col("low").alias("src"), F.col("v").alias("dst"))
        )
    return out.where(F.col("src") < F.col("dst")).distinct()


def community_terms(edges: DataFrame, members: DataFrame) -> DataFrame:
    """(community, inner, degree): twice the inner edges, and the degree sum of the members."""
    m = members.select("node", "community")
    ends = both_directions(edges).join(
        m.select(F.col("node").alias("src"), F.col("community").alias("cs")), "src"
    )
    ends = ends.join(m.select(F.col("node").alias("dst"), F.col("community").alias("cd")), "dst")
    return ends.groupBy(F.col("cs").alias("community")).agg(
        F.sum((F.col("cs") == F.col("cd")).cast("bigint")).alias("inner"),
        F.count(F.lit(1)).alias("degree"),
    )


def modularity(edges: DataFrame, members: DataFrame, formula: str = "newman") -> DataFrame:
    """One row (modularity) of a partition (node, community) on the given graph.

    newman: sum of inner/2E - (degree/2E)^2. legacy: degrees count inner edges only, m is the sum
    of all degrees and the result is divided by 2m twice.
    """
    terms = community_terms(edges, members)
    total = edges.agg((2 * F.count(F.lit(1))).alias("m")).scalar().cast("double")
    inner, degree = F.col("inner"), F.col("degree")
    if formula == "newman":
        part = inner / total - F.pow(degree / total, F.lit(2.0))
    elif formula == "legacy":
        part = (inner - inner * inner / (2 * total)) / (4 * total * total)
    else:
        raise ValueError(formula)
    return terms.agg(F.sum(part).alias("modularity"))
