import pytest
from pyspark.sql import functions as F

from tessera.operators import dictionary as dc, graph as gr


@pytest.mark.parametrize("n, parts", [(1, 1), (1000, 7)])
def test_numbers_are_dense_and_ordered(spark, n, parts):
    df = spark.range(n).select(F.concat(F.lit("v"), F.col("id") * 7919 % n).alias("v")).repartition(parts)
    got = {r.v: r.code for r in dc.dense_ids(df.union(df), "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(f"v{i * 7919 % n}" for i in range(n)))}


def test_nulls_ties_and_empty(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "v string")
    assert sorted(map(tuple, dc.dense_ids(df, "v").collect())) == [("a", 0), ("b", 1)]
    assert dc.dense_ids(df.where("1 = 0"), "v").count() == 0
    rows = dc.numbered(df, [F.col("v").desc()], "k").collect()
    assert sorted(r.k for r in rows) == [0, 1, 2, 3] and [r.v for r in sorted(rows, key=lambda r: r.k)] == ["b", "a", "a", None]


def test_edges_there_and_back(spark):
    edges = spark.createDataFrame([("a", "c"), ("c", "x"), ("m", "z")], "src string, dst string")
    coded, names = dc.encoded_edges(edges)
    assert sorted(map(tuple, coded.collect())) == [(0, 1), (1, 3), (2, 4)]
    found = dc.decoded(gr.connected_components(coded), ["node", "component"], names)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, gr.connected_components(edges).collect()))
