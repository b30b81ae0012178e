import pytest

from tessera.operators import explore as ex
from tessera.operators import partitions as pt


def test_counts(spark, rated):
    assert ex.review_count(rated).first().n_reviews == 8
    assert ex.year_count(rated, 2018).first().n_reviews == 5
    assert ex.distinct_keys(rated, "user_id").first().n_distinct == 4
    assert [tuple(r) for r in ex.top_keys(rated, "user_id", 2).orderBy("rank").collect()] == [
        ("u3", 3, 1),
        ("u1", 2, 2),
    ]
    # Strictly greater: b2 with exactly 3 rows stays out.
    assert [tuple(r) for r in ex.keys_over(rated, "business_id", 3).collect()] == [("b1", 4)]


def test_category_avg(spark, rated):
    business = spark.createDataFrame(
        [("b1", "Food, Bars"), ("b2", "Food"), ("b3", None)],
        "business_id string, categories string",
    )
    top = ex.top_categories(rated, business, 5).orderBy("rank").collect()
    assert [(r.category, r["rank"]) for r in top] == [("Bars", 1), ("Food", 2)]
    assert [r.avg_stars for r in top] == [4.0, pytest.approx(22 / 7)]


def test_words(spark):
    texts = spark.createDataFrame(
        [("Good, good (food)! [Yes]",), ("  don't-stop  ",), ("",)], "text string"
    )
    stop = spark.createDataFrame([("yes",), ("",)], "word string")
    counts = {r.word: r.n for r in ex.word_counts(texts, "text", stop).collect()}
    assert counts == {"good": 2, "food": 1, "don't-stop": 1}
    assert [r.word for r in ex.top_words(texts, "text", stop, 2).orderBy("rank").collect()] == [
        "good",
        "don't-stop",
    ]


def test_keyed_profile(spark):
    keys = spark.range(10).withColumnRenamed("id", "k")

    def sizes(n):
        return [r.n_rows for r in pt.keyed_profile(keys, "k", n).orderBy("partition_id").collect()]

    assert sizes(4) == [3, 3, 2, 2]
    assert sizes(16) == [1] * 10 + [0] * 6
    words = keys.selectExpr("concat('key', k) as k")
    first = pt.keyed_profile(words, "k", 3).orderBy("partition_id").collect()
    assert sum(r.n_rows for r in first) == 10 and len(first) == 3


def test_default_profile(spark):
    got = pt.default_profile(spark.range(0, 100, 1, 7)).orderBy("partition_id").collect()
    assert len(got) == 7 and sum(r.n_rows for r in got) == 100
