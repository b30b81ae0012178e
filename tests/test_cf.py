import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cf


@pytest.fixture(scope="module")
def model(rated):
    return cf.pearson_model(rated, 3)


def _stars(df):
    return {(r.user_id, r.business_id): r.stars for r in df.collect()}


def test_corated_and_pearson(rated, model):
    assert [tuple(r) for r in cf.corated_pairs(rated, 3).collect()] == [("b1", "b2", 3)]
    assert [tuple(r) for r in model.collect()] == [("b1", "b2", pytest.approx(1.0))]


def test_constant_ratings_have_no_weight(spark):
    df = spark.createDataFrame(
        [(u, b, 3.0 if b == "x" else float(i)) for i, u in enumerate("abc") for b in "xy"],
        "user_id string, business_id string, stars double",
    )
    assert cf.pearson_model(df, 3).count() == 0


def test_predict_with_fallbacks(spark, rated, model):
    wanted = spark.createDataFrame(
        [("u4", "b2"), ("u4", "b2"), ("u4", "b3"), ("u9", "b1"), ("u1", "b9")],
        "user_id string, business_id string",
    )
    predicted = cf.predict(wanted, rated, model, 3)
    assert _stars(predicted) == pytest.approx(
        {
            ("u4", "b2"): 4.0,
            ("u4", "b3"): 4.0,
            ("u9", "b1"): 27 / 8,
            ("u1", "b9"): 4.0,
        }
    )
    blended = _stars(cf.blend(predicted, rated))
    assert blended["u4", "b2"] == pytest.approx((4 + 2 + 4) / 3)
    assert blended["u9", "b1"] == pytest.approx((27 / 8 + 4 + 27 / 8) / 3)
    assert blended["u1", "b9"] == pytest.approx((4 + 27 / 8 + 4) / 3)


def test_top_n_and_both_routes(spark):
    """A user with many ratings and an item with many model rows give the plain answer."""
    rows = [("u", f"i{k:02d}", float(k % 5 + 1)) for k in range(12)] + [("w", "i00", 2.0)]
    rated = spark.createDataFrame(rows, "user_id string, business_id string, stars double")
    pairs = [("i00", f"z{k}", 0.5) for k in range(20)]
    pairs += [(f"i{k:02d}", "t", 0.1 * (k + 1)) for k in range(5)]
    model = spark.createDataFrame(pairs, "b1 string, b2 string, sim double")
    wanted = spark.createDataFrame(
        [("u", "t"), ("w", "z3"), ("w", "i00"), ("u", "z1")], "user_id string, business_id string"
    )
    got = _stars(cf.predict(wanted, rated, model, 2))
    # Neighbours of t by similarity: i04 (0.5, 5 stars) and i03 (0.4, 4 stars).
    assert got["u", "t"] == pytest.approx((5 * 0.5 + 4 * 0.4) / 0.9)
    assert got["w", "z3"] == 2.0 and got["w", "i00"] == 2.0 and got["u", "z1"] == 1.0


def test_last_rating_wins(spark):
    rows = [("u", "b", "2020-01-01", 1, 1, 5.0), ("u", "b", "2020-01-02", 1, 1, 2.0)]
    rows += [("u", "b", "2020-01-02", 1, 1, 3.0), ("u", "c", "2020-01-01", 9, 1, 4.0)]
    df = spark.createDataFrame(
        rows,
        "user_id string, business_id string, date string, order_key long, line_no int, stars double",
    )
    assert _stars(cf.ratings(df)) == {("u", "b"): 3.0, ("u", "c"): 4.0}
    assert cf.averages(cf.ratings(df), "user_id").select(F.max("avg_stars")).first()[0] == 3.5


def test_constant_items_have_no_weight(spark):
    rnd = random.Random(3)
    rows = []
    for item in range(12):
        # Every third item always gets the same star, which no binary fraction is.
        level = rnd.choice([4.1, 3.3, 0.7, 1e6 + 0.1])
        for user in range(9):
            rows.append((user, item, level if item % 3 == 0 else level + rnd.choice([0.1, 0.2, 0.3, 0.7])))
    rated = spark.createDataFrame(rows, "user_id long, business_id long, stars double").repartition(3)
    got = {(r.b1, r.b2): r.sim for r in cf.pearson_model(rated, 3).collect()}
    stars = defaultdict(dict)
    for u, i, s in rows:
        stars[i][u] = s
    want = {}
    for a in range(12):
        for b in range(a + 1, 12):
            if a % 3 and b % 3:
                r = np.corrcoef([stars[a][u] - stars[a][0] for u in range(9)], [stars[b][u] - stars[b][0] for u in range(9)])[0, 1]
                if r > 1e-9:
                    want[a, b] = r
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want) and max(got.values()) <= 1.0


def test_equal_correlations_are_equal_numbers(spark):
    """Sums of whole stars are exact, so ties between neighbours are ties and go by name."""
    rnd = random.Random(5)
    stars = {(u, b): float(rnd.randint(1, 5)) for u in range(40) for b in range(14) if rnd.random() < 0.5}
    df = spark.createDataFrame([(u, b, s) for (u, b), s in stars.items()], "user_id int, business_id int, stars double")
    got = {(r.b1, r.b2): r.sim for r in cf.pearson_model(df, 3).collect()}
    assert len(got) > 20
    for (a, b), sim in got.items():
        x, y = zip(*[(stars[u, a], stars[u, b]) for u in range(40) if (u, a) in stars and (u, b) in stars])
        n, sx, sy = len(x), sum(x), sum(y)
        num = n * sum(i * j for i, j in zip(x, y)) - sx * sy
        den = (n * sum(i * i for i in x) - sx * sx) * (n * sum(j * j for j in y) - sy * sy)
        assert sim == num / den**0.5
