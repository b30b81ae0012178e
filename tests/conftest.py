import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tessera.session import get_session

    session = get_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rated(spark):
    """The hand fixture of reviews: (user, item, stars, date)."""
    rows = [
        ("u1", "b1", 5.0, "2018-03-01"),
        ("u1", "b2", 3.0, "2018-03-02"),
        ("u2", "b1", 4.0, "2017-12-31"),
        ("u2", "b2", 2.0, "2018-01-01"),
        ("u3", "b1", 3.0, "2018-05-05"),
        ("u3", "b2", 1.0, "2018-12-31"),
        ("u3", "b3", 5.0, "2019-01-01"),
        ("u4", "b1", 4.0, "2019-06-01"),
    ]
    return spark.createDataFrame(
        rows, "user_id string, business_id string, stars double, date string"
    ).selectExpr("user_id", "business_id", "stars", "cast(date as date) as date")
