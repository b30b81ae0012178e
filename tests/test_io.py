import glob
import json

from tessera.sources import readers as rd
from tessera.sources import writers as wr


def _text(path, suffix="txt"):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*.{suffix}")))


def test_json_lines(spark, tmp_path):
    p = tmp_path / "r.json"
    good = {"user_id": "u", "business_id": "b", "stars": 4.5, "date": "2018-02-03 10:00:00", "text": "x"}
    p.write_text(json.dumps(good) + "\n{broken\n")
    rows = rd.read_reviews(spark, str(p)).collect()
    assert str(rows[0].date) == "2018-02-03" and rows[0].stars == 4.5
    assert rows[1].user_id is None and rows[1]._corrupt_record == "{broken"


def test_business_users_and_model(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"business_id": "b", "categories": null, "stars": 3, "is_open": 1}\n')
    (tmp_path / "u.json").write_text('{"user_id": "u", "fans": 3, "average_stars": 3.5}\n')
    (tmp_path / "m.json").write_text(
        '{"b1": "z", "b2": "a", "sim": 0.5}\n{"b1": "a", "b2": "z", "sim": 0.5}\n'
    )
    b = rd.read_business(spark, str(tmp_path / "b.json")).first()
    assert b.categories is None and b.stars == 3.0 and b.review_count is None
    assert rd.read_users(spark, str(tmp_path / "u.json")).first().fans == 3
    m = rd.read_pair_model(spark, str(tmp_path / "m.json")).collect()
    assert [tuple(r) for r in m] == [("a", "z", 0.5)]


def test_interactions_points_and_chunks(spark, tmp_path):
    (tmp_path / "i.csv").write_text("user_id,business_id\nu,b\nv,c\n")
    assert [tuple(r) for r in rd.read_interactions(spark, str(tmp_path / "i.csv")).collect()] == [
        ("u", "b"),
        ("v", "c"),
    ]
    chunks = tmp_path / "chunks"
    chunks.mkdir()
    (chunks / "data2.txt").write_text("3,0.5,-1\n")
    (chunks / "data1.txt").write_text("1,1.5,2\n2,3,4e1\n")
    paths = rd.chunk_paths(spark, str(chunks))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["data1.txt", "data2.txt"]
    got = [(r.point_id, list(r.features)) for r in rd.read_points(spark, paths[0]).collect()]
    assert got == [("1", [1.5, 2.0]), ("2", [3.0, 40.0])]


def test_stop_words(spark, tmp_path):
    (tmp_path / "s").write_text("the \nand\n")
    assert {r.word for r in rd.read_stop_words(spark, str(tmp_path / "s")).collect()} == {"the", "and", ""}


def test_report(spark, tmp_path):
    report = {"A": 3, "D": [["u", 2]], "E": ["w"]}
    wr.write_report(spark, report, str(tmp_path / "r"))
    assert _text(tmp_path / "r") == json.dumps(report, indent=4) + "\n"


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 0.5)], "b1 string, b2 string, sim double")
    wr.write_json_lines(df, str(tmp_path / "p"))
    assert json.loads(_text(tmp_path / "p", "json")) == {"b1": "a", "b2": "b", "sim": 0.5}
    wr.write_model(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).collect() == df.collect()
    labels = spark.createDataFrame([("p", -1)], "point_id string, cluster int")
    wr.write_cluster_map(labels, str(tmp_path / "c"))
    assert json.loads(_text(tmp_path / "c", "json")) == {"point_id": "p", "cluster": -1}


def test_round_metrics(spark, tmp_path):
    cols = ", ".join(f"{c} long" for c in wr.METRIC_COLUMNS)
    df = spark.createDataFrame([(2, 5, 90, 1, 3, 2), (1, 5, 50, 0, 0, 4)], cols)
    wr.write_round_metrics(df, str(tmp_path / "m"))
    assert _text(tmp_path / "m", "csv").splitlines() == [
        ",".join(wr.METRIC_COLUMNS),
        "1,5,50,0,0,4",
        "2,5,90,1,3,2",
    ]


def test_betweenness_text(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 4.5)], "src string, dst string, score double")
    wr.write_betweenness(df, str(tmp_path / "b"))
    assert _text(tmp_path / "b") == "('b', 'c'), 4.5\n('a', 'b'), 1.0\n"


def test_community_text(spark, tmp_path):
    groups = [["d", "e", "c"], ["z"], ["b", "a"], ["y", "x", "w"], ["m"]]
    rows = [(n, min(g)) for g in groups for n in g]
    df = spark.createDataFrame(rows, "node string, community string").repartition(5)
    wr.write_communities(df, str(tmp_path / "c"))
    assert _text(tmp_path / "c").splitlines() == [
        "'m'",
        "'z'",
        "'a', 'b'",
        "'c', 'd', 'e'",
        "'w', 'x', 'y'",
    ]


def test_itemset_groups(spark):
    df = spark.createDataFrame([(["b", "a"], 3), (["c"], 4), (["a"], 5)], "items array<string>, support long")
    assert [(r.length, r["items"]) for r in wr.itemset_groups(df).collect()] == [
        (1, ["a"]),
        (1, ["c"]),
        (2, ["a", "b"]),
    ]


def test_shuffle_files_go_with_a_kept_table(spark):
    """A checkpoint or stored table leaves no shuffle files behind; the setting and the plan are as they were."""
    import os
    import time

    from tessera import session

    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    places = [str(x) for x in env.blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for p in places for _, _, names in os.walk(p) for f in names if f.startswith("shuffle_")}

    for keep in (session.checkpointed, session.stored):
        before, setting = shuffled(), spark.conf.get(session.FILES_GO, None)
        df = spark.range(5000).repartition(4, "id").selectExpr("id", "array(id) as a")
        kept = keep(df)
        until = time.time() + 20
        while shuffled() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffled() - before
        assert spark.conf.get(session.FILES_GO, None) == setting and kept.dtypes == df.dtypes
        assert sorted(r.id for r in kept.collect()) == list(range(5000)) and df.count() == 5000
