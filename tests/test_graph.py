import random
from collections import defaultdict, deque

import pytest

from tessera.operators import betweenness as bt
from tessera.operators import graph as gr

BRIDGE = [(1, 2), (1, 3), (2, 3), (3, 4), (4, 5), (4, 6), (5, 6)]


def _frame(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long")


def _random_edges(seed, n=16, m=20):
    rnd = random.Random(seed)
    return sorted({tuple(sorted(rnd.sample(range(n), 2))) for _ in range(m)})


def _brute_betweenness(edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)

    def from_(s):
        dist, sigma, queue = {s: 0}, {s: 1}, deque([s])
        while queue:
            v = queue.popleft()
            for w in near[v]:
                if w not in dist:
                    dist[w], sigma[w] = dist[v] + 1, 0
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
        return dist, sigma

    all_ = {s: from_(s) for s in near}
    score = {e: 0.0 for e in edges}
    for s in near:
        ds, ss = all_[s]
        for t in ds:
            dt, st = all_[t]
            for a, b in edges:
                for u, v in ((a, b), (b, a)):
                    if u in ds and v in dt and ds[u] + 1 + dt[v] == ds[t]:
                        score[a, b] += ss[u] * st[v] / ss[t] / 2
    return score


def _components(edges, nodes):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    name = {}
    for n in sorted(nodes):
        if n not in name:
            queue = deque([n])
            name[n] = n
            while queue:
                for w in near[queue.popleft()]:
                    if w not in name:
                        name[w] = n
                        queue.append(w)
    return name


def _brute_girvan_newman(edges):
    nodes = {v for e in edges for v in e}
    deg = defaultdict(int)
    for a, b in edges:
        deg[a] += 1
        deg[b] += 1
    total = 2 * len(edges)

    def value(name):
        inner, degree = defaultdict(int), defaultdict(int)
        for a, b in edges:
            inner[name[a]] += 2 * (name[a] == name[b])
        for v in nodes:
            degree[name[v]] += deg[v]
        return sum(inner[c] / total - (degree[c] / total) ** 2 for c in degree)

    left, best, history = list(edges), None, []
    while left:
        name = _components(left, nodes)
        q = round(value(name), 12)
        if best is None or q > best[0]:
            best = (q, name)
        score = _brute_betweenness(left)
        top = min(left, key=lambda e: (-round(score[e], 9), e))
        history.append((top, round(score[top], 9)))
        left.remove(top)
    return best, history


def test_betweenness_by_hand(spark):
    got = {(r.src, r.dst): r.score for r in bt.edge_betweenness(_frame(spark, BRIDGE)).collect()}
    assert got == pytest.approx(
        {(3, 4): 9, (1, 3): 4, (2, 3): 4, (4, 5): 4, (4, 6): 4, (1, 2): 1, (5, 6): 1}
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_betweenness_equals_closed_form(spark, seed):
    edges = _random_edges(seed)
    for given in ({"batches": 1}, {"batches": 3}, {"work_rows": 50}):
        rows = bt.edge_betweenness(_frame(spark, edges), **given).collect()
        got = {(r.src, r.dst): r.score for r in rows}
        assert got == pytest.approx(_brute_betweenness(edges))


def test_girvan_newman_by_hand(spark):
    got = {r.node: (r.community, r.modularity) for r in bt.girvan_newman(_frame(spark, BRIDGE)).collect()}
    assert {n: c for n, (c, _) in got.items()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}
    assert got[1][1] == pytest.approx(0.357143, abs=1e-6)


@pytest.mark.parametrize("seed", [3, 4])
def test_girvan_newman_equals_one_edge_at_a_time(spark, seed):
    edges = _random_edges(seed, n=18, m=18)
    course = bt.removals(_frame(spark, edges))
    order = [((r.src, r.dst), r.score) for r in course.order.orderBy("key").collect()]
    (best, name), history = _brute_girvan_newman(edges)
    # Ties between components may swap; each step still takes a highest score of what is left.
    left = list(edges)
    for e, s in order:
        score = _brute_betweenness(left)
        assert s == pytest.approx(max(score.values())) and score[e] == pytest.approx(s)
        left.remove(e)
    assert not left and len(order) == len(history)
    rows = bt.girvan_newman(_frame(spark, edges)).collect()
    assert rows[0].modularity == pytest.approx(best)


def test_only_touched_roots_are_walked_again(spark):
    edges = _random_edges(5, n=7, m=6)
    nodes = {v for e in edges for v in e}
    course, plain = bt.removals(_frame(spark, edges)), bt.removals(_frame(spark, edges), index_rows=0)
    rows = [[(r.src, r.dst, round(r.score, 9)) for r in c.order.orderBy("key").collect()] for c in (course, plain)]
    assert rows[0] == rows[1] and len(rows[0]) == len(edges)
    assert course.redone[0] == len(nodes) and sum(course.redone[1:]) < len(nodes) * (len(course.redone) - 1)
    assert set(plain.redone) == {-1}
    # A root whose shortest paths don't use an edge keeps them without it.
    before, after = (
        {(r.root, r.src, r.dst): r.credit for r in bt.path_credit(_frame(spark, e), bt.vertices(_frame(spark, e))).collect()}
        for e in (edges, edges[1:])
    )
    gone = tuple(edges[0])
    touched = {k[0] for k in before if k[1:] == gone}
    assert {k: v for k, v in before.items() if k[0] not in touched} == {k: v for k, v in after.items() if k[0] not in touched}


def test_components_as_groups_equal_the_joins(spark):
    """A bridge and a ring of four: both by joins, the ring as a group, both as groups."""
    edges = _frame(spark, BRIDGE + [(21, 22), (22, 23), (23, 24), (21, 24)])
    courses = [bt.removals(edges, group_rows=g) for g in (0, 20, bt.GROUP_ROWS)]
    order = [[(r.src, r.dst, round(r.score, 9), r["round"], len(r.key)) for r in c.order.orderBy("key").collect()] for c in courses]
    moves = [sorted((r.node, r["round"], r.community, str(r.key)) for r in c.moves.collect()) for c in courses]
    gains = [{str(r.key): r.gain for r in c.splits.collect()} for c in courses]
    for i in (1, 2):
        assert order[i] == order[0] and moves[i] == moves[0] and courses[i].redone == courses[0].redone
        assert gains[i] == pytest.approx(gains[0])


@pytest.mark.parametrize("group_rows", [0, 200])
def test_betweenness_of_large_components_by_joins(spark, group_rows):
    edges = _random_edges(1) + [(a + 20, b + 20) for a, b in BRIDGE]
    rows = bt.edge_betweenness(_frame(spark, edges), group_rows=group_rows).collect()
    assert {(r.src, r.dst): r.score for r in rows} == pytest.approx(_brute_betweenness(edges))


def test_many_small_components_take_no_rounds_of_jobs(spark, monkeypatch):
    """Neither batches nor rounds grow with the number of components."""
    rows = [(20 * c + a, 20 * c + b) for c in range(300) for a, b in BRIDGE]
    monkeypatch.setattr(bt, "path_credit", None)
    got = bt.edge_betweenness(_frame(spark, rows), work_rows=50).collect()
    assert len(got) == len(rows) and {r.score for r in got if (r.src % 20, r.dst % 20) == (3, 4)} == {9.0}
    named = spark.createDataFrame([(f"n{a:05d}", f"n{b:05d}") for a, b in rows], "src string, dst string")
    found = bt.girvan_newman(named).groupBy("community").count().collect()
    assert len(found) == 300 and {r["count"] for r in found} == {6}


def test_running_total(spark):
    df = spark.createDataFrame([(i % 3, i, float(i)) for i in range(50)], "g int, o int, v double")
    total = {r.o: r.t for r in bt.running_total(df, "o", "v", "t").collect()}
    assert total == {i: i * (i + 1) / 2 for i in range(50)}


@pytest.mark.parametrize("formula,split,whole", [("newman", 0.357143, 0.0), ("legacy", 0.012026, 0.008929)])
def test_modularity(spark, formula, split, whole):
    edges = _frame(spark, BRIDGE)
    two = spark.createDataFrame([(n, 1 if n < 4 else 4) for n in range(1, 7)], "node long, community long")
    one = spark.createDataFrame([(n, 1) for n in range(1, 7)], "node long, community long")
    assert gr.modularity(edges, two, formula).first()[0] == pytest.approx(split, abs=1e-6)
    assert gr.modularity(edges, one, formula).first()[0] == pytest.approx(whole, abs=1e-6)


def test_label_propagation(spark):
    labels = gr.label_propagation(_frame(spark, BRIDGE), 5)
    assert {r.node: r.label for r in labels.collect()} == {1: 1, 2: 1, 3: 1, 4: 3, 5: 3, 6: 3}
    named = {r.node: r.community for r in gr.communities(labels).collect()}
    assert named == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}


@pytest.mark.parametrize("seed", [5, 6])
def test_components(spark, seed):
    edges = _random_edges(seed, n=60, m=45) + [(100 + i, 101 + i) for i in range(20)]
    got = {r.node: r.component for r in gr.connected_components(_frame(spark, edges)).collect()}
    assert got == _components(edges, {v for e in edges for v in e})


def test_empty_graph(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert bt.edge_betweenness(none).count() == 0
    assert gr.label_propagation(none).count() == 0
    assert gr.connected_components(none).count() == 0
    assert bt.girvan_newman(none).count() == 0


def test_corating_edges(spark):
    rows = [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 2), ("c", 2), ("d", 9)]
    df = spark.createDataFrame(rows, "u string, p long")
    edges = gr.corating_edges(df, "u", "p", 2)
    assert [tuple(r) for r in edges.collect()] == [("a", "b")]
    assert {r.id for r in gr.vertices(edges).collect()} == {"a", "b"}


@pytest.mark.parametrize("name", [int, "n{:03d}".format])
def test_a_large_component_is_walked_root_by_root_in_tasks(spark, monkeypatch, name):
    """Beyond a group, but held by a task: no round of joins per level; a third component is too large for that."""
    small, middle = BRIDGE, [(a + 100, b + 100) for a, b in _random_edges(2)]
    edges = [(name(a), name(b)) for a, b in small + middle]
    kind = "long" if name is int else "string"
    df = spark.createDataFrame(edges, f"src {kind}, dst {kind}")
    walked = []
    monkeypatch.setattr(bt, "_walked_scores", lambda left, batches: walked.append(left.count()) or left.selectExpr("src", "dst", "0.0D AS score"))
    monkeypatch.setattr(bt, "summed_credit", lambda *a, of=bt.summed_credit: of(*a, cells=64))
    rows = bt.edge_betweenness(df, group_rows=50).collect()
    got = {(r.src, r.dst): r.score for r in rows}
    assert not walked and len(got) == len(rows) and got == pytest.approx(_brute_betweenness(edges))
    some = bt.edge_betweenness(df, group_rows=50, walk_edges=10).collect()
    assert walked and {(r.src, r.dst) for r in some} == set(edges)
