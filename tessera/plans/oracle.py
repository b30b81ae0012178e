"""SQL with the results of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from ..functions.hashing import MERSENNE_31, coefficients
from ..sources.views import SPLIT_DATE
from . import queries as q

REVIEWS = """reviews AS (
  SELECT o_custkey AS user_id, l_partkey AS business_id,
         CAST((CAST(l_quantity AS INTEGER) - 1) % 5 + 1 AS DOUBLE) AS stars,
         o_orderdate AS date, l_orderkey AS order_key, l_linenumber AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _rated(name: str, condition: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT user_id, business_id, stars FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, business_id
             ORDER BY date DESC, order_key DESC, line_no DESC, stars DESC) AS rn
    FROM reviews WHERE {condition}) WHERE rn = 1)"""


TRAIN = _rated("train", f"date < TIMESTAMP '{SPLIT_DATE}'")
TEST = _rated("test", f"date >= TIMESTAMP '{SPLIT_DATE}'")

BUSINESS = """business AS (
  SELECT p_partkey AS business_id,
         CASE WHEN p_brand <> 'Brand#13' THEN replace(p_name, ' ', ', ') END AS categories
  FROM part)"""

CATEGORY_AVG = f"""{REVIEWS}, {BUSINESS},
cats AS (SELECT business_id, unnest(string_split(categories, ', ')) AS category
         FROM business WHERE categories IS NOT NULL),
cat_avg AS (SELECT category, avg(stars) AS avg_stars
            FROM reviews JOIN cats USING (business_id) GROUP BY category)"""


def _top(source: str, value: str, name: str, shown: str) -> str:
    return f"""SELECT {name}, {shown} AS {value},
  CAST(row_number() OVER (ORDER BY {value} DESC, {name}) AS INTEGER) AS rank
FROM {source} ORDER BY {value} DESC, {name} LIMIT {q.TOP}"""


def _baskets(key: str, item: str) -> str:
    return f"""WITH {REVIEWS}, rows AS (
  SELECT DISTINCT {key} AS basket_id, {item} AS item FROM reviews)
SELECT basket_id, item FROM rows WHERE basket_id IN (
  SELECT basket_id FROM rows GROUP BY basket_id HAVING count(*) > {q.MIN_BASKET})"""


def _order_baskets(item: str, min_size: int | None = None) -> str:
    cte = f"""every AS (SELECT DISTINCT l_orderkey AS basket_id, {item} AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
    if min_size is None:
        return cte + ", rows AS (SELECT * FROM every)"
    return (
        cte
        + f""", rows AS (SELECT * FROM every WHERE basket_id IN (
  SELECT basket_id FROM every GROUP BY basket_id HAVING count(*) > {min_size}))"""
    )


def _joined(size: int) -> str:
    tables = "rows r1 " + " ".join(
        f"JOIN rows r{i} ON r{i}.basket_id = r1.basket_id AND r{i}.item > r{i - 1}.item"
        for i in range(2, size + 1)
    )
    return tables


def _itemset(size: int) -> str:
    return " || '|' || ".join(f"r{i}.item" for i in range(1, size + 1))


def _itemsets(baskets: str, fraction: float, max_size: int) -> str:
    parts = [
        f"""SELECT {size} AS length, {_itemset(size)} AS itemset, count(*) AS support
FROM {_joined(size)} GROUP BY 2 HAVING count(*) >= (SELECT s FROM need)"""
        for size in range(1, max_size + 1)
    ]
    return f"""WITH {baskets}, need AS (
  SELECT ceil({fraction} * count(DISTINCT basket_id)) AS s FROM rows)
{" UNION ALL ".join(parts)}"""


def _son_candidates(baskets: str, fraction: float, max_size: int) -> str:
    parts = [
        f"""SELECT r1.basket_id % {q.SON_CHUNKS} AS chunk, {size} AS length,
  {_itemset(size)} AS itemset, count(*) AS support FROM {_joined(size)} GROUP BY 1, 3"""
        for size in range(1, max_size + 1)
    ]
    return f"""WITH {baskets},
total AS (SELECT count(DISTINCT basket_id) AS n,
                 ceil({fraction} * count(DISTINCT basket_id)) AS s FROM rows),
local AS (SELECT basket_id % {q.SON_CHUNKS} AS chunk, count(DISTINCT basket_id) AS n
          FROM rows GROUP BY 1),
counted AS ({" UNION ALL ".join(parts)})
SELECT DISTINCT length, itemset FROM counted JOIN local USING (chunk), total
WHERE support * total.n >= total.s * local.n"""


MEMBERS = f"""{REVIEWS},
members AS (SELECT DISTINCT business_id, user_id FROM reviews),
sizes AS (SELECT business_id, count(*) AS n FROM members GROUP BY business_id)"""


def _signature_columns(n: int) -> list[str]:
    return [
        f"min((CAST({a} AS BIGINT) * (user_id % {MERSENNE_31}) + {b}) % {MERSENNE_31})"
        for a, b in coefficients(n)
    ]


def _signatures(n: int = q.BANDS * q.ROWS) -> str:
    mins = ", ".join(f"{c} AS h{i}" for i, c in enumerate(_signature_columns(n)))
    return f"""{MEMBERS},
sigs AS (SELECT business_id, count(*) AS n_members, {mins} FROM members GROUP BY business_id)"""


def _candidates(n_bands: int = q.BANDS, n_rows: int = q.ROWS) -> str:
    bands = " UNION ALL ".join(
        f"SELECT {b} AS band, "
        + " || ',' || ".join(f"h{b * n_rows + r}" for r in range(n_rows))
        + "::VARCHAR AS slice, business_id FROM sigs"
        for b in range(n_bands)
    )
    return f"""{_signatures(n_bands * n_rows)}, bands AS ({bands}),
candidates AS (SELECT DISTINCT x.business_id AS b1, y.business_id AS b2
  FROM bands x JOIN bands y ON x.band = y.band AND x.slice = y.slice
   AND x.business_id < y.business_id)"""


def _verified(pairs: str) -> str:
    return f"""SELECT b1, b2, round(c / (n1 + n2 - c), 6) AS sim FROM (
  SELECT p.b1, p.b2, count(*) AS c, any_value(s1.n) AS n1, any_value(s2.n) AS n2
  FROM {pairs} p
  JOIN members m1 ON m1.business_id = p.b1
  JOIN members m2 ON m2.business_id = p.b2 AND m2.user_id = m1.user_id
  JOIN sizes s1 ON s1.business_id = p.b1 JOIN sizes s2 ON s2.business_id = p.b2
  GROUP BY p.b1, p.b2) WHERE c / (n1 + n2 - c) >= {q.JACCARD}"""


NEAR_DUPLICATES = rf"""WITH tokens AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS shingle FROM tokens WHERE len(w) >= 3
  UNION SELECT doc_id, array_to_string(w, ' ') FROM tokens WHERE len(w) BETWEEN 1 AND 2),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS h
         FROM shingles GROUP BY doc_id),
reps AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY h) AS rep FROM sets),
core AS (SELECT s.doc_id, s.shingle, r.n FROM shingles s JOIN reps r ON s.doc_id = r.doc_id
         WHERE r.doc_id = r.rep),
counted AS (SELECT x.doc_id AS b1, y.doc_id AS b2, count(*) AS c,
                   any_value(x.n) AS n1, any_value(y.n) AS n2
  FROM core x JOIN core y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2)
SELECT b1, b2, round(c / (n1 + n2 - c), 6) AS sim FROM counted
WHERE c / (n1 + n2 - c) >= {q.DOC_JACCARD}
UNION ALL SELECT rep, doc_id, 1.0 FROM reps WHERE doc_id <> rep"""

def _pair_sums(rated: str) -> str:
    return f"""WITH {REVIEWS}, {rated},
sums AS (SELECT x.business_id AS b1, y.business_id AS b2, count(*) AS n,
    sum(x.stars) AS sx, sum(y.stars) AS sy, sum(x.stars * y.stars) AS sxy,
    sum(x.stars * x.stars) AS sxx, sum(y.stars * y.stars) AS syy
  FROM train x JOIN train y ON x.user_id = y.user_id AND x.business_id < y.business_id
  GROUP BY 1, 2 HAVING count(*) >= {q.MIN_CORATED})"""


def _model(sums: str) -> str:
    return f"""{sums},
model AS (SELECT b1, b2, num / sqrt(den) AS sim FROM (
  SELECT b1, b2, n * sxy - sx * sy AS num, (n * sxx - sx * sx) * (n * syy - sy * sy) AS den
  FROM sums) WHERE num > 0 AND den > 0)"""


PAIR_SUMS = _pair_sums(f"{TRAIN}, {TEST}")
ALL_PAIR_SUMS = _pair_sums(_rated("train"))
MODEL = _model(PAIR_SUMS)

PREDICT = f"""{MODEL},
wanted AS (SELECT DISTINCT user_id, business_id FROM test),
near AS (SELECT w.user_id, w.business_id, t.stars, m.sim,
    row_number() OVER (PARTITION BY w.user_id, w.business_id
                       ORDER BY m.sim DESC, t.business_id) AS rn
  FROM wanted w JOIN train t ON t.user_id = w.user_id
  JOIN model m ON m.b1 = least(w.business_id, t.business_id)
              AND m.b2 = greatest(w.business_id, t.business_id)),
weighted AS (SELECT user_id, business_id, sum(stars * sim) / nullif(sum(sim), 0) AS cf
  FROM near WHERE rn <= {q.NEIGHBOURS} GROUP BY 1, 2),
user_mean AS (SELECT user_id, avg(stars) AS um FROM train GROUP BY 1),
item_mean AS (SELECT business_id, avg(stars) AS im FROM train GROUP BY 1),
overall AS (SELECT avg(stars) AS g FROM train),
predicted AS (SELECT user_id, business_id, coalesce(cf, um, g) AS stars
  FROM wanted LEFT JOIN weighted USING (user_id, business_id)
  LEFT JOIN user_mean USING (user_id), overall)"""


def _edges(threshold: int, item: str = "business_id") -> str:
    return f"""{REVIEWS},
had AS (SELECT DISTINCT user_id AS u, {item} AS p FROM reviews),
edges AS (SELECT x.u AS src, y.u AS dst FROM had x JOIN had y ON x.p = y.p AND x.u < y.u
          GROUP BY 1, 2 HAVING count(*) >= {threshold}),
arcs AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
nodes AS (SELECT DISTINCT src AS id FROM arcs)"""


def block_edges(threshold: int) -> str:
    return _edges(threshold, "(user_id // 150) * 200 + business_id % 200")


BLOCK_EDGES = block_edges(q.BLOCK_THRESHOLD)


def _label_rounds() -> str:
    out = ["l0 AS (SELECT id AS node, id AS label FROM nodes)"]
    for i in range(1, q.LPA_ROUNDS + 1):
        out.append(
            f"""l{i} AS (SELECT dst AS node, label FROM (
  SELECT dst, label, row_number() OVER (PARTITION BY dst ORDER BY count(*) DESC, label) AS rn
  FROM arcs JOIN l{i - 1} ON src = node GROUP BY dst, label) WHERE rn = 1)"""
        )
    return ", ".join(out)


LABELS = f"WITH {_edges(q.EDGE_THRESHOLD)}, {_label_rounds()}"

def _components(edges: str) -> str:
    return f"""WITH RECURSIVE {edges},
reach AS (SELECT id, id AS other FROM nodes
          UNION SELECT reach.id, arcs.dst FROM reach JOIN arcs ON reach.other = arcs.src),
parts AS (SELECT id AS node, min(other) AS component FROM reach GROUP BY id)"""


COMPONENTS = _components(_edges(q.EDGE_THRESHOLD))

MODULARITY = f"""{COMPONENTS},
terms AS (SELECT x.component, sum(CASE WHEN x.component = y.component THEN 1 ELSE 0 END) AS inn,
                 count(*) AS deg
  FROM arcs JOIN parts x ON src = x.node JOIN parts y ON dst = y.node GROUP BY 1),
total AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM arcs)
SELECT 'newman' AS formula, round(sum(inn / m - (deg / m) * (deg / m)), 9) AS modularity
FROM terms, total
UNION ALL SELECT 'legacy', round(sum((inn - inn * inn / (2 * m)) / (4 * m * m)), 9)
FROM terms, total"""

# Credit through an edge without back-propagation: half the share of shortest s-t paths on it.
# `longest` is a bound of the length of a shortest path.
def _betweenness(edges: str, longest: str) -> str:
    return f"""WITH RECURSIVE
{edges},
walk(s, v, d) AS (SELECT id, id, 0 FROM nodes
  UNION SELECT s, dst, d + 1 FROM walk JOIN arcs ON v = src WHERE d < {longest}),
dist AS (SELECT s, v, min(d) AS d FROM walk GROUP BY s, v),
paths(s, v, d, sigma) AS (SELECT id, id, 0, CAST(1 AS DOUBLE) FROM nodes
  UNION ALL SELECT p.s, a.dst, p.d + 1, sum(p.sigma)
  FROM paths p JOIN arcs a ON a.src = p.v
  JOIN dist ON dist.s = p.s AND dist.v = a.dst AND dist.d = p.d + 1 GROUP BY 1, 2, 3)
SELECT least(a.src, a.dst) AS src, greatest(a.src, a.dst) AS dst,
       round(sum(x.sigma * y.sigma / z.sigma) / 2, 6) AS score
FROM arcs a JOIN paths x ON x.v = a.src JOIN paths y ON y.s = a.dst
JOIN paths z ON z.s = x.s AND z.v = y.v AND z.d = x.d + 1 + y.d
GROUP BY 1, 2"""


HOUR_EDGES = f"""had AS (SELECT DISTINCT user_id AS u, date_trunc('hour', ts) AS h FROM events),
edges AS (SELECT x.u AS src, y.u AS dst FROM had x JOIN had y ON x.h = y.h AND x.u < y.u
          GROUP BY 1, 2 HAVING count(*) >= {q.HOUR_THRESHOLD}),
arcs AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
nodes AS (SELECT DISTINCT src AS id FROM arcs)"""


def _points() -> str:
    def near(mult: int, m: int, shift: int) -> str:
        return (
            f"CAST(20 * (({mult} * (k % 5)) % 5) AS DOUBLE) + CAST(p % {m} AS DOUBLE) * 4 / {m} - 2"
            f" + CASE WHEN kind = 'mini' THEN {shift} ELSE 0 END"
        )

    def feature(mult: int, m: int, shift: int, far: int) -> str:
        return (
            f"CASE WHEN kind = 'scatter' THEN CAST(p % {far} AS DOUBLE) / 50 - 300 "
            f"ELSE {near(mult, m, shift)} END"
        )

    return f"""laid AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS p,
  CASE WHEN o_orderkey % 211 = 0 THEN 'scatter' WHEN o_orderkey % 97 = 0 THEN 'mini'
       ELSE 'core' END AS kind FROM orders),
points AS (SELECT k AS point_id, kind, CAST(k % 5 AS INTEGER) AS centre,
  {feature(1, 1009, 9, 50021)} AS f0, {feature(2, 997, -9, 49999)} AS f1,
  {feature(3, 991, 0, 49991)} AS f2 FROM laid)"""


def _stats(source: str, cluster: str, dims: int) -> str:
    def std(j: int) -> str:
        return f"sqrt(greatest(sum(f{j} * f{j}) / count(*) - pow(sum(f{j}) / count(*), 2), 0))"

    cols = ", ".join(f"sum(f{j}) / count(*) AS m{j}, {std(j)} AS s{j}" for j in range(dims))
    return f"stats AS (SELECT {cluster} AS cluster, count(*) AS n, {cols} FROM {source} GROUP BY 1)"


def _small_groups() -> str:
    return f"""{_points()},
grouped AS (SELECT *, CASE WHEN kind = 'scatter' THEN 30 + point_id % 4
  ELSE centre * 6 + (point_id % 3) * 2 + CASE WHEN kind = 'mini' THEN 1 ELSE 0 END END::INTEGER AS grp FROM points),
{_stats("grouped", "grp", 3)},
far AS (SELECT a.cluster AS first, b.cluster AS second, {_distance("b.m", "a.m", "a.s")} AS distance
  FROM stats a JOIN stats b ON a.cluster < b.cluster),
near AS (SELECT first, second, row_number() OVER (ORDER BY first, second) AS k FROM far
  WHERE distance < {q.MERGE_THRESHOLD}),
walk AS (SELECT 0::BIGINT AS k, []::INTEGER[] AS used, 0 AS first, 0 AS second, false AS taken
  UNION ALL
  SELECT n.k, CASE WHEN free THEN list_concat(used, [n.first, n.second]) ELSE used END, n.first, n.second, free
  FROM (SELECT n.*, used, NOT list_contains(used, n.first) AND NOT list_contains(used, n.second) AS free
        FROM walk w JOIN near n ON n.k = w.k + 1) n)"""


def _long_stats(dims: int) -> str:
    return " UNION ALL ".join(
        f"SELECT cluster, {j} AS dim, n, round(m{j}, 6) AS mean, round(s{j}, 6) AS std FROM stats"
        for j in range(dims)
    )


def _distance(x: str, m: str, s: str) -> str:
    terms = " + ".join(f"pow(({x}{j} - {m}{j}) / greatest({s}{j}, 1e-9), 2)" for j in range(3))
    return f"sqrt({terms})"


WIDE = (
    "wide AS (SELECT label, "
    + ", ".join(f"CAST(embedding[{j + 1}] AS DOUBLE) AS f{j}" for j in range(64))
    + " FROM embeddings)"
)


def _id_bin(col: str) -> str:
    return f"CAST(('0x' || md5(CAST({col} AS VARCHAR)))::UHUGEINT % {q.NUM_BINS} AS INTEGER)"


FEATURE_FRAME = f"""WITH {REVIEWS}, {TRAIN},
u AS (SELECT user_id, count(*) AS review_count_user, avg(stars) AS user_avg_rate
      FROM train GROUP BY 1),
b AS (SELECT business_id, count(*) AS review_count_bus, avg(stars) AS bus_avg_rate
      FROM train GROUP BY 1)
SELECT user_id, business_id, stars, c_acctbal AS acctbal, c_nationkey AS nationkey,
  review_count_user, round(user_avg_rate, 6) AS user_avg_rate, {_id_bin('user_id')} AS user_bin,
  p_retailprice AS retailprice, p_size AS size, review_count_bus,
  round(bus_avg_rate, 6) AS bus_avg_rate, {_id_bin('business_id')} AS business_bin
FROM train JOIN u USING (user_id) JOIN customer ON c_custkey = user_id
JOIN b USING (business_id) JOIN part ON p_partkey = business_id"""


def oracle() -> dict[str, str]:
    stop = ", ".join(f"'{w}'" for w in q.STOP_WORDS)
    threshold = q.ALPHA * 3**0.5
    return {
        "review_count": f"WITH {REVIEWS} SELECT count(*) AS n_reviews FROM reviews",
        "year_count": f"""WITH {REVIEWS} SELECT count(*) AS n_reviews FROM reviews
WHERE year(date) = {q.YEAR}""",
        "distinct_users": f"""WITH {REVIEWS}
SELECT count(DISTINCT user_id) AS n_distinct FROM reviews""",
        "top_users": f"""WITH {REVIEWS},
c AS (SELECT user_id, count(*) AS n FROM reviews GROUP BY 1) {_top("c", "n", "user_id", "n")}""",
        "top_words": rf"""WITH words AS (SELECT unnest(string_split_regex(
  lower(regexp_replace(text, '[(\[,.!?:;\])]', '', 'g')), '\s+')) AS word FROM documents),
c AS (SELECT word, count(*) AS n FROM words WHERE word <> '' AND word NOT IN ({stop}) GROUP BY 1)
{_top("c", "n", "word", "n")}""",
        "category_avg": f"""WITH {CATEGORY_AVG}
SELECT category, round(avg_stars, 6) AS avg_stars FROM cat_avg""",
        "top_categories": f"""WITH {CATEGORY_AVG}
{_top("cat_avg", "avg_stars", "category", "round(avg_stars, 6)").replace("ORDER BY avg_stars", "ORDER BY cat_avg.avg_stars")}""",
        "keys_over_threshold": f"""WITH {REVIEWS} SELECT business_id, count(*) AS n FROM reviews
GROUP BY 1 HAVING count(*) > {q.REVIEW_THRESHOLD}""",
        "user_averages": f"""WITH {REVIEWS}, {_rated("rated")}
SELECT user_id, round(avg(stars), 6) AS avg_stars FROM rated GROUP BY 1""",
        "item_averages": f"""WITH {REVIEWS}, {_rated("rated")}
SELECT business_id, round(avg(stars), 6) AS avg_stars FROM rated GROUP BY 1""",
        "partition_profile_keyed": f"""WITH {REVIEWS}
SELECT CAST(i AS INTEGER) AS partition_id, count(business_id) AS n_rows
FROM range({q.N_PARTITIONS}) t(i) LEFT JOIN reviews ON business_id % {q.N_PARTITIONS} = i
GROUP BY 1""",
        "baskets_all": f"""WITH {REVIEWS}
SELECT DISTINCT user_id AS basket_id, business_id AS item FROM reviews""",
        "baskets_by_user": _baskets("user_id", "business_id"),
        "baskets_by_item": _baskets("business_id", "user_id"),
        "frequent_itemsets": _itemsets(_order_baskets("p_type"), q.TYPE_SUPPORT, 5),
        "frequent_itemsets_min_basket": _itemsets(
            _order_baskets("p_brand", q.MIN_BRANDS), q.BRAND_SUPPORT, 4
        ),
        "son_candidates": _son_candidates(_order_baskets("p_type"), q.TYPE_SUPPORT, 5),
        "son_itemsets": _itemsets(_order_baskets("p_type"), q.TYPE_SUPPORT, 5),
        "minhash_signatures": f"""WITH {_signatures()}
SELECT business_id, n_members, {" || ',' || ".join(f"h{i}" for i in range(q.BANDS * q.ROWS))}
  AS signature FROM sigs""",
        "lsh_candidates": f"WITH {_candidates()} SELECT b1, b2 FROM candidates",
        "similar_pairs": f"WITH {_candidates()} {_verified('candidates')}",
        "jaccard_pairs_exact": f"""WITH {MEMBERS}, pairs AS (
  SELECT DISTINCT x.business_id AS b1, y.business_id AS b2 FROM members x
  JOIN members y ON x.user_id = y.user_id AND x.business_id < y.business_id)
{_verified('pairs')}""",
        "near_duplicate_documents": NEAR_DUPLICATES,
        "similar_documents_exact": NEAR_DUPLICATES,
        "corated_pairs": f"{PAIR_SUMS} SELECT b1, b2, n FROM sums",
        "pearson_weights": f"{MODEL} SELECT b1, b2, round(sim, 6) AS sim FROM model",
        "corated_pairs_all": f"{ALL_PAIR_SUMS} SELECT b1, b2, n FROM sums",
        "pearson_weights_all": f"{_model(ALL_PAIR_SUMS)} SELECT b1, b2, round(sim, 6) AS sim FROM model",
        # There are five states in all, so pairs with more common keys have a common part.
        "hot_shared_keys": f"""WITH p AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS k FROM lineitem),
s AS (SELECT DISTINCT l_orderkey AS o, 's' || l_linestatus AS k FROM lineitem
      UNION SELECT l_orderkey, 'f' || l_returnflag FROM lineitem),
g AS (SELECT o, list(k) AS ks FROM s GROUP BY o),
c AS (SELECT x.o AS a, y.o AS b, count(*) AS n FROM p x JOIN p y ON x.k = y.k AND x.o < y.o GROUP BY 1, 2)
SELECT a, b, n + len(list_intersect(ga.ks, gb.ks)) AS n FROM c JOIN g ga ON ga.o = a JOIN g gb ON gb.o = b
WHERE n + len(list_intersect(ga.ks, gb.ks)) >= {q.HOT_SHARED}""",
        "cf_predict": f"""{PREDICT}
SELECT user_id, business_id, round(stars, 6) AS stars FROM predicted""",
        "cf_blend": f"""{PREDICT}
SELECT user_id, business_id, round((coalesce(um, g) + coalesce(im, g) + stars) / 3, 6) AS stars
FROM predicted LEFT JOIN user_mean USING (user_id) LEFT JOIN item_mean USING (business_id), overall""",
        "cf_rmse": f"""{PREDICT}
SELECT round(sqrt(avg((t.stars - p.stars) * (t.stars - p.stars))), 6) AS rmse
FROM test t JOIN predicted p ON t.user_id = p.user_id AND t.business_id = p.business_id""",
        "corating_edges": f"WITH {_edges(q.EDGE_THRESHOLD)} SELECT src, dst FROM edges",
        "corating_vertices": f"WITH {_edges(q.EDGE_THRESHOLD)} SELECT id FROM nodes",
        "label_propagation": f"{LABELS} SELECT node, label FROM l{q.LPA_ROUNDS}",
        "label_communities": f"""{LABELS}
SELECT min(node) AS community, count(*) AS size FROM l{q.LPA_ROUNDS} GROUP BY label""",
        "connected_components": f"{COMPONENTS} SELECT node, component FROM parts",
        "modularity": MODULARITY,
        "edge_betweenness": _betweenness(HOUR_EDGES, "(SELECT count(*) FROM nodes)"),
        "block_edges": f"WITH {BLOCK_EDGES} SELECT src, dst FROM edges",
        "block_label_propagation": f"WITH {BLOCK_EDGES}, {_label_rounds()} SELECT node, label FROM l{q.LPA_ROUNDS}",
        "dense_ids": "SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code FROM (SELECT DISTINCT c_name FROM customer)",
        "coded_components": f"""{_components(BLOCK_EDGES)}
SELECT 'u' || lpad(node::VARCHAR, 12, '0') AS node, 'u' || lpad(component::VARCHAR, 12, '0') AS component FROM parts""",
        "block_components": f"{_components(BLOCK_EDGES)} SELECT node, component FROM parts",
        # A component lies in a block of 150 customers.
        "block_betweenness": _betweenness(BLOCK_EDGES, "150"),
        "block_jaccard_pairs": f"""WITH {REVIEWS},
had AS (SELECT DISTINCT user_id AS u, (user_id // 150) * 200 + business_id % 200 AS p FROM reviews),
n AS (SELECT u, count(*) AS n FROM had GROUP BY u),
c AS (SELECT x.u AS b1, y.u AS b2, count(*) AS c FROM had x JOIN had y ON x.p = y.p AND x.u < y.u GROUP BY 1, 2)
SELECT b1, b2, round(c / (a.n + b.n - c), 6) AS sim FROM c JOIN n a ON a.u = b1 JOIN n b ON b.u = b2
WHERE c / (a.n + b.n - c) >= {q.BLOCK_JACCARD}""",
        "cluster_stats": f"""WITH {_points()},
{_stats("points WHERE kind = 'core'", "centre", 3)} {_long_stats(3)}""",
        "cluster_stats_all": f"""WITH {_points()}, {_stats("points", "centre", 3)} {_long_stats(3)}""",
        "wide_cluster_stats": f"WITH {WIDE}, {_stats('wide', 'label', 64)} {_long_stats(64)}",
        "cluster_stats_shifted": f"WITH {_points()} " + " UNION ALL ".join(
            f"SELECT centre AS cluster, {j} AS dim, count(*) AS n, round(avg(f{j} + {q.SHIFT}) - {q.SHIFT}, 3) AS mean, "
            f"round(stddev_pop(f{j} + {q.SHIFT}), 4) AS std FROM points GROUP BY centre"
            for j in range(3)
        ),
        "cs_greedy_merges": f"WITH RECURSIVE {_small_groups()} SELECT first, second FROM walk WHERE taken",
        "cs_merged_stats": f"""WITH RECURSIVE {_small_groups()},
names AS (SELECT grp, coalesce(min(w.first), grp) AS merged FROM (SELECT DISTINCT grp FROM grouped) g
  LEFT JOIN walk w ON w.taken AND grp IN (w.first, w.second) GROUP BY grp) """
        + " UNION ALL ".join(
            f"SELECT merged AS cluster, {j} AS dim, count(*) AS n, round(avg(f{j}), 6) AS mean, "
            f"round(stddev_pop(f{j}), 6) AS std FROM grouped JOIN names USING (grp) GROUP BY merged"
            for j in range(3)
        ),
        "mahalanobis_assign": f"""WITH {_points()},
{_stats("points WHERE kind = 'core'", "centre", 3)},
near AS (SELECT point_id, CAST(cluster AS BIGINT) AS cluster, {_distance("f", "m", "s")} AS distance,
  row_number() OVER (PARTITION BY point_id ORDER BY {_distance("f", "m", "s")}, cluster) AS rn
  FROM points, stats)
SELECT point_id, CASE WHEN distance < {threshold} THEN cluster END AS cluster,
  round(distance, 5) AS distance FROM near WHERE rn = 1""",
        "mahalanobis_assign_shifted": f"""WITH {_points()},
{_stats("points WHERE kind = 'core'", "centre", 3)},
near AS (SELECT point_id, CAST(cluster AS BIGINT) AS cluster, {_distance("f", "m", "s")} AS distance,
  row_number() OVER (PARTITION BY point_id ORDER BY {_distance("f", "m", "s")}, cluster) AS rn
  FROM points, stats)
SELECT point_id, CASE WHEN distance < {threshold} THEN cluster END AS cluster FROM near WHERE rn = 1""",
        "cs_merge_pairs": f"""WITH {_points()},
grouped AS (SELECT *, centre * 2 + CASE WHEN kind = 'mini' THEN 1 ELSE 0 END AS grp
            FROM points WHERE kind <> 'scatter'),
{_stats("grouped", "grp", 3)},
far AS (SELECT a.cluster AS first, b.cluster AS second, {_distance("b.m", "a.m", "a.s")} AS distance
  FROM stats a JOIN stats b ON a.cluster < b.cluster)
SELECT first, second, round(distance, 5) AS distance FROM far
WHERE distance < {q.MERGE_THRESHOLD}""",
        "id_bins": f"SELECT c_custkey AS user_id, {_id_bin('c_custkey')} AS user_bin FROM customer",
        "feature_frame": FEATURE_FRAME,
        "unseen_rows": f"""WITH {REVIEWS}, {TRAIN}, {TEST}
SELECT count(*) AS n_rows, count(*) FILTER (user_id NOT IN (SELECT user_id FROM train)
  OR business_id NOT IN (SELECT business_id FROM train)) AS n_unseen FROM test""",
    }
