"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted intersections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.graph import connected_components
from .common import BLANKS, WORD, attach, bounded, dealt, stored, text_of, wrapped

SHINGLE_WORDS = 3
PERCENT = 90
# Rounds in which the members of a tile are compared with one of them, before all others are.
STAR_ROUNDS = 2
# Tiles are compared in blocks of so many members.
BLOCK = 512
BATCH_ROWS = 512
WORDS_PER_BITMAP = 4
# Parts more for each part of one element or none that a set is expected to have.
SPARE = 1.2
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers, one to one."""
    h = (h ^ (h >> np.uint64(30))) * M2
    h = (h ^ (h >> np.uint64(27))) * M3
    return h ^ (h >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased and no other letter changed."""
    raw = text.encode().lower()
    for c in BLANKS[1:].encode():
        raw = raw.replace(bytes([c]), b" ")
    return [w for w in raw.split(b" ") if w]


class Shingler:
    """Sorted 64-bit hashes of the distinct word runs of texts; words are hashed once a batch."""

    def __init__(self, n: int = SHINGLE_WORDS):
        self.n, self.known = n, {}

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        import xxhash

        words = [words_of(t) for t in texts]
        known: dict[bytes, int] = {}
        for ws in words:
            for w in ws:
                if w not in known:
                    known[w] = len(known)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
        for ws in words:
            codes = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
            yield self.shingles(hashes[codes])

    def shingles(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return h
        # A text with fewer words than a run is one run, told apart by its length.
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = mixed(out * M1 + h[k : k + len(out)])
        return np.unique(out)


def band_tops(largest: int, percent: int = PERCENT) -> list[int]:
    """Greatest size of each band. Sets whose sizes allow the similarity are in one band or two
    neighbouring ones."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return [*tops, max(tops[-1] + 1, tops[-1] * 100 // percent)]


def differing(both: int, percent: int = PERCENT) -> int:
    """Most elements that two sets of together `both` elements may not share: at similarity p they
    share p / (1 + p) of them at least."""
    return both * (100 - percent) // (100 + percent)


def tile_keys(s: np.ndarray, tops: list[int], percent: int) -> np.ndarray:
    """Keys of a set's tiles.

    For two neighbouring bands, elements are dealt by hash to more parts than sets of these bands
    may differ in, so similar sets have the same elements in at least `alike` parts. A tile is a pair
    of bands, a part and its elements. Where no difference is allowed there are no tiles.

    Parts of one element or none are what unlike sets have in common. A set leaves `alike` - 1 of them
    out, the last ones in an order by their names: two sets that are alike in these parts only have `alike` of
    them in common, and so still one of the others. `parts` are as many more as sets have of them.
    """
    out = []
    band = int(np.searchsorted(tops, len(s)))
    spread = mixed(s + M1)
    for low in (band, band - 1):
        if low < 0:
            continue
        differ = differing(tops[low] + tops[low + 1], percent)
        parts = differ + 1
        if parts < 2:
            continue
        held = tops[low] / parts
        parts += int(SPARE * parts * (1 + held) * np.exp(-held))
        alike = parts - differ
        part = (spread >> np.uint64(33)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        counts = np.bincount(part.astype(np.int64), minlength=parts)
        sums = np.zeros(parts, np.uint64)
        full = counts > 0
        starts = (np.cumsum(counts) - counts)[full]
        sums[full] = np.add.reduceat(mixed(spread[order] ^ M3), starts)
        names = np.arange(parts, dtype=np.uint64) * M2 + np.full(1, low + 1, np.uint64) * M1
        keys = mixed(mixed(sums + names) ^ names)
        if alike > 1:
            light = np.flatnonzero(counts < 2)
            # Elements come before empty parts, which all sets may share.
            light = light[np.lexsort((keys[light], 1 - counts[light]))]
            keys = np.delete(keys, light[max(0, len(light) - alike + 1) :])
        out.append(keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def bitmap(s: np.ndarray) -> np.ndarray:
    """256 bits, each the parity of the elements that hash to it: where two bitmaps differ, so do
    the sets, and at least as often."""
    bits = np.bincount((mixed(s ^ M2) >> np.uint64(56)).astype(np.int64), minlength=64 * WORDS_PER_BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, key, b0..b3, tiles) of every row: set size, 128-bit name of the set, bitmap and
    tile keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler = Shingler(n)
        tops = band_tops(1 << 10, percent)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                b = batch.slice(k, BATCH_ROWS)
                sizes, keys, maps, tiles = [], [], [], []
                for s in shingler.batch(b.column(1).to_pylist()):
                    if len(s) > tops[-2]:
                        tops = band_tops(2 * len(s), percent)
                    sizes.append(len(s))
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    maps.append(bitmap(s))
                    tiles.append(tile_keys(s, tops, percent).view(np.int64))
                columns = np.stack(maps).T if maps else np.zeros((WORDS_PER_BITMAP, 0), np.int64)
                ends = np.cumsum([0, *map(len, tiles)])
                flat = np.concatenate([np.zeros(0, np.int64), *tiles])
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        *(pa.array(np.ascontiguousarray(c)) for c in columns),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    ],
                    ["doc_id", "n", "key", *BITS, "tiles"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    bits = ", ".join(f"{c} bigint" for c in BITS)
    return dealt(rows).mapInArrow(run, f"doc_id {kind}, n bigint, key binary, {bits}, tiles array<bigint>")


BITS = [f"b{i}" for i in range(WORDS_PER_BITMAP)]


def may_match(percent: int) -> Column:
    """Bound for a pair of columns a_*, b_*: the overlap is at most half of the sizes less the
    bits that differ."""
    far = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))).cast("bigint") for c in BITS), F.lit(0))
    most = F.floor((F.col("a_n") + F.col("b_n") - far) / 2)
    return 100 * most >= percent * (F.col("a_n") + F.col("b_n") - most)


def parity_map(s: np.ndarray) -> bytes:
    """As `bitmap`, with four to eight bits per element, so that it tells large sets apart too."""
    bits = 1 << max(6, (4 * len(s) - 1).bit_length())
    parity = np.bincount((mixed(s ^ M3) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def differing_bits(x: bytes, y: bytes) -> int:
    """Bits in which two maps differ; the longer one is folded first, half upon half."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """(node, s): the sorted hashes of each row's set, eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                b = batch.slice(k, BATCH_ROWS)
                raw = [s.tobytes() for s in shingler.batch(b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], ["node", "s"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("t")).mapInArrow(run, f"node {kind}, s binary")


def shingle_maps(docs: DataFrame, n: int) -> DataFrame:
    """(node, n, m): the size of each row's set and its map, a tenth of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                b = batch.slice(k, BATCH_ROWS)
                sizes, maps = [], []
                for s in shingler.batch(b.column(1).to_pylist()):
                    sizes.append(len(s))
                    maps.append(parity_map(s))
                columns = [b.column(0), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "m"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("t")).mapInArrow(run, f"node {kind}, n bigint, m binary")


def of_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is among `nodes` (doc_id)."""
    return dealt(docs.join(bounded(stored(nodes.distinct(), "wanted")), "doc_id", "left_semi"))


def narrowed(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the maps allow; sets are made and moved for these alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, nx, y, ny in zip(*(b.column(i).to_pylist() for i in range(2, 6))):
                most = (nx + ny - differing_bits(x, y)) // 2
                good.append(100 * most >= percent * (nx + ny - most))
            yield b.select([0, 1]).filter(pa.array(good, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    side = lambda p: maps.select(F.col("node").alias(p), F.col("m").alias(f"m_{p}"), F.col("n").alias(f"n_{p}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "m_a", "n_a", "m_b", "n_b")
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by merging the two sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column(2), b.column(3)):
                both = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= percent * (len(both) - shared))
            yield b.select([0, 1]).filter(pa.array(good, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def bounded_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) that the bitmaps allow."""
    named = lambda p: nodes.select(F.col("node").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in ("n", *BITS)])
    both = pairs.distinct().join(named("a"), "a").join(named("b"), "b")
    return both.where(may_match(percent)).select("a", "b")


def star_pairs(members: DataFrame, salt: int) -> DataFrame:
    """(a, b): each member of a tile with the tile's pivot, if they aren't linked yet. The first pivot
    is the smallest id, later ones follow a hash."""
    order = F.col("node") if not salt else F.struct(F.xxhash64("node", F.lit(salt)), F.col("node"))
    first = members.groupBy("tile").agg(
        F.min(F.struct(order.alias("o"), "node", "component")).alias("p"),
        F.min("component").alias("c0"),
        F.max("component").alias("c1"),
    )
    pivots = first.where("c0 <> c1").select("tile", F.col("p.node").alias("pivot"), F.col("p.component").alias("pc"))
    joined = members.join(pivots, "tile").where(F.col("component") != F.col("pc"))
    return joined.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))


def other_pairs(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): all members of a tile that aren't linked yet and that the bitmaps allow. A tile is
    cut into blocks and each pair of blocks is a key of its own."""
    sizes = members.groupBy("tile").agg(
        F.count(F.lit(1)).alias("m"), F.min("component").alias("c0"), F.max("component").alias("c1")
    )
    # Two members were compared as pivot and member.
    open_tiles = sizes.where("c0 <> c1 and m > 2").select("tile", F.ceil(F.col("m") / BLOCK).alias("k"))
    rows = members.join(open_tiles, "tile").join(nodes, "node")
    rows = rows.withColumn("i", F.pmod(F.xxhash64("node", F.lit(7)), F.col("k")))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)))
    own = ["node", "component", "n", *BITS]
    keys = [F.col("tile"), F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi")]
    side = lambda p: [F.col(c).alias(f"{p}_{c}") for c in own]
    a = rows.where("i <= j").select(*keys, *side("a"))
    b = rows.where("i >= j").select(*keys, *side("b"))
    inside = (F.col("lo") < F.col("hi")) | (F.col("a_node") < F.col("b_node"))
    apart = (F.col("a_component") != F.col("b_component")) & inside & may_match(percent)
    found = a.join(b, ["tile", "lo", "hi"]).where(apart)
    return found.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def similar_components(docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    Two documents link when 100 * intersection >= `percent` * union of their distinct `n`-word runs;
    a text with fewer words is one run, one without words (or null) has none and links with nothing.
    component_id is the smallest doc_id reachable by links. Rows of one id are one node; rows
    without an id link with nothing and have no component. Other columns are ignored; an empty
    table gives no rows.

    Equal sets are one node from the start. Nodes that share a tile are compared: first with a pivot,
    twice, so that groups of copies become one component with as many comparisons as members; then
    every pair of a tile that is still in two components. No pair is left out but such
    as are connected already.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(sketches(docs, n, percent), "sketches")
    total = rows.count()
    named = rows.where("n > 0 and doc_id is not null")
    classes = stored(
        named.groupBy("key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("group_size")), "classes"
    )
    copies = stored(named.join(classes.where("group_size > 1"), "key").where(F.col("doc_id") != F.col("node")).select("doc_id", "key").distinct(), "copies")
    own = named.join(bounded(copies), ["doc_id", "key"], "left_anti")
    postings = own.select(F.explode("tiles").alias("tile"), F.col("doc_id").alias("node"))
    if percent < PERCENT:
        # Lower similarities have more tiles: they are dealt out once, for the sums and for the join.
        postings = postings.repartition("tile")
    shared = postings.groupBy("tile").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = stored(postings.join(shared.select("tile"), "tile").distinct(), "members")
    nodes = own.join(members.select("node").distinct(), own["doc_id"] == F.col("node"), "left_semi")
    nodes = stored(nodes.select(F.col("doc_id").alias("node"), "n", *BITS).distinct(), "nodes")
    # Rows of one id with different texts are tied together first.
    split = named.join(classes, "key").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    links = stored(split.where("a < b").select("a", "b"), "links")
    sets = maps = None
    for step in range(STAR_ROUNDS + 1):
        parts = components(links).withColumnRenamed("id", "node")
        known = members.join(parts, "node", "left")
        known = stored(known.select("tile", "node", F.coalesce("component", "node").alias("component")), "known")
        if step < STAR_ROUNDS:
            pairs = bounded_pairs(star_pairs(known, step), nodes, percent)
        else:
            pairs = other_pairs(known, nodes, percent)
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            continue
        if percent < PERCENT:
            # The short bitmaps of the nodes tell little where sets may differ in more elements than bits.
            if maps is None:
                maps = stored(shingle_maps(of_nodes(docs, members.select(F.col("node").alias("doc_id"))), n), "maps")
            pairs = stored(narrowed(pairs, maps, percent), "narrowed")
            if pairs.isEmpty():
                continue
            sets = stored(shingle_sets(of_nodes(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), n), "sets")
        elif sets is None:
            sets = stored(shingle_sets(of_nodes(docs, members.select(F.col("node").alias("doc_id"))), n), "sets")
        links = stored(links.unionByName(verified(pairs, sets, percent)), "links")
    parts = components(links)
    groups = classes.join(parts.withColumnRenamed("id", "node"), "node", "left")
    groups = groups.select("key", F.coalesce("component", "node").alias("component_id"), "group_size")
    done = attach(named.select("doc_id", "n", "key"), groups, "key", max(total, 1))
    rest = rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return done.select("doc_id", "n", "component_id").unionByName(rest).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the linked nodes."""
    edges = links.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
    found = connected_components(edges)
    return found.select(F.col("node").alias("id"), "component")


# What near-duplicate stages take: longer runs, and sets that are alike to a lesser degree.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def one_of_each(docs: DataFrame, n: int = NEAR_WORDS, percent: int = NEAR_PERCENT) -> DataFrame:
    """The rows of `docs` but for those that are similar to one that stays: of each component the row
    with the smallest id.

    Rows of one id with different texts are documents of their own, known apart by a hash; of these
    the smallest hash comes first. Of rows with the same id and the same text, in whatever other
    columns they differ, the first in the order of their JSON form stays. Rows without an id or
    without words all stay. An empty table gives no rows.
    """
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    if again.isEmpty():
        found = similar_components(docs, n, percent)
        gone = stored(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "gone")
        return docs.join(bounded(gone), "doc_id", "left_anti").select(*docs.columns)
    key = F.struct("doc_id", F.xxhash64("text").alias("h"))
    rows = wrapped(docs, key=F.when(F.col("doc_id").isNotNull(), key), text=F.col("text"))
    found = similar_components(rows, n, percent, "key")
    gone = stored(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("key")).distinct(), "gone")
    left = rows.join(bounded(gone), "key", "left_anti")
    worded = left.where(F.col("key").isNotNull() & F.rlike(text_of(), F.lit(WORD)))
    copies = stored(worded.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "copies")
    once = worded.join(bounded(copies), "key", "left_semi").groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    rest = left.where(F.col("key").isNull() | ~F.rlike(text_of(), F.lit(WORD)))
    kept = worded.join(bounded(copies), "key", "left_anti").select("row").unionByName(once.select("row"))
    return kept.unionByName(rest.select("row")).select("row.*")
