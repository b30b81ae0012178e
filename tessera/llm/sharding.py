"""Shards of equal row counts that keep linked documents together: balanced label propagation."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F, Window

from .common import BUCKET_DIGITS, order_hash, prefix_sum, stored, text_of

N_SHARDS = 40


def linked_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, crc, hub): documents with equal texts meet at a hub, so a group of m
    copies has m links and not m * m."""
    t = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(t) + 16).cast("bigint").alias("size"),
        F.crc32(t.cast("binary")).alias("crc"),
        F.xxhash64(t).alias("hub"),
    )


def quotas(rows: int, n: int) -> list[int]:
    return [rows // n + (s < rows % n) for s in range(n)]


def loads(state: DataFrame, n: int) -> list[int]:
    """Linked rows per shard: n numbers."""
    out = [0] * n
    for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
        out[r["shard"]] = r["n"]
    return out


def propagate(state: DataFrame, quota: list[int]) -> tuple[DataFrame, int]:
    """One round over state(row, hub, shard): rows move to shards with room that hold more of their
    hub than their own does. Returns the state and the rows moved.

    A hub's weakest blocks fill the room of its strongest shards, one after the other. A block in a
    full shard that is stronger than all with room goes to the strongest of these, if more of it
    goes than it is ahead by. So the sum of the squares of a hub's blocks grows with every move,
    and rounds come to an end; a round without moves has no wish left.

    Where rows come from and want to go is decided per (hub, shard), of which a hub has at most as
    many as there are shards. Room is given out along running sums, so no shard exceeds its quota
    and no group is gathered; of a block that goes in part or to several shards, rows go by hash.
    """
    n = len(quota)
    load = loads(state, n)
    room = F.element_at(F.array(*[F.lit(q - x) for q, x in zip(quota, load)]), F.col("shard") + 1)
    blocks = state.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.withColumns({"room": room.cast("bigint"), "tie": F.xxhash64("hub", "shard")})
    hub = Window.partitionBy("hub")
    down = hub.orderBy(F.desc("n"), F.desc("tie"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    up = hub.orderBy("n", "tie", F.desc("shard")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns(
        {
            "rank": F.count(F.lit(1)).over(down),
            "taken": F.coalesce(F.sum(F.greatest("room", F.lit(0))).over(down), F.lit(0)),
            "weaker": F.coalesce(F.sum("n").over(up), F.lit(0)),
        }
    )
    blocks = stored(blocks, "blocks")
    goals = blocks.where("room > 0").select(
        "hub", F.col("shard").alias("to"), F.col("n").alias("to_n"), "room", "taken", F.col("rank").alias("to_rank")
    )
    pairs = blocks.select("hub", "shard", "n", "weaker", "rank").join(goals, "hub").where("rank <> to_rank")
    rises = F.col("rank") > F.col("to_rank")
    overlap = F.least(F.col("weaker") + F.col("n"), F.col("taken") + F.col("room")) - F.greatest("weaker", "taken")
    # Without room in a stronger shard, `taken` is 0.
    first = F.when(F.col("taken") == 0, F.least("n", "room"))
    wishes = (
        pairs.withColumn("wish", F.when(rises, overlap).otherwise(first))
        .withColumn("least", F.when(rises, F.lit(0)).otherwise(F.col("n") - F.col("to_n")))
        .where("wish > 0 and wish > least")
        .select("hub", "shard", "n", "to", "room", "wish", "least", rises.alias("rises"), order_hash("hub").alias("_by"))
    )
    # Moves to stronger blocks come first, so the first wish for a shard is granted in any case.
    bucket = F.concat(F.when(F.col("rises"), "0").otherwise("1"), F.substring("_by", 1, BUCKET_DIGITS))
    granted = (
        prefix_sum(wishes, ["to"], ["_by", "hub", "shard"], F.col("wish"), "before", bucket)
        .withColumn("grant", F.least(F.col("wish"), F.col("room") - F.col("before")))
        .where("grant > 0 and grant > least")
        .withColumn("upto", F.sum("grant").over(Window.partitionBy("hub", "shard").orderBy("to")))
        .groupBy("hub", "shard")
        .agg(
            F.first("n").alias("n"),
            F.sum("grant").alias("grant"),
            F.sort_array(F.collect_list(F.struct("upto", "to"))).alias("ways"),
        )
    )
    granted = stored(granted, "granted")
    joined = state.join(granted, ["hub", "shard"], "left")
    whole = F.col("grant").isNull() | ((F.col("grant") == F.col("n")) & (F.size("ways") == 1))
    rest = joined.where(whole).withColumn("to", F.col("ways")[0]["to"])
    part = joined.where(~whole).withColumn("_by", order_hash("row"))
    part = prefix_sum(part, ["hub", "shard"], ["_by", "row"], F.lit(1), "at")
    way = F.filter("ways", lambda w: F.col("at") < w["upto"])
    part = part.withColumn("to", F.get(way, F.lit(0))["to"]).drop("_by", "at")
    moved = rest.unionByName(part).select("row", "hub", F.coalesce("to", "shard").alias("shard"))
    total = granted.agg(F.coalesce(F.sum("grant"), F.lit(0))).first()[0]
    return (stored(moved, "state") if total else state), total


def balanced_shards(docs: DataFrame, n: int = N_SHARDS, rounds: int | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard, linked.

    Shards 0 to n - 1 hold row counts that differ by one at most (law `rows`). Rows start in turn
    along a hash order; rows whose text another row has too are moved by label propagation under
    the shards' quotas until nothing moves, or for at most `rounds` rounds if they are given; rows
    without links fill what is left. Null texts count as empty. Repeated
    rows, also of one id, are rows of their own, linked by their text. An empty table gives none.
    """
    rows = linked_rows(docs).withColumn("_by", order_hash("doc_id", "hub"))
    rows = prefix_sum(stored(rows, "rows"), [], ["_by", "doc_id", "hub"], F.lit(1), "row").drop("_by")
    rows = stored(rows, "numbered")
    total = rows.count()
    quota = quotas(total, n)
    hubs = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub")
    start = (F.col("row") % n).cast("int").alias("shard")
    state = stored(rows.join(hubs, "hub", "left_semi").select("row", "hub", start), "state")
    for _ in count() if rounds is None else range(rounds):
        state, moved = propagate(state, quota)
        if not moved:
            break
    free = [q - x for q, x in zip(quota, loads(state, n))]
    ends = [sum(free[: s + 1]) for s in range(n)]
    alone = rows.join(state.select("row"), "row", "left_anti").withColumn("_by", order_hash("row"))
    alone = prefix_sum(alone, [], ["_by", "row"], F.lit(1), "at")
    passed = F.filter(F.array(*[F.lit(e).cast("bigint") for e in ends]), lambda e: e <= F.col("at"))
    filled = alone.withColumn("shard", F.size(passed)).withColumn("linked", F.lit(False)).drop("_by", "at")
    kept = rows.join(state.select("row", "shard"), "row").withColumn("linked", F.lit(True))
    placed = filled.unionByName(kept).withColumn("_by", order_hash("row"))
    return prefix_sum(placed, ["shard"], ["_by", "row"], F.lit(1), "slot").select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "linked",
    )
