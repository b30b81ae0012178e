"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANK, WORD, bounded, order_hash, ordered_number, prefix_sum, stored, text_of, wrapped

# Weights repeat along the ordered sources, and how often a word may be taken.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Words per block, fewer in a small corpus so that it still has MIN_SLOTS blocks.
BLOCK_WORDS = 2048
MIN_SLOTS = 100_000
SEED = "mix"
# 2^32 over the golden ratio, odd: its multiples mod 2^32 are spread evenly at every length.
GOLDEN, CIRCLE, PERIOD = 2654435769, 1 << 32, 1 << 31


@dataclass
class Mix:
    """sources(rank, source_size, weight, target, take), docs(doc_id, source, rank, size, start),
    schedule(rank, block, slot), and the words per block.
    docs also has h, a hash of the text."""

    sources: DataFrame
    docs: DataFrame
    schedule: DataFrame
    block: int


def level(sources: DataFrame) -> float:
    """The words per unit of weight at which all targets, each at most MAX_REPEATS times its
    source, add up to the corpus. Each round is one sum over the sources; a source that reaches
    its limit stays there, so there are no more rounds than limited sources."""
    limit = F.col("source_size") * MAX_REPEATS
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    current, seen = 0.0, -1
    while total:
        above = limit < current * F.col("weight")
        n, spent, weight = sources.agg(
            F.sum(above.cast("int")),
            F.sum(F.when(above, limit).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if n == seen:
            break
        seen, current = n, (total - spent) / weight
    return current


def with_targets(sizes: DataFrame) -> DataFrame:
    """sizes(source, source_size) with rank by code point (null last), weight, target and the
    whole words to take."""
    ranked = stored(ordered_number(sizes, [F.col("source").asc_nulls_last()], "rank"), "sources")
    weighted = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    limit = (F.col("source_size") * MAX_REPEATS).cast("double")
    target = F.least(limit, F.lit(level(weighted)) * F.col("weight"))
    return weighted.withColumn("target", target).withColumn("take", F.round("target").cast("bigint"))


def make_schedule(sources: DataFrame, block: int) -> DataFrame:
    """(rank, block, slot): every block that a source owes, in the order of the mix.

    Golden-ratio points fall into the sources' shares of the circle; a source's k-th slot is for
    its block k. Points and shares meet in cells, so neither side is broadcast and many sources
    cost no more than few. Slots above a source's quota are left out, missing ones come last.
    """
    spark = sources.sparkSession
    owed = stored(sources.select("rank", "take", F.ceil(F.col("take") / block).alias("quota")).where("quota > 0"), "quotas")
    n_sources, words, slots = owed.agg(F.count(F.lit(1)), F.sum("take"), F.sum("quota")).first()
    slots = slots or 0
    shift = 32 - min(32, max(12, (n_sources or 1).bit_length()))
    at = prefix_sum(owed.withColumn("_by", order_hash("rank")), [], ["_by", "rank"], F.col("take"), "before")
    edge = lambda c: F.floor(c.cast("double") / (words or 1) * CIRCLE).cast("bigint")
    shares = at.select("rank", "quota", edge(F.col("before")).alias("low"), edge(F.col("before") + F.col("take")).alias("high")).where("high > low")
    cells = shares.withColumn("cell", F.explode(F.expr(f"sequence(shiftright(low, {shift}), shiftright(high - 1, {shift}))")))
    points = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"(id % {PERIOD}) * {GOLDEN} % {CIRCLE}").alias("x"))
    points = points.withColumn("cell", F.shiftright("x", shift))
    hits = points.join(cells, "cell").where("x >= low and x < high").select("rank", "quota", "slot")
    width = max(1, -(-slots // 4096))
    numbered = prefix_sum(hits, ["rank"], ["slot"], F.lit(1), "block", F.expr(f"slot div {width}"))
    used = stored(numbered.where("block < quota").select("rank", "block", "slot"), "slots")
    filled = used.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    late = (
        owed.join(filled, "rank", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .where("n < quota")
        .select("rank", F.explode(F.expr("sequence(n, quota - 1)")).alias("block"))
        .select("rank", "block", (F.lit(slots) + F.col("block") * max(1, n_sources or 1) + F.col("rank")).alias("slot"))
    )
    return used.unionByName(late)


def source_key(column: str) -> Column:
    """A name that is never null, and differs for null and for the empty string."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """Sizes, targets, shuffled streams and the schedule for a corpus.

    A source's documents follow each other in the order of a hash; that stream is repeated up to
    three times and cut into blocks of equally many words. Null texts have no words, null is a source
    of its own and comes last. Rows that repeat an id are separate documents; equal ones are
    interchangeable.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("bigint").alias("size"),
            F.xxhash64(text_of(text_col)).alias("h"),
        ),
        "sizes",
    )
    sources = stored(with_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block = max(1, min(BLOCK_WORDS, words // MIN_SLOTS))
    ranks = sources.select(source_key("source").alias("_s"), "rank")
    keyed = rows.withColumn("_s", source_key("source")).join(bounded(ranks), "_s").drop("_s")
    keyed = keyed.withColumn("_by", order_hash("doc_id", F.lit(SEED)))
    placed = prefix_sum(keyed, ["rank"], ["_by", "doc_id", "size"], F.col("size"), "start").drop("_by")
    return Mix(sources, placed, make_schedule(sources, block), block)


def pieces(m: Mix) -> DataFrame:
    """(doc columns, repeat, slot, from_word, to_word): what each slot takes, word positions within
    the document. Documents meet slots on (source rank, block), which no hot source dominates."""
    s = m.sources.select("rank", "source_size", "target", "take")
    runs = (
        m.docs.where("size > 0")
        .join(bounded(s), "rank")
        .where("take > 0")
        .withColumn("repeat", F.explode(F.expr("sequence(0, (take - 1) div source_size)")))
        .withColumn("first", F.expr("repeat * source_size + start"))
        .withColumn("last", F.expr("least(first + size, take)"))
        .where("first < last")
        .withColumn("block", F.explode(F.expr(f"sequence(first div {m.block}, (last - 1) div {m.block})")))
    )
    return runs.join(m.schedule, ["rank", "block"]).select(
        "doc_id",
        "rank",
        "size",
        "start",
        "repeat",
        "slot",
        F.expr(f"greatest(first, block * {m.block}) - first").alias("from_word"),
        F.expr(f"least(last, (block + 1) * {m.block}) - first").alias("to_word"),
    )


def taken(m: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken. A document with words is
    known by its place (rank, start) in its source's stream."""
    per = pieces(m).groupBy("rank", "start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("t"))
    s = m.sources.select("rank", "source_size", "target")
    words = m.docs.where("size > 0").join(per, ["rank", "start"], "left")
    none = m.docs.where("size = 0").withColumn("t", F.lit(0).cast("bigint"))
    return (
        words.unionByName(none)
        .join(bounded(s), "rank")
        .select("doc_id", "size", "source_size", "target", F.coalesce("t", F.lit(0)).cast("bigint").alias("taken"))
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: one row with the columns of `docs` per document and repeat, sorted by
    the slot in which it begins. The document at which a source's last repeat ends is cut after
    the words that were taken; documents without words are not in the mix."""
    m = mix(docs)
    lengths = F.sum(F.col("to_word") - F.col("from_word")).alias("words")
    runs = pieces(m).groupBy("rank", "start", "repeat").agg(F.min("slot").alias("slot"), lengths)
    # One plain column that is never null, so that the window and the join share their partitioning: a
    # struct's fields may be null on one side only, and the cast of it would shuffle the texts once more.
    key = F.concat_ws("/", source_key("doc_id"), F.col("rank").cast("string"), F.col("h").cast("string"))
    nth = F.dense_rank().over(Window.partitionBy("k").orderBy("start")).alias("nth")
    known = m.docs.where("size > 0").withColumn("k", key).select("k", "rank", "start", nth).join(runs, ["rank", "start"])
    known = known.groupBy("k").agg(F.collect_list(F.struct("nth", "slot", "words")).alias("runs"))
    ranks = m.sources.select(source_key("source").alias("s"), "rank")
    size = F.regexp_count(text_of(), F.lit(WORD)).cast("bigint")
    rows = wrapped(docs, doc_id=F.col("doc_id"), text=F.col("text"), s=source_key("source"), h=F.xxhash64(text_of()), size=size)
    # Rows with the same id, source and text are told apart by a number.
    equal = Window.partitionBy("k").orderBy("size")
    rows = rows.where("size > 0").join(bounded(ranks), "s").withColumn("k", key).withColumn("no", F.row_number().over(equal))
    out = rows.join(known, "k").withColumn("run", F.explode(F.expr("filter(runs, r -> r.nth = no)")))
    each = F.regexp_extract_all("text", F.lit(f"{BLANK[:-1]}*{WORD}"), F.lit(0))
    head = F.array_join(F.slice(each, F.lit(1), F.col("run.words").cast("int")), "")
    out = out.withColumn("cut", F.when(F.col("run.words") < F.col("size"), head).otherwise(F.col("text")))
    out = out.select("row", "cut", "doc_id", F.col("run.slot").alias("slot"))
    out = out.repartitionByRange("slot").sortWithinPartitions("slot", "doc_id")
    return out.select(*[F.col("cut" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])
