"""Secret scans with a ledger of blobs: each text is scanned once per rule version."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import BROADCAST_ROWS, dealt, stored, text_of


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost matches that don't overlap count if `group` is long enough."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


def either_case(words: str) -> str:
    """ASCII letters in either case; the flag would let other letters match too."""
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


# The kinds in their order, the patterns and the least lengths.
RULES = (
    Rule("assign", 1, "(" + either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, "[0-9a-f]+", 0, 16),
)
KIND_ORDER = {r.kind: i for i, r in enumerate(RULES)}


def compiled(rule: Rule) -> re.Pattern:
    """Of a pattern that is one run of a character class, shorter runs need not be looked at: a
    run is matched whole or not at all."""
    if rule.group == 0 and rule.pattern.endswith("]+"):
        head = re.match(r"[A-Za-z0-9]*", rule.pattern)[0]
        return re.compile(f"{rule.pattern[:-1]}{{{rule.least - len(head)},}}")
    return re.compile(rule.pattern)


class Ledger:
    """What was scanned: (blob, kind, version, spans) in a folder that all executors share.

    A load is appended as a whole. If a load is lost half-way its rows are not seen, and the next
    run scans its blobs again; a blob that was entered twice is read once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        schema = "blob string, kind string, version int, spans array<struct<start:bigint,end:bigint>>"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def add(self, found: DataFrame) -> None:
        found.write.mode("append").option("compression", "zstd").parquet(self.path)


def with_blobs(versions: DataFrame, text_col: str = "text") -> DataFrame:
    """`versions` with `blob`, the digest of the text; null counts as empty."""
    return versions.withColumn("blob", F.sha2(text_of(text_col), 256))


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kinds): blobs with the rules that have not scanned them in their present version."""
    done = None
    for r in rules:
        one = ledger.where((F.col("kind") == r.kind) & (F.col("version") == r.version)).select("blob", "kind")
        done = one if done is None else done.unionByName(one)
    seen = done.groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    left = blobs.join(seen, "blob", "left").select(
        "blob", F.array_except(kinds, F.coalesce("seen", F.array().cast("array<string>"))).alias("kinds")
    )
    return left.where(F.size("kinds") > 0)


def scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, version, spans) of (blob, text, kinds): whole texts, in code points."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = {r.kind: (r, compiled(r)) for r in rules}
        names = ["blob", "kind", "version", "spans"]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        for b in batches:
            out: list[list] = [[], [], [], []]
            for blob, text, wanted in zip(*(b.column(i).to_pylist() for i in range(3))):
                for kind in wanted:
                    rule, pattern = patterns[kind]
                    spans = [
                        {"start": m.start(), "end": m.end()}
                        for m in pattern.finditer(text)
                        if m.end(rule.group) - m.start(rule.group) >= rule.least
                    ]
                    for to, v in zip(out, (blob, kind, rule.version, spans)):
                        to.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names)

    return texts.select("blob", "text", "kinds").mapInArrow(
        find, "blob string, kind string, version int, spans array<struct<start:bigint,end:bigint>>"
    )


def scan_new(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Scan what the ledger lacks, once per blob and rule version, and enter it.

    Of equal blobs the row with the smallest id is scanned. Texts stay where they are read: what is
    moved is the short list of rows to leave out, or of rows to scan, whichever is shorter. If that
    list is no longer bounded, the join shuffles.
    """
    path = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = with_blobs(versions.select(path.alias("doc_id"), F.col(text_col).alias("text")))
    slim = stored(rows.select("doc_id", "blob"), "blobs")
    least = slim.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    todo = unseen(slim.select("blob").distinct(), ledger.rows(), rules)
    chosen = stored(least.join(todo, "blob"), "to-scan")
    rest = slim.join(chosen.select("blob", "doc_id"), ["blob", "doc_id"], "left_anti").distinct()
    rest = stored(rest, "to-skip")
    n, m = chosen.count(), rest.count()
    same = chosen.select("kinds").distinct().limit(2).collect()
    key = ["blob", "doc_id"]
    if not n:
        return
    if m <= min(n, BROADCAST_ROWS) and len(same) == 1:
        kinds = F.array(*map(F.lit, same[0]["kinds"]))
        texts = rows.join(F.broadcast(rest), key, "left_anti").withColumn("kinds", kinds)
    else:
        texts = rows.join(F.broadcast(chosen) if n <= BROADCAST_ROWS else chosen, key)
    ledger.add(scan(dealt(texts.select("blob", text_of().alias("text"), "kinds")), rules).dropDuplicates(["blob", "kind"]))


def findings(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, blob, kind, start, end): every finding of the rules' versions, for every path that
    has the blob."""
    rows = with_blobs(versions.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "blob")
    return rows.join(flat(ledger.rows(), rules), "blob").select("doc_id", "blob", "kind", "start", "end")


def flat(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, start, end): the ledger's spans for the rules' present versions, each once."""
    now = F.lit(False)
    for r in rules:
        now = now | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    spans = rows.where(now & (F.size("spans") > 0)).select("blob", "kind", F.explode("spans").alias("s"))
    return spans.select("blob", "kind", F.col("s.start").alias("start"), F.col("s.end").alias("end")).distinct()


def scan_report(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of `versions`: doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob.

    Scans first what the ledger lacks. Spans are `kind:start:end` by start, then kind. Null and empty
    texts have none; repeated rows are reported each; other columns are ignored; an empty table gives
    no rows.
    """
    scan_new(versions, ledger, rules)
    rank = F.create_map(*[x for k, i in KIND_ORDER.items() for x in (F.lit(k), F.lit(i))])
    spans = flat(ledger.rows(), rules).withColumn("rank", rank[F.col("kind")])
    one = F.struct("start", "rank", "end", F.concat_ws(":", "kind", "start", "end").alias("s"))
    count = lambda kind: F.sum((F.col("kind") == kind).cast("bigint")).alias(f"n_{kind}")
    per = spans.groupBy("blob").agg(*[count(k) for k in KIND_ORDER], F.array_sort(F.collect_list(one)).alias("all"))
    joined = F.array_join(F.transform("all", lambda x: x["s"]), ",")
    per = per.select("blob", *[f"n_{k}" for k in KIND_ORDER], joined.alias("spans"))
    text = F.coalesce("spans", F.lit(""))
    return (
        with_blobs(versions)
        .select("doc_id", "blob")
        .join(per, "blob", "left")
        .select(
            "doc_id",
            *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KIND_ORDER],
            F.sha2(text, 256).alias("base_sha256"),
            text.alias("spans"),
            "blob",
        )
    )


def scan_in_loads(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`scan_report` after a history: one half of the blobs comes in under an older version of the last
    rule, then the other half under today's. The report's own scan then meets a filled ledger and has
    only the first half left to do, for that one rule."""
    older = (*rules[:-1], replace(rules[-1], version=rules[-1].version - 1))
    first = F.substring(F.sha2(text_of(), 256), 1, 1) < "8"
    scan_new(versions.where(first), ledger, older)
    scan_new(versions.where(~first), ledger, rules)
    return scan_report(versions, ledger, rules)
