"""Token ids in word-aligned files: Simple-8b words with escapes, in blocks that decode alone.

A segment is one binary value with the ids of whole documents. All numbers are little-endian:

    4 bytes  "S8B1"
    4 x u32  number of ids, blocks, words and escapes
    blocks   u32 first word, u32 first escape; a block has 4096 ids, the last one the rest
    words    u64: the selector in the upper four bits, then its count of codes from the lowest bit up
    escapes  u32: the ids that codes of ones only stand for, in order

Segments are rows of a table, written by Spark's own commit protocol, beside the documents they hold.
"""

from __future__ import annotations

import json
import os
import re
import struct
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import bounded, dealt, stored, text_of
from .packing import BROADCAST_PARTS
from .token_counts import vocabulary_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
MAGIC = b"S8B1"
BLOCK_IDS = 4096
# A segment ends with the document that reaches this many ids.
SEGMENT_IDS = 1 << 18
# Rows of a batch; a batch also ends at this many characters.
BATCH_ROWS, BATCH_CHARS = 500, 1_000_000

# The codes of a word and their bits, by selector. Codes without bits are zeros.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
# The widest code needs no escapes.
WHOLE = len(WIDTHS) - 1


def _unfit(ids: np.ndarray, selector: int) -> np.ndarray:
    """Which ids a code of the selector can't hold; the code of ones only is taken."""
    width = int(WIDTHS[selector])
    return ids >= (1 << width) - 1 if 0 < width < 32 else ids != 0 if width == 0 else np.zeros(len(ids), bool)


def _selectors(ids: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each place of blocks as rows: the selector with the fewest bits per id, escapes included.
    A word takes its count of ids, at most the `room` up to the end of the block."""
    n = ids.shape[1]
    # Cost in 1/1024 bit and selector in one number: the least one is chosen.
    best = np.full(ids.shape, 64 * 1024 * 16 + WHOLE, np.int32)
    for s, count in enumerate(COUNTS[:WHOLE].tolist()):
        before = np.zeros((len(ids), n + count), np.int16)
        np.cumsum(_unfit(ids, s), axis=1, out=before[:, 1 : n + 1])
        before[:, n + 1 :] = before[:, n : n + 1]
        unfit = before[:, count:] - before[:, :-count] if count > 1 else before[:, 1:] - before[:, :-1]
        prices = 64 + 32 * np.arange(count + 1) if WIDTHS[s] else np.append(64, np.full(count, 1 << 16))
        full = n - count + 1
        whole = (prices * 1024 // count * 16 + s).astype(np.int32)
        np.minimum(best[:, :full], whole[unfit[:, :full]], out=best[:, :full])
        # Near the end of a block, and of the last one's ids, words are not full.
        for rows, first in ((slice(None, -1), full), (slice(-1, None), max(0, int(room[-1, 0]) - count + 1))):
            left = np.minimum(room[rows, first:], count)
            part = (prices[unfit[rows, first:]] * 1024 // left * 16 + s).astype(np.int32)
            np.minimum(best[rows, first:], part, out=best[rows, first:])
    return (best & 15).astype(np.uint8)


def encode(ids: np.ndarray) -> bytes:
    """A segment."""
    ids = np.asarray(ids)
    n = len(ids)
    firsts = np.arange(0, n, BLOCK_IDS)
    places = np.arange(len(firsts) * BLOCK_IDS)
    ends = np.repeat(np.minimum(firsts + BLOCK_IDS, n), BLOCK_IDS)
    rows = np.zeros(len(ends), np.int32 if n == 0 or ids.max() < 1 << 31 else np.int64)
    rows[:n] = ids
    # Places after the last id have no room; nothing is read there.
    room = np.maximum(ends - places, 1).astype(np.int32).reshape(-1, BLOCK_IDS)
    best = _selectors(rows.reshape(-1, BLOCK_IDS), room).ravel() if n else np.zeros(0, np.uint8)
    # All blocks are walked through together, a word at a time.
    after = np.append(np.minimum(places + COUNTS[best], ends), 0)
    at, stop, steps = firsts.copy(), np.minimum(firsts + BLOCK_IDS, n), []
    while len(at) and (at < stop).any():
        steps.append(at)
        at = np.where(at < stop, after[np.minimum(at, len(after) - 1)], at)
    walked = np.stack(steps, axis=1) if steps else np.zeros((0, 0), np.int64)
    # A block that has ended stands still at its end, where the next one begins.
    starts = walked[walked < stop[:, None]]
    chosen = best[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    escaped = np.zeros(len(rows), bool)
    for s in np.unique(chosen).tolist():
        width, count = int(WIDTHS[s]), int(COUNTS[s])
        if width == 0:
            continue
        which = np.flatnonzero(chosen == s)
        place = starts[which, None] + np.arange(count)
        outside = place >= ends[starts[which], None]
        np.minimum(place, max(n - 1, 0), out=place)
        code = rows[place].astype(np.uint64)
        code[outside] = 0
        if s < WHOLE:
            ones = np.uint64((1 << width) - 1)
            out = code >= ones
            escaped[place[out]] = True
            code[out] = ones
        code <<= np.arange(count, dtype=np.uint64) * np.uint64(width)
        words[which] |= np.bitwise_or.reduce(code, axis=1)
    seen = np.concatenate([[0], np.cumsum(escaped)])
    table = np.stack([np.searchsorted(starts, firsts), seen[firsts]], axis=1)
    head = struct.pack("<4s4I", MAGIC, n, len(firsts), len(words), int(seen[-1]))
    escapes = rows[escaped].astype("<u4")
    return b"".join([head, table.astype("<u4").tobytes(), words.astype("<u8").tobytes(), escapes.tobytes()])


def decode(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids from `first` to before `last`; only the blocks they lie in are decoded."""
    magic, n, n_blocks, n_words, n_escapes = struct.unpack_from("<4s4I", data)
    if magic != MAGIC:
        raise ValueError("not a segment")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, "<u4")
    at = struct.calcsize("<4s4I")
    table = np.frombuffer(data, "<u4", 2 * n_blocks, at).reshape(-1, 2).astype(np.int64)
    table = np.concatenate([table, [[n_words, n_escapes]]])
    at += 8 * n_blocks
    b0, b1 = first // BLOCK_IDS, -(-last // BLOCK_IDS)
    w0, e0 = table[b0]
    w1, e1 = table[b1]
    words = np.frombuffer(data, "<u8", w1 - w0, at + 8 * w0)
    escapes = np.frombuffer(data, "<u4", e1 - e0, at + 8 * n_words + 4 * e0)

    begin, end = b0 * BLOCK_IDS, min(b1 * BLOCK_IDS, n)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    passed = np.concatenate([[0], np.cumsum(COUNTS[selectors])])[:-1]
    # The last word of a block may hold fewer ids than its count, so places start anew in each.
    block = np.repeat(np.arange(b1 - b0), np.diff(table[b0 : b1 + 1, 0]))
    place = passed - passed[table[b0:b1, 0] - w0][block] + block * BLOCK_IDS
    stop = np.minimum((block + 1) * BLOCK_IDS, end - begin)
    out, escaped = np.zeros(end - begin, "<u4"), np.zeros(end - begin, bool)
    for s in np.unique(selectors):
        width = int(WIDTHS[s])
        if width == 0:
            continue
        rows = np.flatnonzero(selectors == s)
        to = place[rows, None] + np.arange(COUNTS[s])
        inside = to < stop[rows, None]
        ones = np.uint64((1 << width) - 1)
        code = words[rows, None] >> (np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(width)) & ones
        to, code = to[inside], code[inside]
        out[to] = code
        if s < WHOLE:
            escaped[to[code == ones]] = True
    out[escaped] = escapes
    return out[first - begin : last - begin]


# Fixed values, from the vocabulary's pattern: contractions, then letters, a digit, or marks. Texts of
# these characters are lower-cased by Python as by the vocabulary, and none of them is composed anew.
LATIN = re.compile(
    "[\t\n\r\x20-\x7e\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e]*"
)
LETTER = "a-z\u00df-\u00f6\u00f8-\u017f"
# Ends a text, and a piece.
STOP, END = "\1", "\0"
PIECES = re.compile(f"[{LETTER}]+|{STOP}|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^{STOP}{LETTER}0-9\t\n\r ]+")


def byte_of_letter() -> dict[str, int]:
    """The bytes that a vocabulary's letters stand for: printable Latin ones for themselves, the
    others in order for the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in printable]
    return {**{chr(x): x for x in printable}, **{chr(256 + i): x for i, x in enumerate(others)}}


def rank_table(model: dict) -> tuple[dict[bytes, int], np.ndarray]:
    """Ranks of byte strings that make a rank-ordered encoder merge as the vocabulary does, and the
    id of every rank.

    A word's last letter is a symbol of its own there. Here it is that letter and an end mark,
    joined before all else. The other ranks are the merges' order. Joining any neighbours that
    make a piece is the same as the listed merges if every piece is what its own letters merge to;
    the tests show that for all pieces.
    """
    suffix, letters = model["end_of_word_suffix"], byte_of_letter()

    def raw(piece: str) -> bytes:
        last = piece.endswith(suffix) and piece != suffix
        body = piece.removesuffix(suffix) if last else piece
        return bytes(letters[c] for c in body) + (END.encode() if last else b"")

    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    known = set(merged)
    single = sorted((p for p in model["vocab"] if len(p.removesuffix(suffix)) == 1 and p not in known), key=lambda p: not p.endswith(suffix))
    if len(merged) != len(known):
        raise ValueError("a piece has two merges")
    pieces = [*single, *merged]
    return {raw(p): i for i, p in enumerate(pieces)}, np.array([model["vocab"][p] for p in pieces])


class WordEncoder:
    """Ids of texts under a vocabulary that drops blanks, as little-endian numbers of `width` bytes.

    Texts of Latin letters, digits and marks are cut into pieces and merged by rank, a batch at a
    time; others, and those that may hold a special string, are left to the library.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary_path(name))
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        with open(vocabulary_path(name), encoding="utf-8") as f:
            ranks, ids = rank_table(json.load(f)["model"])
        self.ranks = tiktoken.Encoding(name, pat_str=f"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={})
        self.stop = ranks[(STOP + END).encode()]
        self.id_of = ids.astype(f"<u{self.width}")
        self.id_of[self.stop] = END_ID

    def plain(self, text: str) -> bool:
        return LATIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of the texts, the end id of each included."""
        plain = [self.plain(t) for t in texts]
        marked = "".join(t + STOP for t, p in zip(texts, plain) if p)
        cut = END.join(PIECES.findall(marked.lower())) + END
        ranks = np.frombuffer(array("I", self.ranks.encode_ordinary(cut) if marked else []), np.uint32)
        raw = self.id_of[ranks].tobytes()
        stops = ((np.flatnonzero(ranks == self.stop) + 1) * self.width).tolist()
        slices = (raw[i:j] for i, j in zip([0, *stops], stops))
        return [next(slices) if p else self.by_library(t) for t, p in zip(texts, plain)]

    def by_library(self, text: str) -> bytes:
        ids = [*self.library.encode(text, add_special_tokens=False).ids, END_ID]
        return np.array(ids, f"<u{self.width}").tobytes()


_loaded: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    """Loaded once per worker process."""
    if name not in _loaded:
        _loaded[name] = WordEncoder(name)
    return _loaded[name]


def in_batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices with bounded rows and characters of the last column; a longer text is one of its own."""
    lengths = pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()
    first, held = 0, 0
    for k, n in enumerate(lengths):
        if k > first and (k - first >= BATCH_ROWS or held + n > BATCH_CHARS):
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += n
    yield batch.slice(first)


def sort_key(doc_id, h: int) -> tuple:
    return (doc_id is not None, 0 if doc_id is None else doc_id, h)


def range_starts(rows: DataFrame, n: int) -> list[tuple]:
    """Where the 2nd to n-th of n ranges of (doc_id, h) begin; found without the texts' ids."""
    dealt_out = rows.select("doc_id", "h").repartitionByRange(n, "doc_id", "h").withColumn("p", F.spark_partition_id())
    firsts = dealt_out.groupBy("p").agg(F.min(F.struct("doc_id", "h")).alias("r")).select("r.*").collect()
    return sorted(sort_key(*r) for r in firsts)[1:]


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, doc_id, h, ids, width): the rows' ids, dealt to their ranges and sorted there. Of rows
    with the same id the hash of the text gives the order."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("t"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = range_starts(rows, n)

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary)
        for batch in batches:
            for b in in_batches(batch):
                part = [bisect_right(starts, sort_key(*x)) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                found = e.batch(b.column(2).to_pylist())
                columns = [pa.array(part, pa.int32()), b.column(0), b.column(1), pa.array(found, pa.binary())]
                widths = pa.array([e.width] * len(part), pa.int32())
                yield pa.RecordBatch.from_arrays([*columns, widths], ["part", "doc_id", "h", "ids", "width"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = dealt(rows).mapInArrow(encode_rows, f"part int, doc_id {kind}, h bigint, ids binary, width int")
    return found.repartitionById(n, "part").sortWithinPartitions("part", "doc_id", "h")


def write_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """The ids of all rows as segments under `path`, in ascending order of doc_id.

    A null id comes first, rows with the same id follow each other by a hash of their text, and
    equal rows are all kept. A null or empty text has the end id alone. Other columns are ignored,
    whatever their names. An empty table gives a folder without segments.
    """
    tokens = encoded(docs, vocabulary)
    kind = tokens.schema["doc_id"].dataType

    def segment(part, first, ids, doc_ids, sizes):
        data = np.concatenate(ids)
        columns = [
            pa.array([part], pa.int32()),
            pa.array([first], pa.int64()),
            pa.array([len(data)], pa.int64()),
            pa.ListArray.from_arrays([0, len(sizes)], pa.concat_arrays(doc_ids)),
            pa.array([sizes], pa.list_(pa.int64())),
            pa.array([encode(data)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "first", "n_ids", "doc_ids", "doc_tokens", "data"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first, ids, doc_ids, sizes, held = None, 0, [], [], [], 0
        for b in batches:
            columns = (b.column(c).to_pylist() for c in (0, 3, 4))
            for k, (part, raw, width) in enumerate(zip(*columns)):
                if sizes and (part != current or held >= SEGMENT_IDS):
                    yield segment(current, first, ids, doc_ids, sizes)
                    first, ids, doc_ids, sizes, held = first + held, [], [], [], 0
                if part != current:
                    current, first = part, 0
                one = np.frombuffer(raw, f"<u{width}")
                ids.append(one)
                doc_ids.append(b.column(1).slice(k, 1))
                sizes.append(len(one))
                held += len(one)
        if sizes:
            yield segment(current, first, ids, doc_ids, sizes)

    schema = f"part int, first bigint, n_ids bigint, doc_ids array<{kind.simpleString()}>, doc_tokens array<bigint>, data binary"
    tokens.mapInArrow(segments, schema).write.option("compression", "zstd").parquet(path)


def with_starts(segments: DataFrame) -> DataFrame:
    """Segments with `first` as the number of ids before them in all files."""
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "offsets")
    return segments.join(bounded(base, BROADCAST_PARTS), "part").withColumn("first", F.col("base") + F.col("first")).drop("base")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of the files; ids are little-endian 32-bit
    numbers, `start` the ids of all documents before."""
    segments = with_starts(spark.read.parquet(path))
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                ids, sizes = decode(b.column(3)[k].as_py()), b.column(2)[k].as_py()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                raw = [ids[x:y].tobytes() for x, y in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(1)[k].values, pa.array(starts + b.column(0)[k].as_py()), pa.array(sizes, pa.int64()), pa.array(raw, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    slim = segments.select("first", "doc_ids", "doc_tokens", "data")
    return slim.mapInArrow(documents, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")


def read_ids(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(start, ids): the ids from `first` to before `last` of the whole stream, a row per segment
    that has some of them; other segments and blocks aren't decoded."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, ids = [], []
            for start, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                starts.append(max(start, first))
                ids.append(decode(data, max(0, first - start), last - start).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], ["start", "ids"])

    wanted = with_starts(spark.read.parquet(path)).where((F.col("first") < last) & (F.col("first") + F.col("n_ids") > first))
    return wanted.select("first", "data").mapInArrow(cut, "start bigint, ids binary")
