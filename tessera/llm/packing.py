"""Concatenate and cut: token streams laid end to end and cut into fixed windows."""

from __future__ import annotations

import base64
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import bounded, dealt, stored, text_of
from .token_counts import vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 2048
END_ID = 1
# Bounds of a worker's table of encoded chunks: entries, and characters of an entry.
MEMO_ENTRIES, MEMO_CHARS = 500_000, 40
BATCH_ROWS = 500
# Partitions whose offsets may be sent to every task, 16 bytes each; the ids then stay in place.
BROADCAST_PARTS = 1_000_000


# The blanks of the vocabulary's pattern.
PATTERN_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK_AND_SPACE = re.compile(f"[{PATTERN_BLANKS}] ")
# Characters whose class no Unicode version has changed: of a word, and of a text.
PLAIN = re.compile("[\x21-\x7e\u00c0-\u024f]*")
PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7e\u00c0-\u024f]*")


class Encoder(dict):
    """Ids of texts as little-endian 16-bit numbers (32-bit ones for larger vocabularies).

    Whole texts of plain characters are encoded from the same vocabulary's rank file. Other texts
    are cut into words: the vocabulary's pattern never joins a space to a character before it, so
    the ids of a text in which no space follows a blank are those of its words, each with the space
    before it. The mapping keeps the ids of such words in two generations: a full one becomes the
    old one, and what is used from there moves on. All else is left to the library itself.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.old: dict[str, bytes] = {}
        self.library = Tokenizer.from_file(vocabulary_path(name))
        special = self.library.get_added_tokens_decoder()
        self.special = [t.content for t in special.values()]
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.code = "H" if size <= 1 << 16 else "I"
        self.width = 2 if size <= 1 << 16 else 4
        with open(vocabulary_path(name.replace(".json", ".tiktoken")), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if len(ranks) + len(special) != size:
            raise ValueError(f"{name} and its rank file differ")
        self.ranks = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str, plain: bool) -> bytes:
        if plain:
            ids = self.ranks.encode_ordinary(text)
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def __missing__(self, word: str) -> bytes:
        found = self.old.pop(word, None)
        if found is None:
            found = self.word(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found

    def word(self, word: str) -> bytes:
        """The ids of a space and the word after it."""
        plain = PLAIN.fullmatch(word) is not None and word not in self.special
        last = word[-1:]
        if last in (",", ".") and plain and word[-2:-1].isalpha():
            # The pattern ends a word of letters before a mark.
            return self[word[:-1]] + self.encode(last, True)
        return self.encode(" " + word, plain)

    def ids(self, text: str) -> bytes:
        """The ids of a text, the end id included."""
        end = END_ID.to_bytes(self.width, "little")
        special = any(s in text for s in self.special)
        if not special and PLAIN_TEXT.fullmatch(text):
            return self.encode(text, True) + end
        if special or BLANK_AND_SPACE.search(text):
            return self.encode(text, False) + end
        first, *words = text.split(" ")
        head = self.encode(first, PLAIN.fullmatch(first) is not None)
        return head + b"".join(map(self.__getitem__, words)) + end


_loaded: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """Loaded once per worker process."""
    if name not in _loaded:
        _loaded[name] = Encoder(name)
    return _loaded[name]


def token_table(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, start, n, ids), stored: the tokens of every row, where they begin among the
    tokens of its partition, and the partition. All three come from the task attempt whose file was
    committed, so they fit together whatever was run again."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary)
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                b = batch.slice(k, BATCH_ROWS)
                found = [e.ids(t) for t in b.column(1).to_pylist()]
                n = [len(x) // e.width for x in found]
                starts = [start + x for x in np.cumsum([0, *n[:-1]]).tolist()]
                start += sum(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0),
                        pa.array([part] * len(n), pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([e.width] * len(n), pa.int32()),
                        pa.array(found, pa.binary()),
                    ],
                    ["doc_id", "part", "start", "n", "width", "ids"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, part bigint, start bigint, n bigint, width int, ids binary"
    return stored(dealt(rows).mapInArrow(encode, schema), "tokens")


def with_offsets(tokens: DataFrame) -> DataFrame:
    """`tokens` with `at`, the tokens before each row in the whole stream: the tokens of earlier
    partitions plus `start`. One total per partition is summed up, first in blocks of 1024."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("t")).withColumn("block", F.expr("part div 1024"))
    before = (Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("t").alias("bt"))
    over = Window.orderBy("block").rowsBetween(*before)
    blocks = blocks.select("block", F.coalesce(F.sum("bt").over(over), F.lit(0)).alias("b0"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(*before)
    base = totals.withColumn("p0", F.coalesce(F.sum("t").over(inside), F.lit(0))).join(blocks, "block")
    base = stored(base.select("part", (F.col("b0") + F.col("p0")).alias("base")), "offsets")
    return tokens.join(bounded(base, BROADCAST_PARTS), "part").withColumn("at", F.col("base") + F.col("start")).drop("base")


def as_ids(raw: bytes, width: int) -> bytes:
    """The ids as little-endian 32-bit numbers."""
    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def pieces(placed: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            rows: list[int] = []
            for k, (at, n, width, raw) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4)))):
                data = memoryview(as_ids(raw, width))
                first = 0
                while first < n:
                    seq, offset = divmod(at + first, window)
                    last = min(n, first + window - offset)
                    rows.append(k)
                    for to, v in zip(out, (first, last - first, zlib.crc32(data[4 * first : 4 * last]), n, seq, offset)):
                        to.append(v)
                    first = last
            ids = b.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in out)], names)

    kind = placed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return placed.select("doc_id", "at", "n", "width", "ids").mapInArrow(cut, schema)


def packed_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW) -> DataFrame:
    """Where every document's tokens lie: one row per piece of a document in a sequence.

    Documents are laid end to end in the order of their partitions, each with the end id after it,
    and cut every `window` tokens; only the last sequence is shorter and padded. Null and empty
    texts are the end id alone. Repeated rows are documents of their own; other columns are
    ignored; an empty table gives no rows. A sequence's pieces fill it from offset 0 without gaps.
    """
    return pieces(with_offsets(token_table(docs, vocabulary)), window)


def packed_sequences(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, n_docs, ids array<int> without padding.

    Windows that one task holds whole are complete at once; what lies at the edges of a task's rows
    is kept as boundary records, which alone are shuffled and joined, at most `window` ids each.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["sequence_id", "offset", "n_docs", "ids"]
        begin, size, docs_in, parts = 0, 0, 0, []

        def record():
            return begin // window, begin % window, docs_in, b"".join(parts)

        for b in batches:
            found = []
            for at, n, width, raw in zip(*(b.column(c).to_pylist() for c in range(4))):
                data, first = as_ids(raw, width), 0
                if parts and begin + size != at:
                    found.append(record())
                    parts = []
                while first < n:
                    if not parts:
                        begin, size, docs_in = at + first, 0, 0
                    last = min(n, first + window - (begin + size) % window)
                    parts.append(data[4 * first : 4 * last])
                    size, docs_in, first = size + last - first, docs_in + 1, last
                    if (begin + size) % window == 0:
                        found.append(record())
                        parts = []
            yield batch_of(found, names)
        if parts:
            yield batch_of([record()], names)

    def batch_of(found: list, names: list[str]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names)

    def to_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).to_pylist()
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()), b.column(1), pa.array(ids, pa.list_(pa.int32()))],
                ["sequence_id", "n_tokens", "n_docs", "ids"],
            )

    placed = with_offsets(token_table(docs, vocabulary)).select("at", "n", "width", "ids")
    records = placed.sortWithinPartitions("at").mapInArrow(fill, "sequence_id bigint, offset bigint, n_docs bigint, ids binary")
    records = stored(records, "records")
    whole = F.octet_length("ids") == 4 * window
    edges = records.where(~whole).groupBy("sequence_id").agg(
        F.sum("n_docs").alias("n_docs"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("r")
    )
    joined = F.aggregate("r", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    edges = edges.select("sequence_id", "n_docs", joined.alias("ids"))
    both = records.where(whole).select("sequence_id", "n_docs", "ids").unionByName(edges)
    return both.mapInArrow(to_arrays, "sequence_id bigint, n_tokens bigint, n_docs bigint, ids array<int>")
