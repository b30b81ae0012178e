"""Token counts of a piece vocabulary by byte-pair merging with a heap and a linked list."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import dealt, text_of

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"
# Bounds of a worker's table of counted chunks: entries, and characters of an entry.
MEMO_ENTRIES, MEMO_CHARS = 600_000, 40


def vocabulary_path(name: str = MODEL) -> str:
    """The public file's place on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Merges:
    """Ranks of the pieces of a vocabulary file, and how its library prepares a text.

    The library joins adjacent symbols whose concatenation is a piece, best score first, the leftmost
    on a tie; characters that aren't pieces count as their UTF-8 bytes. No piece has a space mark
    after another character, so nothing is joined across the start of a run of spaces: such
    chunks are counted on their own, and each distinct one once while it is remembered.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece of this vocabulary joins words; it can't be counted by chunks")
        order = sorted((p for p in pieces if len(p) > 1), key=lambda p: -pieces[p])
        self.rank = {p: k for k, p in enumerate(order)}
        # Neighbours that no piece holds side by side are never joined.
        self.inside = {p[i : i + 2] for p in order for i in range(len(p) - 1)}
        self.chars = {p for p in pieces if len(p) == 1}
        self.spaced, self.bare = Memo(self, SPACE), Memo(self, "")

    def count_chunk(self, chunk: str) -> int:
        """Initial symbols minus merges."""
        rank, chars, n = self.rank.get, self.chars, len(chunk)
        if chars.issuperset(chunk):
            count = n
        else:
            count = sum(1 if c in chars else len(c.encode()) for c in chunk)
        shift = n.bit_length()
        mask = (1 << shift) - 1
        heap = [r << shift | i for i, r in enumerate(map(rank, map(add, chunk, chunk[1:]))) if r is not None]
        if not heap:
            return count
        heapify(heap)
        symbols: list[str] = [*chunk, ""]
        after = list(range(1, n + 2))
        before = list(range(-1, n))
        while heap:
            entry = heappop(heap)
            i, r = entry & mask, entry >> shift
            j = after[i]
            joined = symbols[i] + symbols[j]
            # Stale: one of the two symbols was joined to another since.
            if not symbols[i] or j >= n or rank(joined) != r:
                continue
            symbols[i], symbols[j] = joined, ""
            count -= 1
            k = after[i] = after[j]
            before[k] = i
            if k < n and (r := rank(joined + symbols[k])) is not None:
                heappush(heap, r << shift | i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + joined)) is not None:
                heappush(heap, r << shift | h)
        return count

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        # The library puts one space before a text and has no other normalisation.
        text = SPACE + text.replace(" ", SPACE)
        total, bare, spaced = 0, self.bare, self.spaced
        # A line end is in no piece: nothing is joined across it, and it counts as its one byte.
        for line in text.split("\n"):
            total += 1
            words = line.split(SPACE)
            if "" in words[1:]:
                total += self._count_runs(line)
            else:
                total += bare[words[0]] + sum(map(spaced.__getitem__, words[1:]))
        return total - 1

    def _count_runs(self, line: str) -> int:
        """A line with runs of spaces: each run stays with the word after it."""
        total, start, n = 0, 0, len(line)
        while start < n:
            end = start
            while end < n and line[end] == SPACE:
                end += 1
            while end < n and line[end] != SPACE:
                end += 1
            total += self.bare[line[start:end]]
            start = end
        return total


class Memo(dict):
    """Counts of chunks seen by this worker; emptied when it is full."""

    def __init__(self, merges: Merges, prefix: str):
        super().__init__()
        self.merges, self.prefix = merges, prefix

    def __missing__(self, word: str) -> int:
        # What no piece holds beside the character before it counts on its own, from the end on.
        inside, count, i = self.merges.inside, self.merges.count_chunk, len(word)
        while i > 1 and word[i - 2 : i] not in inside:
            i -= 1
        if i == len(word):
            n = count(self.prefix + word)
        else:
            n = self[word[:i]] + sum(map(count, word[i:]))
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = n
        return n


_loaded: dict[str, Merges] = {}


def merges(name: str) -> Merges:
    """Loaded once per worker process."""
    if name not in _loaded:
        _loaded[name] = Merges(vocabulary_path(name))
    return _loaded[name]


def token_counts(
    docs: DataFrame, model: str = MODEL, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    n_tokens is what the vocabulary's library gives for the whole text without begin or end tokens;
    strings that look like special tokens are ordinary text. Null and empty texts have no bytes and
    no tokens. Repeated rows are counted each; other columns are ignored; an empty table gives no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges(model)
        for b in batches:
            n = [m.count(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    t = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(t).cast("bigint").alias("n_bytes"), t.alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return dealt(rows).mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
