"""Problem 7: encode whole texts with the public byte-level BPE vocabulary.

A text is cut by the vocabulary's pattern into pieces.  The merges of a piece
run on a segment tree over the ranks of its adjacent pairs: the root holds the
lowest rank and, among equals, the leftmost position, a merge is two or three
point updates, and the loop ends when the root holds no mergeable pair.  Pieces
repeat, so each Python worker keeps the ids of those it has seen, in a
dictionary of bounded size.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import spread

#: Fixed value: the pattern by which this vocabulary cuts a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces a worker remembers at most, and the longest it remembers.
CACHE_PIECES, CACHE_BYTES = 200_000, 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PairTree:
    """Minimum of (rank, position) over a piece's adjacent pairs."""

    def __init__(self, keys: list[int], none: int):
        size = 1
        while size < len(keys):
            size *= 2
        self.size = size
        tree = [none] * (2 * size)
        tree[size : size + len(keys)] = keys
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left <= right else right
        self.tree = tree

    def put(self, at: int, key: int) -> None:
        tree, node = self.tree, at + self.size
        tree[node] = key
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            low = left if left <= right else right
            if tree[node] == low:
                break
            tree[node] = low
            node >>= 1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    none = 1 << 62
    part = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def key(i: int) -> int:
        j = after[i]
        if j >= n:
            return none
        rank = ranks.get(part[i] + part[j])
        return none if rank is None else rank * n + i

    tree = PairTree([key(i) for i in range(n)], none)
    while (low := tree.tree[1]) != none:
        i = low % n
        j = after[i]
        part[i] += part[j]
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        tree.put(j, none)
        tree.put(i, key(i))
        if (h := before[i]) >= 0:
            tree.put(h, key(h))
    out, i = [], 0
    while i < n:
        out.append(ranks[part[i]])
        i = after[i]
    return out


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pieces = regex.compile(PATTERN).findall
        self.run_of_blanks = re.compile(r"^\s|\s$| \s|\s ").search
        self.seen: dict[str, list[int]] = {}  # by piece
        self.known: dict[str, list[int]] = {}  # by word

    def of(self, piece: str) -> list[int]:
        ids = merge(piece.encode("utf-8", "replace"), self.ranks)
        if len(piece) <= CACHE_BYTES:
            if len(self.seen) >= CACHE_PIECES:
                self.seen.clear()
            self.seen[piece] = ids
        return ids

    def words(self, text: str) -> list[str]:
        """Stretches whose pieces don't depend on each other.

        Where no other white space touches a space, no piece crosses the end of
        a word and the space before it; else the text stays whole.
        """
        if self.run_of_blanks(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]

    def word(self, word: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(word):
            ids = self.seen.get(piece)
            out += self.of(piece) if ids is None else ids
        if len(word) <= CACHE_BYTES:
            if len(self.known) >= CACHE_PIECES:
                self.known.clear()
            self.known[word] = out
        return out

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, more = self.known.get, out.extend
        for word in self.words(text):
            ids = known(word)
            more(self.word(word) if ids is None else ids)
        return out

    def count(self, text: str) -> int:
        known, total = self.known.get, 0
        for word in self.words(text):
            ids = known(word)
            total += len(self.word(word) if ids is None else ids)
        return total


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str, ranks) -> Encoder:
    """The worker's encoder for a broadcast vocabulary, made once."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(ranks.value)
    return _ENCODERS[name]


def encode(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, counts_only: bool = False
) -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of each row, or ``n_tokens`` with ``counts_only``.

    Null and empty texts give an empty list (0 tokens); a null id stays null.
    Repeated rows stay repeated.  Names of special tokens are ordinary text.
    Other columns are ignored.  What is broadcast is the vocabulary, whose size
    is fixed.
    """
    path = vocabulary or default_vocabulary()
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    kind = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, ranks)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, len(ids), 1000):
                part = texts.slice(at, 1000).to_pylist()
                if counts_only:
                    out = pa.array([enc.count(t) if t else 0 for t in part], pa.int64())
                else:
                    flat, ends = [], [0]
                    for t in part:
                        if t:
                            flat += enc.encode(t)
                        ends.append(len(flat))
                    out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())).cast(kind)
                yield pa.RecordBatch.from_arrays([ids.slice(at, 1000), out], ["id", "out"])

    src = spread(df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")))
    name, dtype = ("n_tokens", "bigint") if counts_only else ("ids", "array<int>")
    return src.mapInArrow(run, f"id bigint, out {dtype}").toDF(id_col, name)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.common import table

    return encode(table(spark, sf_dir, "documents"))
