"""Encoding of texts with a byte-level BPE vocabulary.

A text is split by the vocabulary's pattern; each piece is merged over a segment tree whose leaves are the
ranks of adjacent pairs. The root names the leftmost pair of lowest rank, a merge touches three leaves, so a
piece of n bytes takes O(n log n) whatever its length. Pieces repeat far more than texts do, so a worker keeps
the ids of the pieces it has met.

Nulls and empty texts give an empty list. Texts are encoded whole, without special tokens: a special token's
string in a text is ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession

from tidemark.session import arrow

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the published split pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pieces a worker remembers before it starts afresh; bounds the worker's memory, not the result.
REMEMBERED = 200_000


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


class PairTree:
    """Minimum tree over the leaves' keys; a key is rank * size + position, so ties go to the leftmost pair."""

    def __init__(self, keys: list[int], none: int):
        self.width = 1 << max(0, (len(keys) - 1).bit_length())
        self.none = none
        self.low = [none] * self.width + keys + [none] * (self.width - len(keys))
        for i in range(self.width - 1, 0, -1):
            self.low[i] = min(self.low[2 * i], self.low[2 * i + 1])

    def best(self) -> int:
        return self.low[1]

    def put(self, leaf: int, key: int) -> None:
        low, i = self.low, leaf + self.width
        low[i] = key
        while i > 1:
            i >>= 1
            a, b = low[2 * i], low[2 * i + 1]
            least = a if a < b else b
            if low[i] == least:
                break
            low[i] = least


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    n = len(piece)
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    none = (len(ranks) + 1) * n
    ends = list(range(1, n + 1))  # part i is piece[i:ends[i]]; a part swallowed by its left neighbour has end 0
    before = list(range(-1, n - 1))

    def key(i: int) -> int:
        if i < 0 or (end := ends[i]) >= n:
            return none
        rank = ranks.get(piece[i : ends[end]])
        return none if rank is None else rank * n + i

    tree = PairTree([key(i) for i in range(n - 1)], none)
    while (best := tree.best()) < none:
        i = best % n
        gone = ends[i]
        ends[i] = ends[gone]
        ends[gone] = 0
        if ends[i] < n:
            before[ends[i]] = i
        if gone < n - 1:
            tree.put(gone, none)
        tree.put(i, key(i))
        if before[i] >= 0:
            tree.put(before[i], key(before[i]))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return ids


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if text:
            known = self.known
            for piece in self.split(text):
                found = known.get(piece)
                if found is None:
                    found = merge(piece.encode(), self.ranks)
                    if len(piece) <= 64:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[piece] = found
                ids += found
        return ids


_ENCODERS: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    name, broadcast = shared
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(parse_ranks(broadcast.value))
    return _ENCODERS[name]


def _vocabulary(spark: SparkSession, path: str):
    """The rank file's digest, and the file sent once to each executor: its size is the vocabulary's, whatever the corpus."""
    with open(path, "rb") as f:
        raw = f.read()
    return hashlib.sha256(raw).hexdigest(), spark.sparkContext.broadcast(raw)


def token_ids(spark: SparkSession, text: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """array<int>: the ids of a text; empty for null and empty texts."""
    shared = _vocabulary(spark, vocabulary)

    @arrow("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoder(shared).encode
        for batch in batches:
            ends, parts = np.zeros(len(batch) + 1, np.int32), []
            for i, value in enumerate(batch):
                found = np.asarray(encode(value.as_py()), np.int32)
                parts.append(found)
                ends[i + 1] = ends[i] + len(found)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return ids(text)


def token_count(spark: SparkSession, text: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """int: how many ids a text has; 0 for null and empty texts."""
    shared = _vocabulary(spark, vocabulary)

    @arrow("int")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoder(shared).encode
        for batch in batches:
            yield pa.array([len(encode(value.as_py())) for value in batch], pa.int32())

    return count(text)
