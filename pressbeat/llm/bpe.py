"""Byte-level BPE: ids of whole texts by a rank file, and the bytes of ids.

Each match of the splitting pattern is merged on its own. A segment tree over the byte positions keeps, in each node, the
lowest pair rank below it and the leftmost place of that rank; its root names the next merge. A merge changes the pair of the
merged place, of its live left neighbour and of the place that vanished: three point updates of logarithmic cost, so a match of
n bytes costs n log n whatever it holds.

A null text is empty, an empty text has no ids. Every text is encoded whole. Other columns are kept or ignored as each
function states; equal rows give equal results.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressbeat.llm.common import lengthy, map_arrow, text_of

NEVER = 1 << 62
SHIFT = 32
PLACE = (1 << SHIFT) - 1
BITS = 20
NONE = (1 << BITS) - 1  # stands after the last byte; no pair has it


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def load_pairs(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of ids whose bytes together are an id: ``first << BITS | second`` to ``id << SHIFT``. Bounded by the rank file."""
    get = ranks.get
    splits = ((get(token[:k]), get(token[k:]), rank) for token, rank in ranks.items() for k in range(1, len(token)))
    return {a << BITS | b: rank << SHIFT for a, b, rank in splits if a is not None and b is not None}


def merge_pairs(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """The ids of a match of two or more bytes, given as its bytes' ids: merge the leftmost lowest-ranked pair until none has a rank.

    ``levels`` is a segment tree over the byte places with 16 children a node: a leaf holds ``rank << SHIFT | place`` of the pair
    that starts there, a node the lowest of its children, so that the root is the next merge. Vanished places and pairs without
    a rank hold ``NEVER`` or more. A merge writes three leaves and the nodes above them.
    """
    n = len(ids)
    get = pairs.get
    ids = [*ids, NONE]
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    leaves = [get(ids[i] << BITS | ids[i + 1], NEVER) | i for i in range(n - 1)]
    levels = [leaves]
    while len(level := levels[-1]) > 16:
        levels.append([min(level[i : i + 16]) for i in range(0, len(level), 16)])
    root, deep = levels[-1], len(levels) > 1
    while (key := min(root)) < NEVER:
        at = key & PLACE
        gone = after[at]
        ids[at] = merged = key >> SHIFT
        after[at] = follower = after[gone]
        before[follower] = at
        if gone < n - 1:
            leaves[gone] = NEVER
        leaves[at] = get(merged << BITS | ids[follower], NEVER) | at
        if (left := before[at]) >= 0:
            leaves[left] = get(ids[left] << BITS | merged, NEVER) | left
        if deep:
            places = {at >> 4, min(gone, n - 2) >> 4, max(left, 0) >> 4}
            for lower, upper in zip(levels, levels[1:]):
                for place in places:
                    upper[place] = min(lower[place << 4 : (place + 1) << 4])
                places = {place >> 4 for place in places}
    out, at = [], 0
    while at < n:
        out.append(ids[at])
        at = after[at]
    return out


class Matches(dict):
    """The packed ids of a match of the pattern, kept up to a bound."""

    MOST = 500_000

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        if max(ranks.values(), default=0) >= NONE:
            raise ValueError(f"ids must be below {NONE}")
        self.ranks = ranks
        self.pairs = load_pairs(ranks)
        self.bytes = [ranks[bytes([b])] for b in range(256)]

    def merge(self, data: bytes) -> list[int]:
        """The ids of one match."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return merge_pairs([self.bytes[b] for b in data], self.pairs)

    def __missing__(self, match: str) -> bytes:
        if len(self) > self.MOST:
            self.clear()
        self[match] = found = array("i", self.merge(match.encode())).tobytes()
        return found


class Spaced(dict):
    """The packed ids of a space and what follows it up to the next space, kept up to a bound."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        if len(self) > Matches.MOST:
            self.clear()
        self[piece] = found = self.coder.by_match(" " + piece)
        return found


class Coder:
    """Encoder and decoder of one rank file and splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.meeting = regex.compile(r" \s|[^\S\n] ")
        self.matches = Matches(self.ranks)
        self.spaced = Spaced(self)
        self.vocabulary = {rank: token for token, rank in self.ranks.items()}
        self.names = {rank: str(rank) for rank in self.ranks.values()}

    def by_match(self, text: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> list[int]:
        """Where no space meets other white space, every space starts a match, so what lies between spaces can be looked up."""
        if "\n " in text or self.meeting.search(text):
            packed = self.by_match(text)
        else:
            first, *rest = text.split(" ")
            packed = self.by_match(first) + b"".join(map(self.spaced.__getitem__, rest))
        ids = array("i")
        ids.frombytes(packed)
        return ids.tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))

    def listed(self, ids: list[int]) -> str:
        return ",".join(map(self.names.__getitem__, ids))


@functools.lru_cache(2)
def coder_of(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id and its ids as an array. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path, pattern)
        for batch in lengthy(batches, 4 << 20):
            ids = [coder.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    slim = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return map_arrow(slim, run, "doc_id bigint, ids array<int>")


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 and the digest of the bytes its ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path, pattern)
        for batch in lengthy(batches, 4 << 20):
            count, coded, decoded = [], [], []
            for words in batch.column(1).to_pylist():
                ids = coder.encode(words)
                count.append(len(ids))
                coded.append(hashlib.sha256(coder.listed(ids).encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            arrays = [batch.column(0), pa.array(count, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    slim = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return map_arrow(slim, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
