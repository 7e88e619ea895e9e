"""Token ids of documents in binary segments with Elias-Fano coded boundaries.

A segment holds the ids of consecutive documents, one after the other, at the narrowest width the vocabulary allows. Where each
document ends is an increasing sequence: its low bits are packed, its high bits are unary, and the position of every 64th one
bit is kept in 32 bits. ``select`` returns any boundary from a few bytes; no table of 64-bit offsets exists. Document ids are
coded in the same way, as distances from the first.

Documents are range-partitioned by id, so segments of ascending (part, seq) hold ascending ids. A null text is empty, a null id
comes first, rows of equal id stay separate documents in the order of their text's hash, and an empty document is only its end
id. A document longer than a segment's bound gets a segment of its own. Other columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressbeat.llm.common import lengthy, map_arrow, scratch_path, text_of

MAGIC = b"EFT1"
EVERY = 64
ONES = bytes(bin(b).count("1") for b in range(256))
SEGMENT = "part int, seq int, first_doc bigint, last_doc bigint, n_docs bigint, n_ids bigint, payload binary"


#: Letters that every Unicode version composes, lower-cases and splits alike.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: How byte-level vocabularies spell bytes: printable Latin-1 as itself, the others from 256 upwards.
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


class EliasFano:
    """A non-decreasing sequence of integers from 0 up, in about 2 + log2(largest / count) bits each."""

    HEAD = struct.Struct("<IBII")

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        count = len(values)
        top = int(values[-1]) if count else 0
        bits = max(0, (top // count).bit_length() - 1) if count else 0
        low = np.packbits((values[:, None] >> np.arange(bits) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes() if bits else b""
        ones = (values >> bits) + np.arange(count)
        unary = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
        unary[ones] = 1
        return cls(count, bits, low, np.packbits(unary, bitorder="little").tobytes(), ones[::EVERY].astype("<u4"))

    def dump(self) -> bytes:
        return self.HEAD.pack(self.count, self.low_bits, len(self.high), len(self.samples)) + self.low + self.high + self.samples.tobytes()

    @classmethod
    def load(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        count, bits, high, samples = cls.HEAD.unpack_from(data, at)
        at += cls.HEAD.size
        ends = [at, at + (count * bits + 7) // 8]
        ends += [ends[-1] + high, ends[-1] + high + 4 * samples]
        low, upper = bytes(data[ends[0] : ends[1]]), bytes(data[ends[1] : ends[2]])
        return cls(count, bits, low, upper, np.frombuffer(data, "<u4", samples, ends[2])), ends[3]

    def select(self, i: int) -> int:
        """The value number ``i``: the sampled one bit before it, then a few bytes of the unary part."""
        at = int(self.samples[i // EVERY])
        left = i % EVERY
        byte, high = at >> 3, self.high
        word = high[byte] & (0xFF << (at & 7))
        while ONES[word] <= left:
            left -= ONES[word]
            byte += 1
            word = high[byte]
        for _ in range(left):
            word &= word - 1
        one = (byte << 3) + (word & -word).bit_length() - 1
        value = (one - i) << self.low_bits
        if self.low_bits:
            first = i * self.low_bits
            last = first + self.low_bits
            part = int.from_bytes(self.low[first >> 3 : (last + 7) >> 3], "little")
            value |= part >> (first & 7) & ((1 << self.low_bits) - 1)
        return value


class Segment:
    """The documents of one payload: ``doc_id(i)``, ``bounds(i)`` and ``ids(i)``."""

    HEAD = struct.Struct("<4sBIIq")

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        magic, self.width, self.count, self.nulls, self.first = self.HEAD.unpack_from(data, 0)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.ends, at = EliasFano.load(data, self.HEAD.size)
        self.docs, at = EliasFano.load(data, at)
        self.data = data[at:]

    @staticmethod
    def dump(docs: list[int | None], parts: list[bytes], width: int) -> bytes:
        known = np.array([d for d in docs if d is not None], np.int64)
        first = int(known[0]) if len(known) else 0
        head = Segment.HEAD.pack(MAGIC, width, len(docs), len(docs) - len(known), first)
        ends = np.cumsum([len(p) // width for p in parts], dtype=np.int64)
        return b"".join([head, EliasFano.of(ends).dump(), EliasFano.of(known - first).dump(), *parts])

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.docs.select(i - self.nulls)

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return np.frombuffer(self.data, f"<u{self.width}", end - start, start * self.width)


# What a vocabulary file states if its words never cross white space and plain words are only put in lower case.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class Pieces(dict):
    """The packed ids of a piece of text without spaces; the library encodes each piece once while it is kept."""

    MOST = 600_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.apart = spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == SPLITTER
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.words: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids of a text by the whole tokenizer, or, of one plain word, by its model alone, which is all that acts on it."""
        if PLAIN.fullmatch(text):
            spelled = text.lower().encode().decode("latin-1").translate(BYTE_SIGNS)
            return np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], f"<u{self.width}").tobytes()
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, f"<u{self.width}").tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(self) > self.MOST:
            self.clear()
        if len(self.words) > self.MOST:
            self.words.clear()
        # a run of plain letters is a word for the tokenizer and has the ids of its lower case, whatever sign follows
        end = len(piece)
        while end and piece[end - 1] in ".,!?;:%#*$&":
            end -= 1
        word = piece[:end]
        if PLAIN.fullmatch(word):
            word = word.lower()
            if word not in self.words:
                self.words[word] = self.encode(word)
            found = self.words[word]
            if end < len(piece):
                rest = piece[end:]
                if rest not in self.words:
                    self.words[rest] = self.encode(rest)
                found += self.words[rest]
        else:
            found = self.encode(piece)
        self[piece] = found
        return found


@functools.lru_cache(2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def packed(text: str, pieces: Pieces) -> bytes:
    """The ids of a text as the library gives them.

    Where the vocabulary's words never cross white space the pieces between spaces are encoded apart; a text that spells out a special token, and every text of
    another kind of vocabulary, is encoded whole.
    """
    if not pieces.apart or any(s in text for s in pieces.special):
        return pieces.whole(text)
    return b"".join(map(pieces.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


def write_segments(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, segment_bytes: int = 4 << 20, key: str = "doc_id", text: str = "text") -> None:
    """Encode every document and write the segments as rows of a Parquet table at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(tokenizer)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], f"<u{pieces.width}").tobytes()
        docs, parts, size, seq = [], [], 0, 0

        def cut() -> pa.RecordBatch:
            known = [d for d in docs if d is not None]
            row = [part, seq, known[0] if known else None, known[-1] if known else None, len(docs), size // pieces.width, Segment.dump(docs, parts, pieces.width)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["part", "seq", "first_doc", "last_doc", "n_docs", "n_ids", "payload"])

        for batch in lengthy(batches):
            for doc, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = packed(words, pieces) + end
                if docs and size + len(ids) > segment_bytes:
                    yield cut()
                    docs, parts, size, seq = [], [], 0, seq + 1
                docs.append(doc)
                parts.append(ids)
                size += len(ids)
        if docs:
            yield cut()

    slim = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = slim.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    map_arrow(ordered, run, SEGMENT).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the segments: doc_id, start, n_tokens, ids_crc32, part, seq."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                segment = Segment(payload)
                starts = [0, *(segment.ends.select(i) for i in range(segment.count))]
                crc = [zlib.crc32(segment.ids(i).astype("<u4").tobytes()) for i in range(segment.count)]
                columns = [[segment.doc_id(i) for i in range(segment.count)], starts[:-1], [b - a for a, b in zip(starts, starts[1:])], crc]
                arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array([v] * segment.count, pa.int32()) for v in (part, seq)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "inner", "n_tokens", "ids_crc32", "part", "seq"])

    segments = spark.read.schema(SEGMENT).parquet(path)
    # where each segment starts: sums over the parts (as many rows as the writer had tasks), then within each part
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = segments.select("part", "seq", inside.alias("inside")).join(parts.select("part", before.alias("before")), "part")
    docs = map_arrow(segments.select("part", "seq", "payload"), run, "doc_id bigint, inner bigint, n_tokens bigint, ids_crc32 bigint, part int, seq int")
    joined = docs.join(base, ["part", "seq"])
    return joined.select("doc_id", (F.col("before") + F.col("inside") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", "part", "seq")


def store_and_read(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the documents to a new folder below the shared scratch folder and read them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_segments(docs, path, tokenizer, **options)
    return read_documents(docs.sparkSession, path)
