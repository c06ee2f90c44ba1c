"""Token ids on disk with Elias-Fano document boundaries.

A shard file holds, in ascending document order, the ids of its documents end to end (two bytes each where the vocabulary
allows it), then two Elias-Fano sequences: where each document ends, and the document ids. An Elias-Fano sequence of n
numbers below u takes about 2 + log2(u/n) bits a number: the low bits packed, the high bits as unary gaps in a bit
vector; ``select`` finds the i-th number through one 32-bit rank per 512 bits. No 64-bit table is kept.

    magic | ids | header (JSON) | header length, 8 bytes | magic

Documents are dealt to shards by ranges of their id, so a shard is sorted after one shuffle and shards follow each other.
Where a shard begins in the whole corpus is the sum of the counts before it, from the manifest with one row per shard.

Defined results: a null text is empty, so its document is the end id alone; repeated document ids are ordered by text; a
null document id comes first and is read back as null; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidehouse.llm import arrow, encoding

MAGIC = b"EFTOKEN1"
END_ID = 2
#: Bits of the high vector between two rank samples.
BLOCK_BITS = 512
#: Numbers whose low bits are packed at a time.
PACKED = 1 << 16
#: Documents looked up at a time on reading, and ids that are read at a time unless one document has more.
READ_DOCS, READ_IDS = 1024, 1 << 20

_MANIFEST = "shard int, path string, n_docs long, n_ids long, first_id long"
_MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                             ("first_id", pa.int64())])
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class EliasFano:
    """A non-decreasing sequence of numbers; ``select`` gives those at some places."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ranks = n, low_bits, low, high, ranks

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        blocks = (int(places[-1]) if n else 0) // BLOCK_BITS + 1
        bits = np.zeros(blocks * BLOCK_BITS, np.uint8)
        bits[places] = 1
        ranks = np.concatenate([[0], np.cumsum(bits.reshape(blocks, BLOCK_BITS).sum(1, dtype=np.int64))]).astype("<u4")
        shifts = np.arange(low_bits, dtype=np.uint64)
        # a block of 64 K values fills whole bytes, so blocks are packed apart
        cut = (values[at:at + PACKED] for at in range(0, max(n, 1), PACKED))
        low = np.concatenate([np.packbits(((part[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
                              for part in cut])
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ranks)

    def select(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        if not len(at):
            return np.zeros(0, np.uint64)
        block = np.searchsorted(self.ranks, at, side="right") - 1
        own, inverse = np.unique(block, return_inverse=True)
        width = BLOCK_BITS // 8
        bits = np.unpackbits(self.high.reshape(-1, width)[own], axis=1, bitorder="little")
        counts = np.cumsum(bits, axis=1, dtype=np.int32)
        want = (at - self.ranks[block].astype(np.int64) + 1).astype(np.int32)
        place = np.empty(len(at), np.int64)
        for i in range(len(own)):
            mine = inverse == i
            place[mine] = np.searchsorted(counts[i], want[mine])
        high = (place + block * BLOCK_BITS - at).astype(np.uint64)
        if not self.low_bits:
            return high
        spots = at[:, None] * self.low_bits + np.arange(self.low_bits)
        picked = (self.low[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1
        low = (picked.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return (high << np.uint64(self.low_bits)) | low

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.ranks.tobytes()]

    @property
    def n_bytes(self) -> int:
        return sum(map(len, self.parts()))


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class ShardWriter:
    """Writes one shard: ids as they come, boundaries at the end; the file gets its name when it is whole."""

    def __init__(self, folder: str, shard: int, wide: bool):
        self._fs, root = _filesystem(folder)
        self.name = f"{root}/shard-{shard:06d}.ef"
        self._fs.create_dir(root, recursive=True)
        self._temporary = f"{root}/_writing-{shard:06d}-{uuid.uuid4().hex}"
        self._out = self._fs.open_output_stream(self._temporary)
        self._out.write(MAGIC)
        self._kind = "<u4" if wide else "<u2"
        self._lengths: list[int] = []
        self._doc_ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        numbers = np.frombuffer(ids, "<u4")
        self._out.write(numbers.astype(self._kind).tobytes())
        self._lengths.append(len(numbers))
        self._doc_ids.append(doc_id)

    def close(self) -> tuple[int, int, int | None]:
        ends = np.cumsum(np.array(self._lengths, np.int64))
        known = [d for d in self._doc_ids if d is not None]
        least = known[0] if known else 0
        ids = EliasFano.encode(np.array([d - least for d in known], np.uint64))
        boundaries = EliasFano.encode(ends)
        parts = [*boundaries.parts(), *ids.parts()]
        header = {"kind": self._kind, "docs": len(ends), "ids": int(ends[-1]) if len(ends) else 0, "least": least,
                  "nulls": len(ends) - len(known), "low_bits": [boundaries.low_bits, ids.low_bits],
                  "parts": list(map(len, parts))}
        for part in parts:
            self._out.write(part)
        text = json.dumps(header).encode()
        self._out.write(text + len(text).to_bytes(8, "little") + MAGIC)
        self._out.close()
        self._fs.move(self._temporary, self.name)  # a retried task puts the same bytes there
        return len(ends), header["ids"], known[0] if known else None


class ShardReader:
    """Random access to a shard: document ``i`` without reading the others."""

    def __init__(self, path: str):
        fs, name = _filesystem(path)
        self._file = fs.open_input_file(name)
        size = self._file.size()
        tail = self._file.read_at(len(MAGIC) + 8, size - len(MAGIC) - 8)
        if tail[8:] != MAGIC or self._file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        length = int.from_bytes(tail[:8], "little")
        at = size - len(MAGIC) - 8 - length
        self.header = header = json.loads(self._file.read_at(length, at))
        at -= sum(header["parts"])
        parts = []
        for n in header["parts"]:
            parts.append(self._file.read_at(n, at))
            at += n
        low, high, ranks = (lambda k: np.frombuffer(parts[k], np.uint8)), (lambda k: np.frombuffer(parts[k], np.uint8)), \
            (lambda k: np.frombuffer(parts[k], "<u4"))
        self.n_docs, self._kind = header["docs"], np.dtype(header["kind"])
        self._ends = EliasFano(self.n_docs, header["low_bits"][0], low(0), high(1), ranks(2))
        self._ids = EliasFano(self.n_docs - header["nulls"], header["low_bits"][1], low(3), high(4), ranks(5))

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Where documents ``first`` to ``last`` (not included) begin and end: one number more than documents."""
        ends = self._ends.select(np.arange(max(first - 1, 0), last)).astype(np.int64)
        return ends if first else np.concatenate([[0], ends])

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        nulls, least = self.header["nulls"], self.header["least"]
        at = np.arange(max(first, nulls), max(last, nulls)) - nulls
        return [None] * (min(last, nulls) - min(first, nulls)) + [int(v) + least for v in self._ids.select(at)]

    def read(self, start: int, end: int) -> np.ndarray:
        width = self._kind.itemsize
        return np.frombuffer(self._file.read_at((end - start) * width, len(MAGIC) + start * width), self._kind)

    def close(self) -> None:
        self._file.close()


def _write(name: str, folder: str, end_id: int | None):
    def work(batches):
        encode = encoding.shared_id_bytes(name)
        wide = encoding.loaded(name).get_vocab_size() > 1 << 16
        end = b"" if end_id is None else end_id.to_bytes(4, "little")
        shard = TaskContext.get().partitionId()
        writer = None
        for part in arrow.slices(batches, "text"):
            writer = writer or ShardWriter(folder, shard, wide)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                writer.add(doc_id, encode(text) + end)
        if writer:
            n_docs, n_ids, first_id = writer.close()
            name_there = f"{folder.rstrip('/')}/{os.path.basename(writer.name)}"
            yield arrow.batch(_MANIFEST_ARROW, [shard], [name_there], [n_docs], [n_ids], [first_id])

    return work


def write_token_files(docs: DataFrame, folder: str, name: str = "byte_bpe_50k.json", end_id: int | None = END_ID) -> None:
    """Write all documents in ascending order of ``doc_id`` to shard files below ``folder``, and a manifest beside them.

    ``folder`` is one that every executor can write to. An action. Shards are as many as shuffle partitions hold rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), arrow.text_column().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(_write(name, f"{folder}/shards", end_id), _MANIFEST).write.parquet(f"{folder}/manifest")


def _crcs(reader: ShardReader, offsets: np.ndarray):
    """crc32 of documents that follow each other, read in runs of bounded size."""
    at = 0
    while at + 1 < len(offsets):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + READ_IDS, "right")) - 1)
        ids = memoryview(reader.read(int(offsets[at]), int(offsets[end])).astype("<u4").tobytes())
        for a, b in zip(offsets[at:end] - offsets[at], offsets[at + 1:end + 1] - offsets[at], strict=True):
            yield zlib.crc32(ids[4 * int(a):4 * int(b)])
        at = end


def _read(batches):
    for part in batches:
        for row in part.to_pylist():
            reader = ShardReader(row["path"])
            for first in range(0, reader.n_docs, READ_DOCS):
                last = min(first + READ_DOCS, reader.n_docs)
                offsets = reader.offsets(first, last)
                crcs = list(_crcs(reader, offsets))
                yield arrow.batch(_READ_ARROW, reader.doc_ids(first, last), offsets[:-1] + row["base"], np.diff(offsets), crcs)
            reader.close()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files; ``start`` counts over all shards."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = based.repartition(tasks, "shard")  # files are read side by side, not all where the sums were made
    return dealt.mapInArrow(_read, _READ)
