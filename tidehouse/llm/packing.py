"""Hierarchical packing of documents into sequences of several lengths.

A document of at most 4096 tokens belongs to the smallest tier (256, 512, ... 4096) that holds it; a longer one is cut
into full windows of the longest tier and its rest belongs to a tier. From the longest tier down, every document opens a
window of its tier, and the gap is filled from shorter tiers: whole documents first, best fit, then one cut to the gap.
So every window is exactly full. What a task cannot fill fully any more (less than the smallest tier) goes to a second
pass that packs the rests of 256 tasks together. Sequences of a tier are dealt to step groups of equal token count so
that the sum of squared piece lengths, which attention costs, is even.

Both passes hold a bounded number of tokens at a time. Nothing but rests is shuffled. The first pass is written once to
the shared folder, so that no document is encoded twice and a lost executor costs its own tasks only.

Defined results: a null or empty text is its end id alone; rows with equal or null ids are packed row by row; any other
columns are left out.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidehouse import session
from tidehouse.llm import arrow, encoding

TIERS = (256, 512, 1024, 2048, 4096)
END_ID = 2
#: Tokens of one step group: so many sequences of a tier as make them up.
STEP_TOKENS = 65_536
#: Tokens a task packs at a time.
BLOCK_TOKENS = 1 << 20
#: Tasks whose rests are packed together.
TASKS_A_GROUP = 256

_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "tier int, step_group long, ids binary, rest_of int")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
                    ("step_group", pa.int64()), ("ids", pa.binary()), ("rest_of", pa.int32())])


class Piece:
    """A run of one document's ids: which document, where in it, and the ids as bytes."""

    __slots__ = ("doc_id", "doc_tokens", "start", "ids")

    def __init__(self, doc_id, doc_tokens: int, start: int, ids: bytes):
        self.doc_id, self.doc_tokens, self.start, self.ids = doc_id, doc_tokens, start, ids

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, length: int) -> tuple[Piece, Piece]:
        at = length * 4
        return (Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:at]),
                Piece(self.doc_id, self.doc_tokens, self.start + length, self.ids[at:]))


def tier_of(length: int, tiers: tuple[int, ...] = TIERS) -> int:
    return tiers[bisect.bisect_left(tiers, length)]


def fill_windows(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """(full windows with their tiers, pieces left over). What is left over makes up less than the smallest tier."""
    longest, windows, pool = tiers[-1], [], []
    for piece in pieces:
        while len(piece) > longest:
            window, piece = piece.cut(longest)
            windows.append((longest, [window]))
        pool.append(piece)
    pool.sort(key=lambda p: (len(p), p.start))
    lengths = [len(p) for p in pool]

    def take(at: int) -> Piece:
        lengths.pop(at)
        return pool.pop(at)

    def put(piece: Piece) -> None:
        at = bisect.bisect_left(lengths, len(piece))
        lengths.insert(at, len(piece))
        pool.insert(at, piece)

    left = sum(lengths)
    while left >= tiers[0]:
        first = take(-1)
        # The tier that holds it, or near the end the longest one that can still be filled.
        tier = tier_of(len(first), tiers)
        if tier > left:
            tier = tiers[bisect.bisect_right(tiers, left) - 1]
        if len(first) > tier:
            first, rest = first.cut(tier)
            put(rest)
        window, gap = [first], tier - len(first)
        while gap:
            at = bisect.bisect_right(lengths, gap) - 1
            if at >= 0:
                piece = take(at)
            else:
                piece, rest = take(0).cut(gap)
                put(rest)
            window.append(piece)
            gap -= len(piece)
        windows.append((tier, window))
        left -= tier
    return windows, pool


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group number for every window: groups hold one tier and about ``step_tokens``, and cost about the same."""
    numbers, first = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}):
        own = [i for i, (t, _) in enumerate(windows) if t == tier]
        groups = max(1, -(-len(own) * tier // step_tokens))
        own.sort(key=lambda i: (-sum(len(p) ** 2 for p in windows[i][1]), i))
        for rank, i in enumerate(own):  # back and forth, so that each group gets dear and cheap windows
            turn, place = divmod(rank, groups)
            numbers[i] = first + (place if turn % 2 == 0 else groups - 1 - place)
        first += groups
    return numbers


def _rows(windows, base: int, sequences: int, groups: int, step_tokens: int) -> tuple[pa.RecordBatch, int, int]:
    numbers = step_groups(windows, step_tokens)
    columns: list[list] = [[] for _ in _ARROW]
    for at, (tier, window) in enumerate(windows):
        offset = 0
        for p in window:
            row = (p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, base + sequences + at, offset, tier,
                   base + groups + numbers[at], None, None)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += len(p)
    return (arrow.batch(_ARROW, *columns), sequences + len(windows), groups + max(numbers, default=-1) + 1)


def _blocks(pieces: Iterator[Piece], base: int, tiers, step_tokens: int, block_tokens: int,
            ) -> Iterator[tuple[pa.RecordBatch | None, list[Piece]]]:
    """Packed rows block by block; at last (None, the rests)."""
    block: list[Piece] = []
    tokens = sequences = groups = 0
    for piece in pieces:
        block.append(piece)
        tokens += len(piece)
        if tokens >= block_tokens:
            windows, block = fill_windows(block, tiers)
            tokens = sum(map(len, block))
            rows, sequences, groups = _rows(windows, base, sequences, groups, step_tokens)
            yield rows, []
    windows, block = fill_windows(block, tiers)
    if windows:
        yield _rows(windows, base, sequences, groups, step_tokens)[0], []
    yield None, block


def _pack(name: str, tiers, step_tokens: int, block_tokens: int):
    def work(batches):
        encode = encoding.id_bytes(name)
        task = TaskContext.get().partitionId()
        end = END_ID.to_bytes(4, "little")

        def pieces():
            for part in arrow.slices(batches, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = encode(text) + end
                    yield Piece(doc_id, len(ids) // 4, 0, ids)

        for rows, rests in _blocks(pieces(), task << 32, tiers, step_tokens, block_tokens):
            if rows is not None:
                yield rows
            elif rests:
                yield arrow.batch(_ARROW, *zip(*((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, None, None, None,
                                                  None, p.ids, task) for p in rests), strict=True))

    return work


def _pack_rests(tiers, step_tokens: int, block_tokens: int):
    def work(batches):
        base = (1 << 60) + (TaskContext.get().partitionId() << 32)

        def pieces():
            for part in batches:
                for row in part.select(["doc_id", "doc_tokens", "start", "ids"]).to_pylist():
                    yield Piece(**row)

        used = 0
        for rows, rests in _blocks(pieces(), base, tiers, step_tokens, block_tokens):
            if rows is not None:
                used += rows.num_rows
                yield rows
            elif rests:  # the last one of a group is not full
                last = [(tier_of(sum(map(len, rests)), tiers), rests)]
                yield _rows(last, base, 1 << 30, 1 << 30, step_tokens)[0]

    return work


def pack(docs: DataFrame, name: str = "word_bpe_49k.json", tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS,
         block_tokens: int = BLOCK_TOKENS, tasks_a_group: int = TASKS_A_GROUP) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group``.

    ``tiers`` are powers of two, ascending. Writes the first pass to the shared folder and reads it again.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), arrow.text_column().alias("text"))
    path = session.shared_dir(spark, "packed")
    rows.mapInArrow(_pack(name, tiers, step_tokens, block_tokens), _SCHEMA).write.parquet(path)
    first = spark.read.schema(_SCHEMA).parquet(path)
    rests = first.where("rest_of is not null")
    last = rests.agg(F.max("rest_of")).first()[0]
    columns = [f.name for f in _ARROW][:-2]
    packed = first.where("rest_of is null").select(columns)
    if last is None:
        return packed
    groups = last // tasks_a_group + 1
    dealt = rests.repartition(groups, F.floor(F.col("rest_of") / tasks_a_group)).sortWithinPartitions("rest_of", "doc_id", "start")
    return packed.unionByName(dealt.mapInArrow(_pack_rests(tiers, step_tokens, block_tokens), _SCHEMA).select(columns))
