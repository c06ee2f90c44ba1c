"""Exact duplicates by Patricia tries.

Texts go to partitions by their length and content hash. In a partition, full byte strings are inserted into a compressed
radix trie; the terminal node of a text holds its owner, the number of its copies and its digest. A trie that outgrows
its budget writes whole subtrees to the task's disk; each is finished alone, by the same rule. A first trie per block of
input rows merges copies before anything is shuffled, so a text that a third of all rows share reaches its partition
once per block. Documents then learn their owner by a join on length and digest, which Spark may split where one text is
that frequent.

Terminals hold the smallest identifier; with ``keep="largest"`` identifiers are compared the other way round.

Defined results: null counts as empty; rows without an identifier never own while others can; rows that repeat both text
and owner's identifier all count as the one that stays; any other columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidehouse.llm import arrow

#: Bytes of a trie, labels and nodes, before subtrees are written to disk.
TRIE_BYTES = 64 << 20
#: What a node takes beside its label: itself, its dictionary, its value and its edge.
NODE_BYTES = 300
#: Text bytes whose copies are merged before the shuffle.
BLOCK_BYTES = 16 << 20

_ENTRY = "n_bytes long, text_sha256 string, text binary, owner long, group_size long"
_ENTRY_ARROW = pa.schema([("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("text", pa.binary()), ("owner", pa.int64()),
                          ("group_size", pa.int64())])
_OWNER = "n_bytes long, text_sha256 string, keep_id long, group_size long"
_OWNER_ARROW = pa.schema([("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()),
                          ("group_size", pa.int64())])


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class _Node:
    __slots__ = ("value", "children", "spilled")

    def __init__(self):
        self.value = None  # (owner, rows, digest) of the text that ends here
        self.children: dict[int, tuple[bytes, _Node]] = {}
        self.spilled: str | None = None  # the file that holds what lies below


class PatriciaTrie:
    """Full byte strings with (owner, number of rows, digest) at their terminals."""

    def __init__(self, smallest: bool = True, budget: int = TRIE_BYTES, folder: str | None = None):
        self._root, self._smallest, self._budget, self._folder = _Node(), smallest, budget, folder
        self._bytes, self._files = 0, 0

    def _merge(self, old, new):
        if old is None:
            return new
        a, b = old[0], new[0]
        owner = b if a is None else a if b is None else min(a, b) if self._smallest else max(a, b)
        return owner, old[1] + new[1], old[2]

    def insert(self, text: bytes, owner: int | None, rows: int = 1, digest: str | None = None) -> None:
        new, node, at = (owner, rows, digest), self._root, 0
        while True:
            if node.spilled:
                with open(node.spilled, "ab") as out:
                    pickle.dump((text[at:], new), out)
                return
            if at == len(text):
                node.value = self._merge(node.value, new)
                return
            edge = node.children.get(text[at])
            if edge is None:
                leaf = _Node()
                leaf.value = new
                node.children[text[at]] = (text[at:], leaf)
                self._bytes += len(text) - at + NODE_BYTES
                if self._bytes > self._budget and self._folder:
                    self._spill()
                return
            label, child = edge
            if text.startswith(label, at):
                at += len(label)
                node = child
                continue
            shared = _common(label, text, at)
            middle = _Node()
            middle.children[label[shared]] = (label[shared:], child)
            node.children[text[at]] = (label[:shared], middle)
            self._bytes += NODE_BYTES
            at += shared
            node = middle

    @staticmethod
    def _spilled(path: str) -> Iterator[tuple[bytes, tuple]]:
        """What a file holds; the file goes."""
        with open(path, "rb") as source:
            while True:
                try:
                    yield pickle.load(source)
                except EOFError:
                    break
        os.unlink(path)

    @classmethod
    def _below(cls, node: _Node) -> Iterator[tuple[bytes, tuple]]:
        stack = [(b"", node)]
        while stack:
            prefix, node = stack.pop()
            if node.spilled:
                yield from ((prefix + rest, value) for rest, value in cls._spilled(node.spilled))
            if node.value is not None:
                yield prefix, node.value
            stack.extend((prefix + label, child) for label, child in node.children.values())

    def _spill(self) -> None:
        """Write subtrees below the first branching to disk until half of the budget is free."""
        node = self._root
        while len(node.children) == 1 and node.value is None:
            only = next(iter(node.children.values()))[1]
            if only.spilled:
                break
            node = only
        for label, child in list(node.children.values()):
            if self._bytes <= self._budget // 2:
                break
            if child.spilled or not child.children:
                continue
            path = os.path.join(self._folder, f"subtree-{id(self):x}-{self._files}")
            self._files += 1
            freed = 0
            with open(path, "ab") as out:
                for rest, value in self._below(child):
                    pickle.dump((rest, value), out)
                stack = [child]
                while stack:
                    for own, below in stack.pop().children.values():
                        freed += len(own) + NODE_BYTES
                        stack.append(below)
            child.value, child.children, child.spilled = None, {}, path
            self._bytes -= freed

    def terminals(self) -> Iterator[tuple[bytes, tuple]]:
        """(text, (owner, rows, digest)); spilled subtrees are finished one at a time, and their files removed."""
        stack = [(b"", self._root)]
        while stack:
            prefix, node = stack.pop()
            if node.spilled:
                sub = PatriciaTrie(self._smallest, self._budget, self._folder)
                for rest, value in self._spilled(node.spilled):
                    sub.insert(rest, *value)
                yield from ((prefix + rest, value) for rest, value in sub.terminals())
                continue
            if node.value is not None:
                yield prefix, node.value
            stack.extend((prefix + label, child) for label, child in node.children.values())


def _merge_block(smallest: bool, block_bytes: int):
    def rows(trie: PatriciaTrie):
        found = list(trie.terminals())
        return arrow.batch(_ENTRY_ARROW, [len(t) for t, _ in found], [hashlib.sha256(t).hexdigest() for t, _ in found],
                           [t for t, _ in found], [v[0] for _, v in found], [v[1] for _, v in found])

    def work(batches):
        trie, held = PatriciaTrie(smallest), 0
        for part in arrow.slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), arrow.raw(part.column("text")), strict=True):
                trie.insert(text, doc_id)
                held += len(text)
            if held >= block_bytes:
                yield rows(trie)
                trie, held = PatriciaTrie(smallest), 0
        if held or trie._root.value is not None:
            yield rows(trie)

    return work


def _owners(smallest: bool, budget: int):
    def work(batches):
        with tempfile.TemporaryDirectory() as folder:
            trie = PatriciaTrie(smallest, budget, folder)
            for part in arrow.slices(batches, "text"):
                columns = [part.column(n).to_pylist() for n in ("text", "owner", "group_size", "text_sha256")]
                for row in zip(*columns, strict=True):
                    trie.insert(*row)
            out: list[tuple] = []
            for text, (owner, rows, digest) in trie.terminals():
                out.append((len(text), digest, owner, rows))
                if len(out) == 4096:
                    yield arrow.batch(_OWNER_ARROW, *zip(*out, strict=True))
                    out = []
            if out:
                yield arrow.batch(_OWNER_ARROW, *zip(*out, strict=True))

    return work


def owners(docs: DataFrame, keep: str = "smallest", trie_bytes: int = TRIE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``n_bytes, text_sha256, keep_id, group_size`` of every distinct text."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), arrow.text_column().alias("text"))
    merged = rows.mapInArrow(_merge_block(keep == "smallest", block_bytes), _ENTRY)
    dealt = merged.repartition("n_bytes", "text_sha256")
    return dealt.mapInArrow(_owners(keep == "smallest", trie_bytes), _OWNER)


def _resolved(docs: DataFrame, keep: str, **limits: int) -> DataFrame:
    """Columns ``_c0, _c1 ...`` of every document with those of its owner, and its identifier as ``doc_id``."""
    text = arrow.text_column()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                      F.sha2(text.cast("binary"), 256).alias("text_sha256"),
                      *(arrow.column(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)))
    joined = own.join(owners(docs, keep, **limits), ["n_bytes", "text_sha256"])
    return joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_copies(docs: DataFrame, keep: str = "smallest", **limits: int) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every document."""
    return _resolved(docs, keep, **limits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def without_copies(docs: DataFrame, keep: str = "smallest", **limits: int) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = _resolved(docs, keep, **limits).where("kept")
    return kept.select([f"_c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
