"""Benchmark decontamination by suffix arrays over the training texts.

A task turns its documents, a shard at a time, into word numbers and sorts their suffixes by their first ten words: a
suffix array over words, sparse in that a suffix whose first words no test item holds has no place in it, as nothing
could find it. Every suffix of every test item is then binary-searched in the shard's array, which gives all places where
its window occurs verbatim. Windows that follow each other along both texts add up to longest matches with locations.
Documents stay where they are read: there is no shuffle, and a hot source or a passage that all documents share costs no
more than other text.

Test items go to the tasks as a broadcast of at most ``ITEM_BYTES``; more of them are searched in several blocks, one
after another in the same pass over the documents, so the result is whole for a benchmark of any size.

Defined results: null has no words; an item of fewer than ten words is one window, one without words none; an item
without an identifier takes part as identifier ''; items with equal identifiers count as one; other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tidehouse.llm import arrow

#: Words of a window.
WINDOW = 10
#: Bytes of test items that are searched at a time.
ITEM_BYTES = 16 << 20
#: Bytes of documents in one suffix array.
SHARD_BYTES = 8 << 20

#: Bytes that are no part of words: ASCII other than digits and letters (fixed values of the word pattern).
_NO_WORD = bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))
_TO_BLANK = bytes.maketrans(_NO_WORD, b" " * len(_NO_WORD))

_MATCH = "struct<item_id:string,doc_word:long,item_word:long,n_words:long>"
_MATCHES = f"array<{_MATCH}>"
_OUT = f"doc_id long, text string, n_words long, hits binary, items array<string>, matches {_MATCHES}"
_MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()),
                                   ("n_words", pa.int64())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("hits", pa.binary()),
                    ("items", pa.list_(pa.string())), ("matches", _MATCH_ARROW)])


def words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.lower().translate(_TO_BLANK).split()


class TestSuffixes:
    """The suffixes of test items as keys of ten word numbers; number 0 stands for every word no item holds."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        split = [(item_id, own) for item_id, text in items if (own := words(text))]
        self.numbers = {w: i + 1 for i, w in enumerate(sorted({w for _, own in split for w in own}))}
        self.item_ids = [item_id for item_id, _ in split]
        item, place, size, rows = [], [], [], []
        for k, (_, own) in enumerate(split):
            ids = [self.numbers[w] for w in own]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1):
                item.append(k)
                place.append(i)
                size.append(n)
                rows.append(ids[i:i + n] + [0] * (window - n))
        self.item, self.place, self.size = (np.array(x, np.int64) for x in (item, place, size))
        self.keys = np.array(rows, np.int64).reshape(-1, window)
        #: Words that begin test suffixes, and pairs where no shorter window is asked for.
        self.depth = int(min(self.size.min(initial=window), 3))
        self.heads = np.unique(self._head(self.keys)) if len(rows) else np.zeros(0, np.int64)

    def _head(self, keys: np.ndarray) -> np.ndarray:
        head = keys[:, 0].copy()
        for k in range(1, self.depth):
            head = head * (len(self.numbers) + 1) + keys[:, k]  # 3 x 20 bits at 16 MB of items
        return head

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(test suffix, place in ``ids``) of every verbatim occurrence of a window. ``ids`` has ``window`` zeros at its end."""
        n = len(ids) - self.window
        places = np.flatnonzero(ids[:n])
        for k in range(1, self.depth):
            places = places[ids[places + k] != 0]
        head = ids[places]
        for k in range(1, self.depth):
            head = head * (len(self.numbers) + 1) + ids[places + k]
        at = np.searchsorted(self.heads, head)
        places = places[self.heads[np.minimum(at, len(self.heads) - 1)] == head] if len(self.heads) else places[:0]
        if not len(places):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = ids[places[:, None] + np.arange(self.window)]
        order = np.lexsort(keys.T[::-1])  # the suffix array of the shard
        array = _comparable(keys[order])
        low = np.searchsorted(array, _comparable(self.keys), "left")
        upper = np.where(np.arange(self.window) < self.size[:, None], self.keys, (1 << 32) - 1)
        high = np.searchsorted(array, _comparable(upper), "right")
        counts = high - low
        suffix = np.repeat(np.arange(len(counts)), counts)
        steps = np.arange(len(suffix)) - np.repeat(np.cumsum(counts) - counts, counts)
        return suffix, places[order[np.repeat(low, counts) + steps]]


def _comparable(keys: np.ndarray) -> np.ndarray:
    """Rows as byte strings that compare like the rows."""
    return np.ascontiguousarray(keys.astype(">u4")).view(f"S{keys.shape[1] * 4}").ravel()


def longest_matches(item: np.ndarray, item_at: np.ndarray, doc_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows (item, place in document, place in item, words): windows that follow each other along both texts, put together."""
    if not len(item):
        return np.zeros((0, 4), np.int64)
    order = np.lexsort((doc_at, doc_at - item_at, item))
    item, item_at, doc_at, size = (x[order] for x in (item, item_at, doc_at, size))
    diagonal = doc_at - item_at
    first = np.ones(len(item), bool)
    first[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (doc_at[1:] != doc_at[:-1] + 1)
    starts = np.flatnonzero(first)
    runs = np.diff(np.append(starts, len(item)))
    return np.column_stack([item[starts], doc_at[starts], item_at[starts], size[starts] + runs - 1])


def _search(suffixes: Broadcast):
    def work(batches):
        test: TestSuffixes = suffixes.value
        number = test.numbers.get
        for part in arrow.slices(batches, "text", SHARD_BYTES):
            texts = [words(t) for t in arrow.raw(part.column("text"))]
            counts = np.array([len(t) for t in texts], np.int64)
            starts = np.concatenate([[0], np.cumsum(counts + test.window)])
            ids = np.zeros(starts[-1] + test.window, np.int64)  # zeros between documents end every match
            for start, own in zip(starts, texts, strict=False):
                ids[start:start + len(own)] = np.fromiter((number(w, 0) for w in own), np.int64, len(own))
            suffix, place = test.find(ids)
            doc = np.searchsorted(starts, place, "right") - 1
            order = np.argsort(doc, kind="stable")
            suffix, place, doc = suffix[order], place[order] - starts[doc[order]], doc[order]
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            hits, items, matches = [], [], []
            before = [part.column(n).to_pylist() for n in ("hits", "items", "matches")]
            for k in range(len(texts)):
                a, b = bounds[k], bounds[k + 1]
                if a == b:
                    hits.append(before[0][k])
                    items.append(before[1][k])
                    matches.append(before[2][k])
                    continue
                size = test.size[suffix[a:b]]
                marks = np.zeros(counts[k] + 1, np.int32)
                np.add.at(marks, place[a:b], 1)
                np.add.at(marks, place[a:b] + size, -1)
                covered = np.packbits(np.cumsum(marks)[:-1] > 0).tobytes()
                if before[0][k] is not None:
                    covered = np.bitwise_or(*(np.frombuffer(x, np.uint8) for x in (covered, before[0][k]))).tobytes()
                hits.append(covered)
                item = test.item[suffix[a:b]]
                items.append((before[1][k] or []) + [test.item_ids[i] for i in np.unique(item)])
                longest = longest_matches(item, test.place[suffix[a:b]], place[a:b], size)
                matches.append((before[2][k] or []) + [
                    {"item_id": test.item_ids[i], "doc_word": d, "item_word": p, "n_words": n} for i, d, p, n in longest.tolist()])
            yield arrow.batch(_ARROW, part.column("doc_id"), part.column("text"), counts, hits, items, matches)

    return work


def _summary(batches):
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                     ("items_sha256", pa.string()), ("matches", _MATCH_ARROW)])
    for part in batches:
        n_hit = [0 if h is None else int(np.unpackbits(np.frombuffer(h, np.uint8)).sum()) for h in part.column("hits").to_pylist()]
        items = [sorted(set(own or [])) for own in part.column("items").to_pylist()]
        digests = [hashlib.sha256(",".join(own).encode()).hexdigest() for own in items]
        yield arrow.batch(out, part.column("doc_id"), part.column("n_words"), n_hit, list(map(len, items)), digests,
                          part.column("matches"))


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches`` of every document.

    ``matches`` holds the longest verbatim matches: item, first word in the document, first word in the item, words.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             arrow.text_column().alias("text"))
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // item_bytes))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), arrow.text_column().alias("text"),
                        F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("binary").alias("hits"),
                        F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast(_MATCHES).alias("matches"))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        suffixes = TestSuffixes(sorted((r.item_id, r.text.encode()) for r in own), window)
        found = found.mapInArrow(_search(spark.sparkContext.broadcast(suffixes)), _OUT)
    return found.drop("text").mapInArrow(
        _summary, f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, matches {_MATCHES}").select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "matches")
