"""Substring dedup by repeated-phrase automata.

A window is 20 consecutive words. Of the eight-word phrases in a window, the one with the least hash is its anchor; equal
windows have equal anchors at one place, so a window recurs only where its anchor recurs.

1. Every document gives its anchors (hash, document, place). Sorted by hash, those that occur at least twice in the corpus
   are confirmed as recurring and go back to their documents. The sort is a stream: no group is held, however large.
2. In every partition of documents, a shard's recurring phrases are compiled into an Aho-Corasick automaton over word
   numbers, and its documents stream through it, which locates every occurrence. The windows anchored there are given
   with their hashes, to be sorted by (anchor, document, place): the first occurrence of a window stays, all later ones
   are marked. This, too, is a stream in which only the windows of one anchor are held.
3. Marked spans return to their documents, whose covered words are left out.

What recurs within a slice of a task is settled there: one row goes to its group, the others are dealt out evenly, so an
anchor that a third of all documents share reaches its group once a slice. Steps 2 and 3 read documents by one and the
same shuffle. Windows are compared by 64-bit hashes within one anchor.

Defined results: null has no words; a document of fewer than 20 words loses none; rows that repeat identifier and text are
one document with repeated results; rows of one identifier with different texts are ordered by a hash of the text; rows
without an identifier come first; other columns are left out.
"""

from __future__ import annotations

import itertools
import operator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidehouse.llm import arrow, word_hashes

WINDOW, PHRASE = 20, 8
#: Bytes of documents whose recurring phrases make up one automaton.
SHARD_BYTES = 8 << 20
_NONE = -(1 << 63)
_END = operator.itemgetter(0)

_ANCHOR = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("text_key", pa.int64()), ("place", pa.int32()),
                     ("sure", pa.bool_())])
_WINDOWS = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("text_key", pa.int64()), ("start", pa.int32()),
                      ("windows", pa.int32()), ("hashes", pa.binary())])
_SPANS = pa.schema([("doc", pa.int64()), ("text_key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32())])


def _least_places(phrases: np.ndarray, width: int) -> np.ndarray:
    """For every window, the place of the least of ``width`` consecutive phrase hashes, the first one of equals."""
    n = len(phrases) - width + 1
    best = np.arange(len(phrases))
    done = 1
    while done < width:  # each step doubles, or completes, the stretch looked at
        step = min(done, width - done)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(phrases[right] < phrases[left], right, left)
        done += step
    return best[:n]


class Windows:
    """Anchors and hashes of the windows of texts whose words stand end to end; no window reaches into the next text."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, window: int = WINDOW, phrase: int = PHRASE):
        self.hashes = hashes
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.phrases = word_hashes.runs(hashes, phrase)
        least = _least_places(self.phrases, window - phrase + 1) if len(hashes) >= window else np.zeros(0, int)
        last = np.repeat(np.cumsum(counts), counts)[:len(least)]
        self.starts = np.flatnonzero(np.arange(len(least)) + window <= last)
        self.anchor = least[self.starts]


class _Numbers(dict):
    """Numbers of words, in the order of their first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _repeats(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every value, the place of its first appearance, and how often it appears."""
    _, first, inverse, counts = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    return first[inverse], counts[inverse]


def _spread(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A key that deals rows out evenly, for rows that need to meet no others."""
    return word_hashes.mix(doc.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64)).view(np.int64)


def _anchors(batches):
    """Anchors of all windows. Of anchors that recur within a slice, one goes to the anchor's group and the others anywhere."""
    hashes = word_hashes.WordHashes()
    for part in arrow.slices(batches, "text"):
        words = [text.split() for text in arrow.raw(part.column("text"))]
        windows = Windows(hashes.of([word for own in words for word in own]), np.fromiter(map(len, words), np.int64, len(words)))
        own = windows.anchor
        own = own[np.insert(own[1:] != own[:-1], 0, True)] if len(own) else own  # anchors ascend
        docs, keys = (part.column(n).to_numpy()[windows.row[own]] for n in ("doc", "text_key"))
        anchor, place = windows.phrases[own].view(np.int64), windows.place[own].astype(np.int32)
        first, times = _repeats(anchor)
        anchor = np.where(first == np.arange(len(anchor)), anchor, _spread(docs, place))
        yield arrow.batch(_ANCHOR, anchor, docs, keys, place, times > 1)


def _recurring(batches):
    """Rows sorted by anchor to those that are sure to recur or whose anchor is not alone."""
    held = None  # the last row, while its anchor has been seen once
    last = None
    out = pa.schema([_ANCHOR.field(n) for n in ("doc", "text_key", "place")])
    for part in batches:
        if not part.num_rows:
            continue
        anchor = part.column("anchor").to_numpy()
        same = anchor[1:] == anchor[:-1]
        many = np.append(same, False) | np.insert(same, 0, False)
        many |= part.column("sure").to_numpy(zero_copy_only=False)
        if anchor[0] == last:
            many[:int(np.searchsorted(anchor, last, "right"))] = True
            if held is not None:
                yield held
        rest = part.select(["doc", "text_key", "place"])
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(many)) for c in rest.columns], schema=out)
        held = None if many[-1] else pa.RecordBatch.from_arrays(rest.slice(part.num_rows - 1).columns, schema=out)
        last = anchor[-1]


def _runs(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where runs of consecutive places in one row begin."""
    return np.flatnonzero(np.insert((row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1), 0, True)) if len(row) else \
        np.zeros(0, np.int64)


def _spelling(codes: int) -> np.ndarray:
    """Three letters for every code below ``codes``, of an alphabet for each place: no code begins inside another."""
    base = max(2, int(np.ceil(np.cbrt(codes))))
    code = np.arange(codes)
    return np.stack([code // base ** 2, code // base % base + base, code % base + 2 * base], axis=1).astype("<u2") + np.uint16(1)


def _occurrences(every: np.ndarray, row: np.ndarray, phrases: np.ndarray, words: int) -> np.ndarray:
    """Whether a phrase begins at a place of ``every``: word numbers (below ``words``) of texts, which ``row`` tells apart.

    The automaton searches a node's branches one after another, and its root has one for every word that a phrase begins
    with. Words are therefore spelled by three letters each: no node has more branches than the cube root of the words.
    Only stretches of words that are in phrases are streamed; all else breaks every phrase.
    """
    used = np.zeros(words, bool)
    used[phrases] = True
    codes = np.where(used, np.cumsum(used), 0).astype(np.int32)  # 0 stands between stretches
    spelling = _spelling(int(used.sum()) + 1)
    automaton, size = ahocorasick.Automaton(ahocorasick.STORE_INTS), 3 * PHRASE
    spelled = spelling[codes[phrases]].tobytes().decode("utf-16-le")
    for begin in range(0, len(spelled), size):
        automaton.add_word(spelled[begin:begin + size], 1)
    automaton.make_automaton()
    known = used[every]
    begins = np.flatnonzero(np.insert((known[1:] != known[:-1]) | (row[1:] != row[:-1]), 0, True))
    lengths = np.diff(np.append(begins, len(every)))
    chosen = known[begins] & (lengths >= PHRASE)
    begins, lengths = begins[chosen], lengths[chosen]
    stretch = np.repeat(np.arange(len(begins), dtype=np.int32), lengths)
    source = np.arange(len(stretch), dtype=np.int32) + (begins - (np.cumsum(lengths) - lengths)).astype(np.int32)[stretch]
    spot = np.arange(len(stretch), dtype=np.int32) + stretch  # one place is left between stretches
    stream, place = (np.zeros(len(stretch) + len(begins), np.int32) for _ in range(2))
    stream[spot], place[spot] = codes[every[source]], source
    ends = np.fromiter(map(_END, automaton.iter(spelling[stream].tobytes().decode("utf-16-le"))), np.int64)
    located = np.zeros(len(every), bool)
    located[place[(ends + 1) // 3 - PHRASE]] = True
    return located


def _locate(batches):
    """``doc, text_key, text, places`` to the windows at recurring phrases, by an automaton a shard.

    Of windows that recur within a shard, the first goes to its anchor's group; the others are later ones already and go
    anywhere, as spans.
    """
    hashes = word_hashes.WordHashes()
    for part in arrow.slices(batches, "text", SHARD_BYTES):
        numbers = _Numbers()
        texts = [list(map(numbers.__getitem__, text.split())) for text in arrow.raw(part.column("text"))]
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        every = np.fromiter(itertools.chain.from_iterable(texts), np.int64, int(counts.sum()))
        del texts
        windows = Windows(hashes.of(list(numbers))[every], counts)
        places = part.column("places")
        at = places.flatten().to_numpy() + np.repeat(np.cumsum(counts) - counts, pc.list_value_length(places).to_numpy())
        if not len(at):
            continue
        phrases = every[np.unique(at[np.unique(windows.phrases[at], return_index=True)[1]])[:, None] + np.arange(PHRASE)]
        located = _occurrences(every, windows.row, phrases, len(numbers))
        is_there = located[windows.anchor]
        starts = windows.starts[is_there]
        if not len(starts):
            continue
        row, place = windows.row[starts], windows.place[starts]
        anchor, whole = windows.phrases[windows.anchor[is_there]], word_hashes.runs(windows.hashes, WINDOW)[starts]
        doc, key = part.column("doc").to_numpy(), part.column("text_key").to_numpy()
        first, _ = _repeats(whole)
        leads = first == np.arange(len(whole))
        # A repeated row is the same document at the same place, and no earlier start.
        later = ~leads & ((doc[row] != doc[row[first]]) | (key[row] != key[row[first]]) | (place != place[first]))
        own = np.flatnonzero(later)
        begins = _runs(row[own], place[own])
        spans = own[begins]
        lengths = np.diff(np.append(begins, len(own)))
        yield arrow.batch(_WINDOWS, _spread(doc[row[spans]], place[spans]), doc[row[spans]], key[row[spans]],
                          place[spans].astype(np.int32), lengths.astype(np.int32), pa.nulls(len(spans), pa.binary()))
        own = np.flatnonzero(leads)
        begins = np.flatnonzero(np.insert((anchor[own][1:] != anchor[own][:-1]) | (row[own][1:] != row[own][:-1])
                                          | (place[own][1:] != place[own][:-1] + 1), 0, True))
        firsts = own[begins]
        offsets = np.append(begins, len(own)).astype(np.int32) * 8
        packed = pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer(offsets), pa.py_buffer(whole[own].tobytes())])
        yield arrow.batch(_WINDOWS, anchor[firsts].view(np.int64), doc[row[firsts]], key[row[firsts]],
                          place[firsts].astype(np.int32), np.zeros(len(firsts), np.int32), packed)


def _hashes(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(all hashes, how many each row has) of a column of packed hashes without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].copy().view(np.uint64) if data else np.zeros(0, np.uint64)
    return whole, np.diff(offsets) // 8


def _later(batches):
    """Windows sorted by (anchor, document, text, place) to spans of windows that also start earlier; spans go through."""
    last, seen, at = None, np.zeros(0, np.uint64), {}
    for part in arrow.slices(batches, "hashes"):
        ready = part.filter(part.column("hashes").is_null())
        if ready.num_rows:
            yield arrow.batch(_SPANS, *(ready.column(n) for n in ("doc", "text_key", "start", "windows")))
        part = part.filter(part.column("hashes").is_valid())
        if not part.num_rows:
            continue
        anchor, doc, key, start = (part.column(n).to_numpy() for n in ("anchor", "doc", "text_key", "start"))
        whole, counts = _hashes(part.column("hashes"))
        row = np.repeat(np.arange(len(counts)), counts)
        place = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        # Equal windows of one anchor, in order of appearance.
        order = np.lexsort((np.arange(len(row)), whole, anchor[row]))
        a, w = anchor[row][order], whole[order]
        new = np.insert((a[1:] != a[:-1]) | (w[1:] != w[:-1]), 0, True)
        leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        marked = np.zeros(len(row), bool)
        marked[order] = (doc[row[leader]] != doc[row[order]]) | (key[row[leader]] != key[row[order]]) | (place[leader] != place[order])
        if anchor[0] == last:  # the anchor's windows in earlier batches
            own = np.flatnonzero(anchor[row] == last)
            spot = np.minimum(np.searchsorted(seen, whole[own]), len(seen) - 1)
            known = seen[spot] == whole[own]
            for i in own[known]:
                marked[i] = (int(doc[row[i]]), int(key[row[i]]), int(place[i])) != at[int(whole[i])]
        ends = np.flatnonzero(anchor[row] == anchor[-1])
        at = at if anchor[-1] == last else {}
        for i in ends:
            at.setdefault(int(whole[i]), (int(doc[row[i]]), int(key[row[i]]), int(place[i])))
        last, seen = anchor[-1], np.sort(np.fromiter(at, np.uint64, len(at)))
        hit = np.flatnonzero(marked)
        if len(hit):
            begins = _runs(row[hit], place[hit])
            lengths = np.diff(np.append(begins, len(hit)))
            own = hit[begins]
            yield arrow.batch(_SPANS, doc[row[own]], key[row[own]], place[own].astype(np.int32), lengths.astype(np.int32))


def _remove(batches):
    """``doc_id, text, spans`` to the digest of what is kept."""
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
    for part in arrow.slices(batches, "text"):
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(arrow.raw(part.column("text")), part.column("spans").to_pylist(), strict=True):
            words = text.split()
            n_words.append(len(words))
            if spans:
                marks = np.zeros(len(words) + 1, np.int32)
                begin = np.array([s["start"] for s in spans])
                np.add.at(marks, begin, 1)
                np.add.at(marks, begin + np.array([s["windows"] for s in spans]) + WINDOW - 1, -1)
                left = np.cumsum(marks)[:-1] == 0
                n_removed.append(int(len(words) - left.sum()))
                words = [words[i] for i in np.flatnonzero(left)]
            else:
                n_removed.append(0)
            kept.append(b" ".join(words).decode())
        yield arrow.batch(out, part.column("doc_id"), n_words, n_removed, kept)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every document; kept words are joined by one blank."""
    text = arrow.text_column()
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("doc"), F.xxhash64(text).alias("text_key"),
                        text.alias("text"))
    key = ["doc", "text_key"]
    anchors = keyed.mapInArrow(_anchors, "anchor long, doc long, text_key long, place int, sure boolean")
    recurring = anchors.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _recurring, "doc long, text_key long, place int")
    places = recurring.groupBy(*key).agg(F.collect_set("place").alias("places"))
    # Both joins shuffle the same columns of the documents, so Spark shuffles them once.
    located = keyed.join(places.hint("merge"), key).mapInArrow(
        _locate, "anchor long, doc long, text_key long, start int, windows int, hashes binary")
    spans = located.repartition("anchor").sortWithinPartitions("anchor", "doc", "text_key", "start").mapInArrow(
        _later, "doc long, text_key long, start int, windows int")
    marked = spans.groupBy(*key).agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    doc_id = F.nullif("doc", F.lit(_NONE)).alias("doc_id")
    return keyed.join(marked.hint("merge"), key, "left").select(doc_id, "text", "spans").mapInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept_text string")
