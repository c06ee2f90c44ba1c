"""What the contracts say, word for word, for small tables in plain Python."""

from __future__ import annotations

import collections
import hashlib
import re
import string

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def near_copies(rows):
    """{doc_id: (set size, component, kept)} of (doc_id, text) rows."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
        sets[doc_id] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids, index = sorted(sets), collections.defaultdict(list)
    for d in ids:
        shared = collections.Counter(other for shingle in sets[d] for other in index[shingle])
        for shingle in sets[d]:
            index[shingle].append(d)
        for other, n in shared.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[other]) - n):
                a, b = sorted((find(d), find(other)))
                parent[b] = a
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def passages(rows):
    """{doc_id: (words, removed, digest of kept words)}."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        hit = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                hit[i:i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, h in zip(words, hit, strict=True) if not h)
        out[doc_id] = (len(words), sum(hit), hashlib.sha256(kept.encode()).hexdigest())
    return out


def contamination(docs, items):
    """{doc_id: (words, hit words, items, digest of items, contaminated)}."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))

    windows = collections.defaultdict(set)
    for item_id, text in items:
        own = words(text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows[tuple(own[i:i + n])].add(str(item_id))
    sizes, out = {len(w) for w in windows}, {}
    for doc_id, text in docs:
        own, found = words(text), set()
        hit = [False] * len(own)
        for n in sizes:
            for i in range(len(own) - n + 1):
                if own_items := windows.get(tuple(own[i:i + n])):
                    found |= own_items
                    hit[i:i + n] = [True] * n
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(own), sum(hit), len(found), digest, any(hit))
    return out
