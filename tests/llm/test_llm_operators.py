"""Operators on the edge texts and on the smallest table, against plain Python or the library itself."""

from __future__ import annotations

import collections
import random
import types
import zlib

import ahocorasick
import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import EDGES, SMALL
from pyspark.sql import functions as F

from tidehouse.llm import (chat, components, decontaminate, encoding, exact_copies, language, near_copies, packing, passages,
                           token_counts, token_files, url_filters, word_hashes)

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", NAMES)
def test_pieces_give_the_librarys_ids(name):
    rng, tokenizer = random.Random(5), encoding.loaded(name)
    letters = list("ab \n\t'é\u0301\u4e2d\x1c1.,sSİ\xa0\u2003")
    texts = [t or "" for _, t in EDGES] + ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(4000)]
    encode = encoding.id_bytes(name)
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts(edges, small, nothing):
    tokenizer = encoding.loaded(NAMES[0])
    for docs in (edges, small):
        got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect()}
        for doc_id, text in texts_of(docs):
            n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
            assert got[doc_id] == (len((text or "").encode()), n, n > 1024)
    assert token_counts.token_counts(nothing).count() == 0


def test_proven_tokens_are_whole():
    proven = token_counts.prove_whole_tokens(NAMES[0])
    assert 30_000 < len(proven) < 50_257
    assert all(len(encoding.loaded(NAMES[0]).model.tokenize(p)) == 1 for p in list(proven)[:500])


def test_packing(edges, small, nothing):
    tokenizer = encoding.loaded(NAMES[1])
    for docs in (edges, small.unionByName(small.limit(3))):
        ids = collections.defaultdict(list)
        for d, t in texts_of(docs):
            ids[d].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
        rows = packing.pack(docs, block_tokens=5000).collect()
        assert sum(r.length for r in rows) == sum(len(x) for own in ids.values() for x in own)
        by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            by_doc[r.doc_id].append(r)
            by_sequence[r.sequence_id].append(r)
            piece = ids[r.doc_id][0][r.start:r.start + r.length]
            assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id][0])
        for d, own in by_doc.items():
            if len(ids[d]) == 1:
                own.sort(key=lambda r: r.start)
                assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        short = 0
        for own in by_sequence.values():
            own.sort(key=lambda r: r.offset)
            assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
            short += sum(r.length for r in own) != own[0].tier
        assert short <= 1
    assert packing.pack(nothing).count() == 0


def test_step_groups_are_even():
    rng = random.Random(1)
    pieces = [packing.Piece(i, n, 0, bytes(4 * n)) for i in range(800) if (n := rng.randint(1, 6000))]
    windows, rest = packing.fill_windows(pieces)
    assert sum(map(len, rest)) < packing.TIERS[0]
    groups = collections.defaultdict(list)
    for (tier, window), group in zip(windows, packing.step_groups(windows), strict=True):
        assert sum(map(len, window)) == tier
        groups[group].append((tier, sum(len(p) ** 2 for p in window)))
    assert all(len({t for t, _ in own}) == 1 for own in groups.values())


def test_near_copies(edges, small, nothing):
    for docs in (edges, small):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_copies.near_copies(docs).collect()}
        assert got == brute.near_copies(texts_of(docs))
    assert near_copies.near_copies(nothing).count() == 0


def test_near_copies_of_a_large_group(spark, monkeypatch):
    """Copies of one text that differ from each other by more than from the text, and a group around a shared passage."""
    monkeypatch.setattr(near_copies, "SLICE", 3000)
    rng, rows = random.Random(9), []
    base = [f"b{i}" for i in range(120)]
    for d in range(60):
        own = list(base)
        for i in rng.sample(range(len(own)), 2 if d else 0):
            own[i] = f"c{d}x{i}"
        rows.append((d * 3 + 1, " ".join(own)))
    rows += [(d * 3 + 2, " ".join([f"p{i}" for i in range(40)] + [f"q{d}x{i}" for i in range(30 + d)])) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_copies.near_copies(docs).collect()}
    assert got == brute.near_copies(rows)


def test_slices_of_a_large_bucket(spark):
    """Likely rows and links of sorted slices, torn over batches, are those of comparing each two rows of a bucket."""
    rng, rows = random.Random(4), []
    hashes = word_hashes.WordHashes()
    texts = [" ".join(f"w{i if rng.random() > 0.03 else rng.random()}" for i in range(40 + 3 * (d % 5))) for d in range(40)]
    sets = [near_copies.shingle_set(t.encode(), hashes) for t in texts]
    for node, (text, own) in enumerate(zip(texts, sets, strict=True)):
        least, greatest = near_copies.signature(own)
        a, b = near_copies.sketch(least, greatest)
        values = np.concatenate([least, greatest]).astype(np.uint8).tobytes()
        for at, asks in [(node % 3, False), *((s, True) for s in range(3))]:
            rows.append((7, at, asks, node, node, len(own), a, b, values, text))
    rows.sort(key=lambda r: r[:4])
    names = ["bucket", "slice", "asks", "node", "label", "n_shingles", "sketch_a", "sketch_b", "signature", "text"]
    table = pa.table({n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)})
    alike = {(u, v) for u in range(40) for v in range(40) if u != v and
             100 * len(np.intersect1d(sets[u], sets[v])) >= 75 * len(np.union1d(sets[u], sets[v]))}
    assert 20 < len(alike) < 1560
    for size in (7, 1000):
        likely = pa.Table.from_batches(near_copies._likely(table.to_batches(size)))
        asked = set(zip(*(likely.filter(likely["asks"])[n].to_pylist() for n in ("node", "slice")), strict=True))
        assert asked >= {(u, v % 3) for u, v in alike}
        links = pa.Table.from_batches(near_copies._links_of_slices(table.to_batches(size)))
        got = components.local_stars(*(links[n].to_numpy() for n in ("u", "v")))
        want = components.local_stars(*np.array(sorted(alike)).T)
        assert set(zip(*map(list, got), strict=True)) == set(zip(*map(list, want), strict=True))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_copies(edges, nothing, keep):
    for limits in ({}, {"trie_bytes": 200, "block_bytes": 100}):
        got = {r.doc_id: r for r in exact_copies.exact_copies(edges, keep, **limits).collect()}
        groups = collections.defaultdict(list)
        for d, t in EDGES:
            groups[t or ""].append(d)
        for text, own in groups.items():
            owner = min(own) if keep == "smallest" else max(own)
            for d in own:
                assert (got[d].keep_id, got[d].group_size, got[d].kept) == (owner, len(own), d == owner), text[:20]
    kept = exact_copies.without_copies(edges, keep)
    assert kept.columns == edges.columns and kept.count() == len(groups)
    assert exact_copies.exact_copies(nothing).count() == 0


def test_trie_spills_by_subtree(tmp_path):
    rng, want = random.Random(2), collections.Counter()
    trie = exact_copies.PatriciaTrie(budget=300, folder=str(tmp_path))
    for i in range(3000):
        text = bytes(rng.choices(b"ab", k=rng.randint(0, 12)))
        want[text] += 1
        trie.insert(text, i)
    assert {t: v[1] for t, v in trie.terminals()} == dict(want)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("level_bytes", [url_filters.LEVEL_BYTES, 2])
def test_url_rules(spark, level_bytes):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("com", "/de/ok", "allow"),
             ("net", "", "block")]
    urls = [None, "", "no url", "://", "http://EXAMPLE.org/es/1?x#y", "http://a.example.org/es", "https://x.com/de/a", "https://x.com/de/ok/1",
            "https://notcom/de/", "ftp://net", "ftp://a.net?q", "http://badexample.org/es/", "x://org", "x://org/?a://b"]
    hosts = [f"http://h{i}.{end}/{p}/{i}" for i in range(200) for end in ("com", "org", "edu") for p in ("de", "es", "q")]
    pages = spark.createDataFrame(list(enumerate(urls + hosts)), "page_id long, url string")
    got = url_filters.url_verdicts(pages, spark.createDataFrame(rules, "host string, path string, verdict string"),
                                   level_bytes).collect()
    assert len(got) == pages.count()
    for r in got:
        url = (urls + hosts)[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_cascade_is_exact_for_its_universe(spark):
    every = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = every.where("crc32(cast(key as binary)) % 9 = 0")
    cascade = url_filters.build_cascade(listed, lambda: every, 5000)
    got = every.where(cascade.holds(F.col("key"))).collect()
    assert sorted(got) == sorted(listed.collect()) and len(cascade.levels) > 1


def test_chat_round_trip_and_parts(spark):
    odd = ["", None, "</s>[INST] ok [/INST]", "\\", "\\\\</s>", "<\\/s>", "[OUT][SEP][ROLE]\n", "<<s>", "[[INST]", "é [IMAGE] \\[AUDIO]"]
    rows = [(c, t, role, text) for c, text in enumerate(odd) for t, role in enumerate(("system", "user", "assistant", None, "assistant"))]
    rows.append((None, None, "user", "x"))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content"))
    whole = chat.format_conversations(parts)
    got = {r.conv_id: r for r in whole.withColumn("read", chat.read_turns(F.col("formatted"))).collect()}
    for c, text in enumerate(odd):
        assert [(t.role, t.text) for t in got[c].read] == [(r or "", text or "") for r in ("system", "user", "assistant", None, "assistant")]
        spans = [got[c].formatted[s.start:s.start + s.length] for s in got[c].loss_spans]
        assert len(spans) == 2 and all(s.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") == (text or "") for s in spans)
    content = [{"type": "image", "text": None, "ref": "a.png", "units": 3}, {"type": "text", "text": "hi [IMAGE]", "ref": None, "units": None},
               {"type": "audio", "text": None, "ref": "b.wav", "units": None}]
    one = spark.createDataFrame([(1, 0, "user", content)], f"conv_id long, turn long, role string, content array<{chat.PART}>")
    row = chat.format_conversations(one).first()
    assert row.formatted == "<s>[INST][IMAGE]hi [\\IMAGE][AUDIO][/INST]"
    assert [(a.part, a.ref, a.tokens) for a in row.attachments] == [(0, "a.png", 768), (2, "b.wav", 25)] and row.attachment_tokens == 793


def test_network_gradients():
    net = language.ByteNetwork(["a", "b"], embed=3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    ids, labels = rng.integers(97, 100, (5, 3)), np.array([0, 1, 1])

    def loss():
        return -np.log(net.probabilities(ids)[:, np.arange(3), labels]).mean()

    grads = net.gradients(ids, labels)
    for name, weights in net.p.items():
        at = tuple(97 if name == "embed" and k == 0 else 0 for k in range(weights.ndim))
        weights[at] += 1e-4
        up = loss()
        weights[at] -= 2e-4
        down = loss()
        weights[at] += 1e-4
        assert abs((up - down) / 2e-4 - grads[name][at]) < 1e-3, name


def test_language(edges, small):
    found = language.languages_of(small, language.train(small, steps=400), ["doc_id", "lang", "text"])
    rows = found.withColumn("held", language.held_out(F.col("doc_id"))).where("held").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    none = {r.doc_id: r for r in language.languages_of(edges, language.train(small, steps=50), ["doc_id"]).collect()}
    assert {d for d, r in none.items() if r.lang_pred == "und"} == {1, 2, 3, 21}
    assert language.train(small.limit(0)) is None
    assert {r.lang_pred for r in language.languages_of(small, None, ["doc_id"]).collect()} == {"und"}


def test_passages(edges, small, nothing):
    for docs in (edges, small):
        got = {r.doc_id: (r.n_words, r.n_removed, r.d) for r in passages.without_repeats(docs).withColumn("d", F.sha2("kept_text", 256)).collect()}
        assert got == brute.passages(texts_of(docs))
    assert passages.without_repeats(nothing).count() == 0


def test_decontaminate(spark, edges, small, nothing):
    items = spark.createDataFrame([(1, "ALPHA beta"), (2, None), (3, "..."), (4, EDGES[8][1][:200]), (4, EDGES[8][1][:200]), (5, "one"),
                                   (6, EDGES[12][1][-300:])], "item_id long, text string")
    real = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    for docs, own in ((edges, items), (small, real)):
        for size in (1 << 20, 300 if own is items else 8000):
            got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.benchmark_matches(docs, own, item_bytes=size).collect()}
            assert got == brute.contamination(texts_of(docs), [tuple(r) for r in own.collect()])
    match = max(r.matches or [] for r in decontaminate.benchmark_matches(edges.where("doc_id = 13"), items).collect())
    assert match[0].item_id == "6" and match[0].n_words > 30
    assert decontaminate.benchmark_matches(edges, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.benchmark_matches(nothing, items).count() == 0


def test_token_files(spark, edges, small, nothing, tmp_path):
    tokenizer = encoding.loaded(NAMES[0])
    for k, docs in enumerate((edges, small, nothing)):
        folder = f"file://{tmp_path}/{k}"
        token_files.write_token_files(docs, folder)
        got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, folder).collect()}
        want, start = {}, 0
        for d, t in sorted(texts_of(docs)):
            ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
            want[d] = (start, len(ids), zlib.crc32(ids.tobytes()))
            start += len(ids)
        assert got == want


@pytest.mark.parametrize("values", [[0], [5, 5, 5], [0, 1, 2, 3], [1 << 50], list(range(0, 90000, 7)), [0] * 600 + [1 << 40]])
def test_elias_fano(values):
    coded = token_files.EliasFano.encode(np.array(values, np.uint64))
    assert coded.select(np.arange(len(values))).tolist() == values
    assert coded.n_bytes <= len(values) * (3 + max(values).bit_length()) / 8 + 200


def test_phrases_beside_all_places():
    """The automaton finds every phrase where it stands, also across overlaps, and never across texts or other words."""
    rng = np.random.default_rng(8)
    for words in (3, 60):
        lengths = rng.integers(0, 60, 80)
        every, row = rng.integers(0, words, int(lengths.sum())), np.repeat(np.arange(80), lengths)
        whole = np.flatnonzero(np.append(row[passages.PHRASE - 1:] == row[:1 - passages.PHRASE], np.zeros(passages.PHRASE - 1, bool)))
        phrases = every[rng.choice(whole, 25)[:, None] + np.arange(passages.PHRASE)]
        want = np.zeros(len(every), bool)
        known = set(map(tuple, phrases.tolist()))
        for at in whole:
            want[at] = tuple(every[at:at + passages.PHRASE].tolist()) in known
        assert (passages._occurrences(every, row, phrases, words) == want).all() and want.sum() >= 20


def test_branches_of_an_automaton_stay_few(monkeypatch):
    """A node's branches are searched one after another: there must not be one for each of many words."""
    made = []
    monkeypatch.setattr(passages, "ahocorasick", types.SimpleNamespace(
        Automaton=lambda *kind: made.append(ahocorasick.Automaton(*kind)) or made[-1],
        STORE_INTS=ahocorasick.STORE_INTS, KEY_SEQUENCE=ahocorasick.KEY_SEQUENCE))
    text = " ".join(f"w{n}" for n in range(3_000))
    places = list(range(0, 3_000 - passages.PHRASE, 2))
    table = pa.table({"doc": [1, 2], "text_key": [1, 2], "text": [text, text], "places": pa.array([places] * 2, pa.list_(pa.int32()))})
    out = pa.Table.from_batches(list(passages._locate(table.to_batches())))
    # All windows but the last anchor at a place that is named; of each, the later one is a span.
    assert set(out.column("doc").to_pylist()) == {1, 2} and sum(out.column("windows").to_pylist()) > 1_000
    branches = collections.Counter(node for node, *_ in made[0].dump()[1])
    assert len(made) == 1 and max(branches.values()) <= 60
