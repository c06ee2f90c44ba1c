"""Line copies, the manifest and conversation repair against plain Python."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import string

from pyspark.sql import functions as F

from tidehouse.llm import conversation_repair as repair, line_copies, manifest

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, _id long, _lines string, `a.b` string, n_lines long"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- lines

LINES = [
    (1, "A shared line here\nown one"), (2, "  a SHARED line here\t\nshort\nshort"), (3, "short\nshort\n"), (4, None), (5, ""),
    (6, "twice in one text\ntwice in one text\nA shared line here"), (7, "Zwölf Äpfel am Baum\nzwölf Äpfel am baum"),
    (8, "zwölf Äpfel am Baum\n"), (9, "\n\n\x0bA shared line here\r\n" + "word " * 30000), (10, "123456789\n1234567890"),
    (11, "123456789\n1234567890"), (None, "a row without a number\nA shared line here"), (None, "a row without a number"),
    (12, "the same row\ntwice"), (12, "the same row\ntwice"), (13, "the same row"), (14, "one number, two texts"),
    (14, "one number, two texts\nmore"),
    (15, "".join(f"line number {i}\n" for i in range(5000))), (16, "".join(f"line number {i}\n" for i in range(0, 5000, 2))),
]


def _lines_by_hand(rows, least_docs=2):
    last, holders = 1 << 63, collections.defaultdict(set)
    key = lambda line: line.strip(line_copies.WHITE).translate(_LOWER)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(last if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(key(x)) < 10 or len(holders[key(x)]) < least_docs
                or min(holders[key(x)]) == (last if doc_id is None else doc_id)]
        out.append((doc_id, len(own), len(own) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


def test_lines_equal_plain_python(spark):
    docs = spark.createDataFrame([(*r, "en", "s", 1, 2, "x", "y", 3) for r in LINES], CLASHING)
    for least in (2, 3):
        got = line_copies.without_shared_lines(docs, least_docs=least)
        assert collections.Counter(map(tuple, got.collect())) == _lines_by_hand(LINES, least)
    assert line_copies.without_shared_lines(docs.limit(0)).collect() == []


def test_a_line_that_a_third_of_the_rows_share_is_counted_before_the_shuffle(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the line that many have").otherwise(
        F.concat(F.lit("a line of its own "), F.col("id"))).alias("text"))
    got = line_copies.without_shared_lines(docs.repartition(4))
    assert got.agg(F.sum("n_dropped")).first()[0] == 999
    assert got.where("doc_id = 0").first().kept_text == "the line that many have"


# ---------------------------------------------------------------- manifest

def _tree(nodes):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def _proof(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 8 * 8
        out.append(("".join(level[first:at]), "".join(level[at + 1:first + 8])))
        at //= 8
    return out


def test_manifest_equals_plain_python(spark):
    sizes = {None: 9, "": 1, "a": 8, "b": 64, "ä": 65, "hot": 1200, **{f"g{i}": 2 for i in range(9)}}
    rows = [(g, i if i % 7 or g != "hot" else None, _sha(f"{g}{i % 1000}")) for g, n in sizes.items() for i in range(n)]
    rows += [("b", 3, _sha("b3"))] * 2  # repeated rows
    random.Random(5).shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "group string, id long, leaf string, _node string, root string")
    got = manifest.manifest(frame, carry=["root"]).drop("root").withColumn("ok", manifest.fold(F.col("leaf"), F.col("proof")))
    # the carried column is named like a result and would stand beside it
    assert manifest.manifest(frame, carry=["_node"]).columns == ["group", "id", "leaf", "subroot", "root", "proof", "_node"]
    groups = sorted({r[0] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in groups:
        own = sorted((r[1:] for r in rows if r[0] == g), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = own, _tree([r[1] for r in own])
    forest = _tree([trees[g][1][-1][0] for g in groups])
    want = collections.Counter()
    for k, g in enumerate(groups):
        own, levels = trees[g]
        for i, (number, leaf) in enumerate(own):
            want[g, number, leaf, levels[-1][0], tuple(_proof(levels, i) + _proof(forest, k)), forest[-1][0]] += 1
    have = collections.Counter((r[0], r.id, r.leaf, r.subroot, tuple(map(tuple, r.proof)), r.ok) for r in got.collect())
    assert have == want


def test_manifest_edges(spark):
    empty = spark.createDataFrame([], "group string, id long, leaf string")
    assert manifest.manifest(empty).collect() == []
    one = manifest.manifest(spark.createDataFrame([("g", 1, "ab")], "group string, id long, leaf string")).first()
    assert (one.subroot, one.root, one.proof) == ("ab", "ab", [])
    docs = spark.createDataFrame([(1, None, "en", None, 5, 0, "", "", 0), (None, "é", None, "s", None, 0, "", "", 0)], CLASHING)
    leaves = {r.doc_id: r for r in manifest.document_leaves(docs, text=F.lower("text")).collect()}
    assert leaves[1].leaf == leaves[1].claimed == _sha("1:1-2:en1:5-")
    assert leaves[None].leaf == _sha("-1:s--2:é")


# ---------------------------------------------------------------- conversations

def _audit_by_hand(symbols):
    """Cheapest audit by trying every edit, row by row."""
    after = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best = {0: (0, "")}

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for state, (cost, audit) in list(out.items()):
                to = 3 if state == 2 else 2
                out[to] = min(out.get(to, (1 << 30, "")), (cost + 5, audit + "I"))
        return out

    for symbol in symbols:
        new = {}
        for state, (cost, audit) in inserted(best).items():
            more = 5 if symbol.isupper() else 0
            options = [(state, cost + 2, audit + "D")]
            if symbol != "x":
                options.append((3 if state == 2 else 2, cost + 1 + more, audit + "R"))
                if (symbol.lower(), state) in after:
                    options.append((after[symbol.lower(), state], cost + more, audit + "K"))
            for to, *value in options:
                new[to] = min(new.get(to, (1 << 30, "")), tuple(value))
        best = new
    ends = inserted(best)
    return min(ends[s] for s in (0, 3) if s in ends)


def test_transfer_matrices_and_grammar():
    chance = random.Random(3)
    texts = ["".join(chance.choices("suaoSUAOx", (2, 8, 8, 1, 1, 2, 2, 1, 2), k=chance.randint(1, 40))) for _ in range(300)]
    texts += ["u" * 33, "ua" * 50, "x" * 20, "s", "ss"]
    compressed, rules = repair.re_pair(texts)

    def expand(symbol):
        return symbol if isinstance(symbol, str) else "".join(map(expand, rules[symbol]))

    assert ["".join(map(expand, own)) for own in compressed] == texts
    pairs = collections.Counter(p for own in compressed for p in set(zip(own, own[1:], strict=False)))
    assert max(pairs.values()) == 1 and sum(map(len, compressed)) < sum(map(len, texts)) / 2
    for text, matrix in zip(texts, repair.matrices(texts), strict=True):
        ends = [(matrix[0][j][0] + 5 * n, str(matrix[0][j][1]) + "I" * n) for j, n in enumerate(repair.FINISH) if matrix[0][j]]
        assert min(ends) == _audit_by_hand(text)


def _conversation(rows):
    """Facts, audit and repaired rows of one conversation's rows in order."""
    seen, symbols, counts = set(), "", collections.Counter()
    for role, text in rows:
        bare = text.strip(line_copies.WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    cost, audit = _audit_by_hand(symbols)
    out, at, left = [], 0, iter(rows)
    for edit in audit:
        role, text = next(left) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit == "K" and role[:1] == "s":
            out.append((role, text))
            continue
        out.append((role if edit == "K" else ("user", "assistant")[at % 2], text))
        at += 1
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, out


def test_repair_equals_plain_python(spark):
    chance = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", None]
    rows = []
    for conv in [None, *range(40)]:
        for turn in sorted(chance.sample(range(60), chance.randint(1, 30))):
            rows.append((conv, turn if chance.random() > 0.03 else None, chance.choices(roles, (8, 8, 3, 1, 1, 1))[0],
                         chance.choice(["Yes.", "No", " \t", None, f"text {turn}.", f"text {turn}", "Été\n?"])))
    rows += [(99, t, ("user", "assistant")[t % 2], f"row {t}" + "." * (t % 11 != 0)) for t in range(2000)]  # a hot conversation
    rows += [(98, 1, "user", "Twice.")] * 3 + [(98, 1, "assistant", "w" * 50000 + ".")]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, cost long, `a.b` string")
    grouped = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    want = {conv: _conversation([r[2:] for r in sorted(own)]) for conv, own in grouped.items()}
    for bits in (2, repair.PIECE_BITS):
        fixed = repair.repair(frame.repartition(5), bits)
        summary = {r.conv_id: r for r in fixed.summary.collect()}
        out = collections.defaultdict(list)
        for r in sorted(fixed.rows.collect(), key=lambda r: (r.place, r.sub)):
            out[r.conv_id].append((r.role, r.text))
        digests = {r.conv_id: r.repaired_sha256 for r in repair.row_digests(fixed.rows).collect()}
        assert set(summary) == set(want)
        for conv, expected in want.items():
            r = summary[conv]
            assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, out[conv]) == expected, conv
            turns = {t for known, t, _, _ in grouped[conv] if known}
            assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
            assert digests.get(conv, _sha("")) == _sha("\n".join(f"{a}:{b}" for a, b in expected[-1]))


def test_repair_of_nothing(spark):
    fixed = repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert fixed.summary.collect() == [] and fixed.rows.collect() == [] and repair.row_digests(fixed.rows).collect() == []
