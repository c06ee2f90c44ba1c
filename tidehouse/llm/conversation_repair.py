"""Cheapest repair of conversations to the role sequence ``(s?(ua)+)?``, with an audit of the edits.

A row's fault is its first of: blank (nothing but ASCII white space), duplicate (its role and text stand earlier in the
conversation), truncated (its last character that is no white space is none of ``.!?``). Edits: Keep costs nothing,
Rerole to user or assistant 1, Delete 2 (and a must for blank and duplicate rows), Insert of an empty user or assistant row
5; a truncated row that is not deleted adds 5. The audit is the edits' initials in order; of equally cheap ones the least
in ASCII. An audit fixes the repaired roles.

Rows become symbols (role and fault). Rows are sorted by ranges and written, so a conversation is cut into pieces of at
most 512 rows, whatever its length. Distinct pieces are compressed by Re-Pair: the commonest pair of symbols becomes a rule
until no pair is left twice. Every symbol has a 4 x 4 transfer matrix over what the output ends with (nothing, s, u, a): the
least cost and the audit that goes with it; a rule's matrix is the min-plus product of its two, so it is evaluated once
for all conversations of a block of pieces. Audits are ropes that are flattened only to break ties and at the end.

A conversation then needs its pieces' costs alone (16 numbers for 512 rows): backwards for the cost to go, forwards for the
states, where a tie is broken by the rank of the pieces' audits. Inserts belong to the row after them, so no audit of a
piece is the beginning of another, and ranks within a piece decide. The chosen audits and the repaired rows are made per
piece.

Defined results: nulls count as one space, a null turn comes first; rows of one turn are ordered by role, then text; other
columns are left out; repeated rows are duplicates; roles count by their first letter; an empty table gives no rows.
Texts are compared by 128-bit hashes.
"""

from __future__ import annotations

import collections
import hashlib
import heapq
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidehouse import session, sized
from tidehouse.llm import arrow
from tidehouse.llm.line_copies import WHITE

#: Binary logarithm of the rows of a piece.
PIECE_BITS = 9
#: Symbols of distinct pieces that share one grammar.
GRAMMAR_SYMBOLS = 200_000

#: Costs of the edits (fixed values).
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What the output ends with: nothing, s, u, a. Inserts that turn one state into another, and that finish from each.
STATES = 4
_INSERTS = {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1} | {(s, s): 0 for s in range(STATES)}
FINISH = (0, 2, 1, 0)
#: States that a role may follow, and the state after it.
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # the only user or assistant row that may come
_ROLE = {2: "user", 3: "assistant"}


class Rope:
    """A text put together of two, written out only when it is asked for."""

    __slots__ = ("_parts", "_text")

    def __init__(self, text: str | None = None, *parts: Rope):
        self._text, self._parts = text, parts

    def __str__(self) -> str:
        if self._text is None:
            out, stack = [], [self]
            while stack:
                rope = stack.pop()
                if rope._text is None:
                    stack.extend(reversed(rope._parts))
                else:
                    out.append(rope._text)
            self._text, self._parts = "".join(out), ()
        return self._text


def _least(a, b):
    """The better of two (cost, audit); of equal costs the audit that comes first."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if str(a[1]) <= str(b[1]) else b


def symbol_matrix(symbol: str) -> list[list]:
    """Cost and audit between any two states for one row with the inserts before it; ``x`` must go, capitals are truncated."""
    rows = [[None] * STATES for _ in range(STATES)]
    more = TRUNCATED if symbol.isupper() else 0
    for (start, middle), inserts in _INSERTS.items():
        edits = [("D", DELETE, middle)]
        if symbol != "x":
            if middle in _AFTER[symbol.lower()]:
                edits.append(("K", more, _AFTER[symbol.lower()][middle]))
            edits.append(("R", REROLE + more, _NEXT[middle]))
        for letter, cost, end in edits:
            rows[start][end] = _least(rows[start][end], (cost + INSERT * inserts, Rope("I" * inserts + letter)))
    return rows


def product(a: list[list], b: list[list]) -> list[list]:
    """The min-plus product of two transfer matrices."""
    out = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        for j in range(STATES):
            best = None
            for k in range(STATES):
                if a[i][k] and b[k][j]:
                    best = _least(best, (a[i][k][0] + b[k][j][0], Rope(None, a[i][k][1], b[k][j][1])))
            out[i][j] = best
    return out


def re_pair(sequences: list[str]) -> tuple[list[list], dict[int, tuple]]:
    """Sequences over symbols and rules, and the rules (number to its two symbols), lower rules first.

    The commonest pair is replaced everywhere until no pair is left twice; work grows with the symbols, not with the rules.
    """
    symbols: list = []
    for text in sequences:
        symbols.extend(text)
        symbols.append(None)  # no pair reaches across
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple, set[int]] = collections.defaultdict(set)

    def pair(at: int):
        if at < 0 or symbols[at] is None or after[at] >= n or symbols[after[at]] is None:
            return None
        return symbols[at], symbols[after[at]]

    for at in range(n):
        if two := pair(at):
            places[two].add(at)
    heap = [(-len(spots), str(two), two) for two, spots in places.items()]
    heapq.heapify(heap)
    rules: dict[int, tuple] = {}
    while heap:
        count, _, two = heapq.heappop(heap)
        spots = places[two]
        if len(spots) < 2:
            continue
        if len(spots) < -count:  # fewer than when it was noted
            heapq.heappush(heap, (-len(spots), str(two), two))
            continue
        rule, touched = len(rules), set()
        for at in sorted(spots):
            if pair(at) != two:  # the second of two overlapping places
                continue
            left, gone = before[at], after[at]
            for spot in (left, at, gone):
                if old := pair(spot):
                    places[old].discard(spot)
            symbols[at], symbols[gone] = rule, None
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            for spot in (left, at):
                if new := pair(spot):
                    places[new].add(spot)
                    touched.add(new)
        rules[rule] = two
        spots.clear()
        for new in touched:
            if new != two and len(places[new]) > 1:
                heapq.heappush(heap, (-len(places[new]), str(new), new))
    out, at = [], 0
    for text in sequences:
        own, spot, end = [], at, at + len(text)
        while spot < end:
            own.append(symbols[spot])
            spot = after[spot]
        out.append(own)
        at = end + 1
    return out, rules


def matrices(sequences: list[str]) -> list[list[list]]:
    """The transfer matrix of every sequence; a rule's is made once for all of them."""
    compressed, rules = re_pair(sequences)
    made: dict = {symbol: symbol_matrix(symbol) for symbol in set("".join(sequences))}
    for rule, (left, right) in rules.items():
        made[rule] = product(made[left], made[right])
    out = []
    for own in compressed:
        whole = made[own[0]]
        for symbol in own[1:]:
            whole = product(whole, made[symbol])
        out.append(whole)
    return out


_CELLS = "seq string, costs array<long>, ranks array<int>, audits array<string>"
_CELLS_ARROW = pa.schema([("seq", pa.string()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())),
                          ("audits", pa.list_(pa.string()))])


def _matrices(batches):
    def rows(sequences: list[str]):
        costs, ranks, audits = [], [], []
        for matrix in matrices(sequences):
            cells = [cell for row in matrix for cell in row]
            texts = [None if cell is None else str(cell[1]) for cell in cells]
            order = {text: k for k, text in enumerate(sorted(t for t in texts if t is not None))}
            costs.append([None if cell is None else cell[0] for cell in cells])
            ranks.append([None if text is None else order[text] for text in texts])
            audits.append(texts)
        return arrow.batch(_CELLS_ARROW, sequences, costs, ranks, audits)

    held, size = [], 0
    for part in batches:
        for text in part.column("seq").to_pylist():
            held.append(text)
            size += len(text)
            if size >= GRAMMAR_SYMBOLS:
                yield rows(held)
                held, size = [], 0
    if held:
        yield rows(held)


def _path(pieces: list[dict]) -> tuple[int, list[int]]:
    """Least cost of a conversation, and the state at the start of every piece and at the end."""
    to_go = [tuple(INSERT * n for n in FINISH)]
    for piece in reversed(pieces):
        costs, later = piece["costs"], to_go[-1]
        to_go.append(tuple(min(c + later[j] for j, c in enumerate(costs[i * STATES:(i + 1) * STATES]) if c is not None)
                           for i in range(STATES)))
    to_go.reverse()
    states = [0]
    for piece, now, later in zip(pieces, to_go, to_go[1:], strict=False):
        i = states[-1]
        cells = range(i * STATES, (i + 1) * STATES)
        best = [c for c in cells if piece["costs"][c] is not None and piece["costs"][c] + later[c % STATES] == now[i]]
        states.append(min(best, key=piece["ranks"].__getitem__) % STATES)
    return to_go[0][0], states


_PATHS = "_conv string, cost long, illegal long, _start long, _from int, _to int, _last boolean"
_PATHS_ARROW = pa.schema([("_conv", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("_start", pa.int64()),
                          ("_from", pa.int32()), ("_to", pa.int32()), ("_last", pa.bool_())])


def _paths(batches):
    """Of conversations with their pieces in order: cost, neighbours that may not meet, and the states of every piece."""
    for part in batches:
        out = []
        for conv, pieces in zip(part.column("_conv").to_pylist(), part.column("pieces").to_pylist(), strict=True):
            cost, states = _path(pieces)
            borders = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(pieces, pieces[1:], strict=False))
            illegal = borders + sum(piece["illegal"] for piece in pieces)
            for k, piece in enumerate(pieces):
                out.append((conv, cost, illegal, piece["_start"], states[k], states[k + 1], k + 1 == len(pieces)))
        if out:
            yield arrow.batch(_PATHS_ARROW, *zip(*out, strict=True))


#: Neighbours that may meet (fixed values).
LEGAL = ("su", "ua", "au")

_EDITS = "_conv string, _at long, _sub int, _edit string, _role string"
_EDITS_ARROW = pa.schema([("_conv", pa.string()), ("_at", pa.int64()), ("_sub", pa.int32()), ("_edit", pa.string()),
                          ("_role", pa.string())])


def _edits(batches):
    """The rows that come out of every piece: from which row, by which edit, with which new role."""
    names = ("_conv", "_start", "_from", "seq", "audit")
    for part in batches:
        out = []
        for conv, at, state, seq, audit in zip(*(part.column(n).to_pylist() for n in names), strict=True):
            place, sub, last = at, 0, at + len(seq) - 1
            for letter in audit:
                if letter != "D":
                    state = 1 if letter == "K" and seq[place - at] in "sS" else _NEXT[state]
                    out.append((conv, min(place, last), sub, letter, None if letter == "K" else _ROLE[state]))
                    sub += 1
                place += letter != "I"
                sub = sub if letter == "I" or place > last else 0
        if out:
            yield arrow.batch(_EDITS_ARROW, *zip(*out, strict=True))


def _ordered(rows: DataFrame) -> DataFrame:
    """All rows with a number in the order of conversation, turn, role and text; written, so that numbers stay."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    plain = rows.select(spaced("conv_id").alias("_conv"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"),
                        spaced("text").alias("text"))
    order = ["_conv", F.col("turn").asc_nulls_first(), "role"]
    placed = plain.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return _written(placed.withColumn("_at", F.monotonically_increasing_id()), "rows")


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    path = session.shared_dir(rows.sparkSession, f"repair-{purpose}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _judged(ordered: DataFrame) -> DataFrame:
    """``_conv, _at, turn, _initial, fault`` of every row."""
    text = F.col("text")
    facts = ordered.select(
        "_conv", "_at", "turn", "role", F.xxhash64("text").alias("_t1"), F.xxhash64(F.lit(1), "text").alias("_t2"),
        (F.btrim(text, F.lit(WHITE)) == "").alias("_blank"),
        (~F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1)).isin(".", "!", "?")).alias("_cut"))
    keys = ["_conv", "role", "_t1", "_t2"]
    first = facts.groupBy(*keys).agg(F.min("_at").alias("_first"))
    met = facts.join(sized.splittable(first, *keys), keys)
    fault = F.when(F.col("_blank"), "blank").when(F.col("_at") != F.col("_first"), "duplicate").when(F.col("_cut"), "truncated")
    return met.select("_conv", "_at", "turn", F.left("role", F.lit(1)).alias("_initial"), fault.alias("fault"))


def _pieces(judged: DataFrame, piece_bits: int) -> DataFrame:
    """Runs of rows of one conversation, with their symbols."""
    known = F.when(F.col("_initial").isin("s", "u", "a"), F.col("_initial")).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    row = F.struct("_at", symbol.alias("symbol"), known.alias("role"))
    grouped = judged.groupBy("_conv", F.shiftright("_at", piece_bits).alias("_piece")).agg(
        F.min("_at").alias("_start"), F.sort_array(F.collect_list(row)).alias("_rows"))
    roles = grouped.select("_conv", "_start", F.array_join(F.transform("_rows", lambda r: r["symbol"]), "").alias("seq"),
                           F.transform("_rows", lambda r: r["role"]).alias("_roles"))
    met = F.filter("_roles", lambda role, i: (i > 0) & ~F.concat(F.get("_roles", i - 1), role).isin(*LEGAL))
    return roles.select("_conv", "_start", "seq", F.size(met).cast("long").alias("illegal"),
                        F.element_at("_roles", 1).alias("first"), F.element_at("_roles", -1).alias("last"))


class Repaired(NamedTuple):
    """``summary``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation with rows;
    ``rows``: ``conv_id, place, sub, role, text``, a conversation's repaired rows in the order of place and sub."""

    summary: DataFrame
    rows: DataFrame


def _conv_id() -> Column:
    return F.expr("cast(nullif(_conv, ' ') as long)").alias("conv_id")


def repair(rows: DataFrame, piece_bits: int = PIECE_BITS) -> Repaired:
    """Repair ``conv_id, turn, role, text`` rows; written tables hold the order and the pieces."""
    ordered = _ordered(rows)
    judged = _written(_judged(ordered), "faults")
    pieces = _pieces(judged, piece_bits)
    cells = pieces.select("seq").distinct().mapInArrow(_matrices, _CELLS)
    measured = _written(pieces.join(sized.splittable(cells, "seq"), "seq"), "pieces")
    costs = F.struct("_start", "costs", "ranks", "illegal", "first", "last")
    paths = measured.groupBy("_conv").agg(F.sort_array(F.collect_list(costs)).alias("pieces")).mapInArrow(_paths, _PATHS)
    finish = F.expr(f"case when _last then repeat('I', array({', '.join(map(str, FINISH))})[_to]) else '' end")
    own = F.concat(F.get("audits", F.col("_from") * STATES + F.col("_to")), finish)
    chosen = _written(paths.join(measured.drop("_conv", "illegal"), "_start").select(
        "_conv", "_start", "_from", "seq", "cost", F.col("illegal"), own.alias("audit")), "paths")

    part = F.struct("_start", "audit")
    audits = chosen.groupBy("_conv").agg(
        F.max("cost").alias("cost"), F.max("illegal").alias("illegal"),
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["audit"]), "").alias("audit"))
    faults = ("blank", "duplicate", "truncated")
    turns = judged.groupBy("_conv", "turn").agg(*(F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in faults))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    counts = turns.groupBy("_conv").agg(gaps.alias("gaps"), *(F.sum(f).alias(f) for f in faults))
    summary = counts.join(audits, "_conv").select(_conv_id(), "gaps", *faults, "illegal", "cost", "audit")

    edits = chosen.mapInArrow(_edits, _EDITS)
    text = F.when(F.col("_edit") == "I", "").otherwise(F.col("text")).alias("text")
    out = edits.join(ordered.select("_at", "role", "text"), "_at").select(
        _conv_id(), F.col("_at").alias("place"), F.col("_sub").alias("sub"), F.coalesce("_role", "role").alias("role"), text)
    return Repaired(summary, out)


_DIGESTS = "conv_id long, repaired_sha256 string"
_DIGESTS_ARROW = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _digests(batches: Iterable[pa.RecordBatch]):
    done, now, running = [], None, None
    for part in batches:
        for conv, role, text in zip(*(part.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
            if running is None or conv != now:
                if running is not None:
                    done.append((now, running.hexdigest()))
                now, running = conv, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode())
        if len(done) >= 4096:
            yield arrow.batch(_DIGESTS_ARROW, *zip(*done, strict=True))
            done = []
    if running is not None:
        yield arrow.batch(_DIGESTS_ARROW, *zip(*[*done, (now, running.hexdigest())], strict=True))


def row_digests(rows: DataFrame) -> DataFrame:
    """sha256 of every conversation's ``role:text`` lines; rows pass in order, so memory does not grow with a conversation."""
    order = [F.col("conv_id").asc_nulls_first(), "place", "sub"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_digests, _DIGESTS)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that the remainder of crc32(``conv_id:turn``) by 20 asks for; nulls become one space there."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    copies = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
                       F.explode(copies).alias("_copy")).drop("_copy")
