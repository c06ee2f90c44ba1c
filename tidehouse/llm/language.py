"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads stretches of a text, white space included (ASCII letters lower-cased): ``SPAN`` bytes each, overlapping
by twice ``CONTEXT``, so that every byte is read with at least ``CONTEXT`` bytes of its text on both sides, where there are
so many. At every byte it gives probabilities of the languages; a document's are the mean over all its positions. Whole
texts are read, every byte counts once, and stretches of one length go through the network together.

Training is numpy backpropagation through time on a bounded sample of labelled rows: at most ``DOCS`` documents of a
language, chosen by a hash of their identifier, and of the distinct windows of ``LEARNED`` bytes that they are cut into
at most ``WINDOWS`` with their counts. The sample reaches the driver; nothing else does. The model is a few kilobytes.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing
to learn from (an empty table, or no labels); of languages with equal probabilities the first by name counts; equal texts
get equal results, up to rounding (scores are rounded to six digits); rows without an identifier are predicted but not
learned from, repeated rows are each predicted; a text of any length is read in stretches; columns that are not asked
for are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidehouse import sized
from tidehouse.llm import arrow

#: Labelled documents and distinct windows of a language that are learned from, at most.
DOCS, WINDOWS = 400, 20_000
#: Bytes of a window to learn from, and of a stretch to predict from; bytes of either side that only give context.
LEARNED, SPAN, CONTEXT = 64, 256, 16
#: Shorter texts and windows are filled up with blanks to a multiple of this; the blanks do not count.
FILL = 32
#: Chosen documents of all languages that are broadcast, at most; more are joined by a shuffle.
CHOSEN_ROWS = 100_000
UNKNOWN = "und"
EMBED, HIDDEN = 12, 8
STEPS, BATCH, RATE = 400, 256, 0.02
#: Stretches that go through the network together.
TOGETHER = 512


class ByteNetwork:
    """Embedding, a gated recurrent unit each way, and a linear layer that labels every position."""

    def __init__(self, languages: list[str], embed: int = EMBED, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)

        def weights(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.languages, self.hidden = languages, hidden
        self.p = {"embed": weights(256, embed) * 4, "out": weights(2 * hidden, len(languages)),
                  "out_b": np.zeros(len(languages), np.float32)}
        for way in ("f", "b"):
            self.p |= {f"w{way}": weights(embed, 3 * hidden), f"u{way}": weights(hidden, 3 * hidden),
                       f"c{way}": np.zeros(3 * hidden, np.float32), f"d{way}": np.zeros(hidden, np.float32)}

    def _run(self, way: str, ids: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States after each of the T bytes of B windows: (T, B, hidden). ``ids`` is (T, B), in reading order."""
        h, p = self.hidden, self.p
        table = p["embed"] @ p[f"w{way}"] + p[f"c{way}"]  # the input's part of the gates, per byte
        u, d = p[f"u{way}"], p[f"d{way}"]
        state = np.zeros((ids.shape[1], h), np.float32)
        states = np.empty((*ids.shape, h), np.float32)
        for t, row in enumerate(ids):
            x, r = table[row], state @ u
            gates = 1 / (1 + np.exp(-(x[:, :2 * h] + r[:, :2 * h])))
            keep, reset = gates[:, :h], gates[:, h:]
            inner = r[:, 2 * h:] + d
            fresh = np.tanh(x[:, 2 * h:] + reset * inner)
            if tape is not None:
                tape.append((state, keep, reset, inner, fresh))
            state = fresh + keep * (state - fresh)
            states[t] = state
        return states

    def _read(self, way: str, ids: np.ndarray) -> np.ndarray:
        """The same states without a tape, (T, hidden, B): features come first, so that all steps run in place."""
        h, p = self.hidden, self.p
        table = np.ascontiguousarray((p["embed"] @ p[f"w{way}"] + p[f"c{way}"]).T)
        u, d = np.ascontiguousarray(p[f"u{way}"].T), p[f"d{way}"][:, None]
        steps, width = ids.shape
        states = np.empty((steps, h, width), table.dtype)
        state = np.zeros((h, width), table.dtype)
        x, r = np.empty((3 * h, width), table.dtype), np.empty((3 * h, width), table.dtype)
        gates, fresh = r[:2 * h], r[2 * h:]
        for t in range(steps):
            np.take(table, ids[t], axis=1, out=x, mode="clip")
            np.matmul(u, state, out=r)
            gates += x[:2 * h]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            fresh += d
            fresh *= gates[h:]
            fresh += x[2 * h:]
            np.tanh(fresh, out=fresh)
            np.subtract(state, fresh, out=states[t])
            states[t] *= gates[:h]
            states[t] += fresh
            state = states[t]
        return states

    def _labels(self, ids: np.ndarray) -> np.ndarray:
        """(T, languages, B) for stretches of one length, ``ids`` (T, B)."""
        h, out = self.hidden, np.ascontiguousarray(self.p["out"].T)
        score = np.matmul(out[:, :h], self._read("f", ids))
        score += np.matmul(out[:, h:], self._read("b", ids[::-1])[::-1])
        score += self.p["out_b"][:, None]
        score -= score.max(1, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(1, keepdims=True)
        return score

    def probabilities(self, ids: np.ndarray) -> np.ndarray:
        """(T, B, languages) for stretches of one length, ``ids`` (T, B)."""
        return self._labels(ids).transpose(0, 2, 1)

    def gradients(self, ids: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over all positions, by backpropagation through time. ``labels`` are (B) or
        (T, B)."""
        h, p = self.hidden, self.p
        tapes: dict[str, list] = {"f": [], "b": []}
        one_hot = np.eye(256, dtype=p["embed"].dtype)
        both = np.concatenate([self._run("f", ids, tapes["f"]), self._run("b", ids[::-1], tapes["b"])[::-1]], axis=2)
        score = both @ p["out"] + p["out_b"]
        score -= score.max(2, keepdims=True)
        error = np.exp(score)
        error /= error.sum(2, keepdims=True)
        error[np.arange(len(ids))[:, None], np.arange(ids.shape[1]), labels] -= 1
        error /= error.shape[0] * error.shape[1]
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        grads["out"] = np.einsum("tbh,tbl->hl", both, error)
        grads["out_b"] = error.sum((0, 1))
        back = error @ p["out"].T
        for way, part, order in (("f", back[:, :, :h], ids), ("b", back[::-1, :, h:], ids[::-1])):
            u, carried = p[f"u{way}"], np.zeros((ids.shape[1], h), np.float32)
            on_table = np.zeros((256, 3 * h), u.dtype)
            for t in range(len(order) - 1, -1, -1):
                state, keep, reset, inner, fresh = tapes[way][t]
                g = part[t] + carried
                g_fresh = g * (1 - keep) * (1 - fresh * fresh)
                g_keep = g * (state - fresh) * keep * (1 - keep)
                g_reset = g_fresh * inner * reset * (1 - reset)
                g_inner = g_fresh * reset
                to_x = np.concatenate([g_keep, g_reset, g_fresh], axis=1)
                to_r = np.concatenate([g_keep, g_reset, g_inner], axis=1)
                on_table += one_hot[order[t]].T @ to_x
                grads[f"u{way}"] += state.T @ to_r
                grads[f"d{way}"] += g_inner.sum(0)
                carried = g * keep + to_r @ u.T
            grads[f"c{way}"] = on_table.sum(0)
            grads[f"w{way}"] = p["embed"].T @ on_table
            grads["embed"] += on_table @ p[f"w{way}"].T
        return grads

    def fit(self, windows: list[bytes], labels: np.ndarray, counts: np.ndarray, steps: int = STEPS, batch: int = BATCH,
            rate: float = RATE, seed: int = 11) -> ByteNetwork:
        """Adam over batches of equally long windows, drawn by how often they occur. A run of each window is taken from
        another one, with its labels, so that the network learns to label positions and not to carry a first guess on."""
        rng = np.random.default_rng(seed)
        lengths = np.array([len(w) for w in windows])
        groups = []
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            ids = np.frombuffer(b"".join(windows[i] for i in own), np.uint8).reshape(len(own), n)
            groups.append((ids, labels[own], counts[own] / counts[own].sum(), counts[own].sum() * n))
        share = np.array([g[3] for g in groups], float)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            ids, own, weight, _ = groups[rng.choice(len(groups), p=share / share.sum())]
            pick, other = rng.choice(len(own), (2, batch), p=weight)
            first_of, at = rng.integers(0, ids.shape[1], batch), np.arange(ids.shape[1])[:, None]
            foreign = (at >= first_of) & (at < first_of + rng.integers(0, ids.shape[1] // 2 + 1, batch))
            mixed = np.where(foreign, ids[other].T, ids[pick].T).astype(np.intp)
            speed = rate * min(1.0, 2 * (1 - (step - 1) / steps))
            for k, g in self.gradients(mixed, np.where(foreign, own[other], own[pick])).items():
                np.clip(g, -1, 1, out=g)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.p[k] -= speed * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def means(self, texts: list[bytes]) -> np.ndarray:
        """For each text, none of them empty, the mean of the probabilities over all its bytes."""
        lengths = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(_filled(t, SPAN) for t in texts), np.uint8)
        room = np.where(lengths < SPAN, -(-lengths // FILL) * FILL, lengths)
        begins = np.cumsum(room) - room
        # Stretches start every STRIDE bytes; the last one ends with the text.
        stride = SPAN - 2 * CONTEXT
        number = np.maximum(1, -(-(lengths - 2 * CONTEXT) // stride))
        owner = np.repeat(np.arange(len(texts)), number)
        turn = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        is_last = turn == number[owner] - 1
        start = np.where(is_last, np.maximum(0, lengths[owner] - SPAN), turn * stride)
        # What a stretch counts begins where the one before it stopped.
        low = np.where(turn > 0, turn * stride + CONTEXT, 0) - start
        high = np.where(is_last, lengths[owner] - start, SPAN - CONTEXT)
        size = np.minimum(room[owner], SPAN)
        sums = np.zeros((len(texts), len(self.languages)))
        for n in np.unique(size):
            own, at = np.flatnonzero(size == n), np.arange(n)[:, None]
            for some in np.split(own, range(TOGETHER, len(own), TOGETHER)):
                labels = self._labels(data[begins[owner[some]] + start[some] + at].astype(np.intp))
                labels *= ((at >= low[some]) & (at < high[some]))[:, None, :]
                np.add.at(sums, owner[some], labels.sum(0).T)
        return sums / lengths[:, None]


def _filled(text: bytes, span: int) -> bytes:
    return text if len(text) >= span else text + b" " * (-len(text) % FILL)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its identifier as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _windows(batches):
    out = pa.schema([("lang", pa.string()), ("window", pa.binary())])
    for part in arrow.slices(batches, "text", 1 << 20):
        for lang, text in zip(part.column("lang").to_pylist(), arrow.raw(part.column("text")), strict=True):
            text = text.lower()
            own = [_filled(text[i:i + LEARNED], LEARNED) for i in range(0, len(text), LEARNED)]
            own = [w for w in own if not w.isspace()]
            yield arrow.batch(out, [lang] * len(own), own)


def train(docs: DataFrame, max_docs: int = DOCS, max_windows: int = WINDOWS, **options) -> ByteNetwork | None:
    """A network fitted to the labelled documents that are not held out; none if there are no such documents."""
    learned = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = learned.select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= max_docs)
    texts = learned.select("doc_id", F.col("lang").cast("string").alias("lang"), arrow.text_column().alias("text")).join(
        sized.small_side(chosen.select("doc_id"), probe_rows=CHOSEN_ROWS), "doc_id", "left_semi").select("lang", "text")
    counted = texts.mapInArrow(_windows, "lang string, window binary").groupBy("lang", "window").count()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("window"), "window")
    bounded = counted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= max_windows)
    rows = sorted((r["lang"], bytes(r["window"]), r["count"]) for r in bounded.drop("_rank").collect())
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.array([r[2] for r in rows], float)
    labels = np.array([place[r[0]] for r in rows])
    counts /= np.bincount(labels, counts)[labels]  # languages weigh the same, whatever their share
    return ByteNetwork(languages).fit([r[1] for r in rows], labels, counts, **options)


def _label(model: ByteNetwork | None, schema: pa.Schema, carried: list[str]):
    def work(batches):
        for part in arrow.slices(batches, "_text"):
            n = part.num_rows
            best, score = np.full(n, UNKNOWN, object), np.zeros(n)
            lettered = np.flatnonzero(part.column("_lettered").to_numpy(zero_copy_only=False))
            if model and len(lettered):
                texts = arrow.raw(part.column("_text").take(pa.array(lettered)))
                means = model.means([text.lower() for text in texts])
                best[lettered] = np.array(model.languages, object)[means.argmax(1)]
                score[lettered] = np.minimum(1.0, means.max(1)).round(6)
            yield arrow.batch(schema, *(part.column(c) for c in carried), best.tolist(), score)

    return work


def languages_of(docs: DataFrame, model: ByteNetwork | None, carry: list[str]) -> DataFrame:
    """The ``carry`` columns of every document with ``lang_pred`` and ``score``. One narrow stage."""
    named = [f"_c{i}" for i in range(len(carry))]
    text = arrow.text_column()
    rows = docs.select(*(arrow.column(c).alias(n) for c, n in zip(carry, named, strict=True)), text.alias("_text"),
                       text.rlike(r"\p{L}").alias("_lettered"))
    kept = T.StructType([*(rows.schema[n] for n in named), T.StructField("lang_pred", T.StringType()),
                         T.StructField("score", T.DoubleType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    found = rows.mapInArrow(_label(model, to_arrow_schema(kept), named), kept)
    return found.select(*(F.col(n).alias(c) for c, n in zip(carry, named, strict=True)), "lang_pred", "score")
