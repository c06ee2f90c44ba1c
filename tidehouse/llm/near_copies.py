"""Near duplicates by min-max hashing.

A document's set holds its distinct five-word shingles (64-bit hashes). Every permutation gives two values, the least and
the greatest image of the set, so 64 permutations make a signature of 128 values; either matches with the chance of the
similarity, without bias. Four values of four permutations (two least, two greatest) make a band, 32 bands in all: a pair
at similarity 0.75 shares no band with a chance of 5 in a million, at 0.8 of 5 in 10**8.

Documents with one set become one node first. Nodes of a band's bucket are compared by a sketch of one bit a signature
value (a pair at 0.75 fails it with a chance of 2 in 10**6) and by size; what passes is confirmed on full sets. No pair
is confirmed that would join what is joined already, so copies are not expanded into pairs:

1. Buckets of up to 16 nodes give all pairs that pass; in a larger one, the node nearest to the majority of the sketches
   and the least node are paired with all others. Each node confirms its nearest and its least partner first.
2. Pairs of different components that are still open are confirmed.
3. In large buckets that hold several components, every node outside the largest one asks all nodes of the bucket. The
   bucket is cut into slices of bounded size; who asks visits each. Sketches and a byte of every signature value leave out
   rows that meet nothing likely, as documents that share a passage meet in such buckets. The rest is compared on full
   sets by an index of a slice's shingles, and a slice returns links between components, never pairs of nodes.

Confirmed links are joined to components after each step.

Defined results: null and empty texts have an empty set and no links; fewer than five words are one shingle; rows without
an identifier are linked with nothing, their component is null and they are kept; rows with one identifier are one node.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidehouse import session, sized
from tidehouse.llm import arrow, components, word_hashes

SHINGLE = 5
#: Similarity in hundredths.
SIMILAR = 75
PERMUTATIONS, BANDS = 64, 32
#: Sketch bits that may differ: the expected 16 at 0.75 and five standard deviations.
DIFFERENT_BITS = 35
#: Nodes of a bucket all of whose pairs are compared at once.
SMALL = 16
#: Shingles in a slice of a large bucket, 50 more for each node: what a task of step 3 holds at once.
SLICE = 1 << 18
#: Links that a slice gathers before they are contracted.
GATHERED = 100_000
#: Signature values, one byte of each, that may differ: the expected 32 of 128 at 0.75 and five and a half deviations.
DIFFERENT_VALUES = 59

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1))
_B = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
del _rng

_SIGNATURE = ("doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch_a long, sketch_b long, "
              "signature binary")
_SIGNATURE_ARROW = pa.schema([(n, {"bands": pa.list_(pa.int64()), "signature": pa.binary()}.get(n, pa.int64())) for n in
                              ("doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch_a", "sketch_b", "signature")])
_FOUND = "u long, v long, bits int, bucket long, node long, n_shingles long, sketch_a long, sketch_b long"
_FOUND_ARROW = pa.schema([(n, pa.int32() if n == "bits" else pa.int64()) for n in
                          ("u", "v", "bits", "bucket", "node", "n_shingles", "sketch_a", "sketch_b")])
_SLICED = "bucket long, slice long, asks boolean, node long, label long"
_SLICED_ARROW = pa.schema([(n, pa.bool_() if n == "asks" else pa.int64()) for n in ("bucket", "slice", "asks", "node", "label")])


def shingle_set(text: bytes, hashes: word_hashes.WordHashes, length: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    own = hashes.of(words)
    return np.unique(word_hashes.runs(own, min(length, len(own)))) if len(own) else own


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) image under every permutation."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least, greatest = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(low), 4096):
        images = low[at:at + 4096, None] * _A + _B
        np.minimum(least, images.min(0), out=least)
        np.maximum(greatest, images.max(0), out=greatest)
    return least, greatest


def bands(least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """One hash a band: two least and two greatest values, of four different permutations."""
    half = BANDS  # permutations 0..31 beside 32..63
    chosen = np.stack([least[:half], least[half:], np.roll(greatest[:half], 1), np.roll(greatest[half:], 3)]).astype(np.uint64)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in chosen:
        total = word_hashes.mix(total * np.uint64(0x9E3779B97F4A7C15) + row)
    return total


def sketch(least: np.ndarray, greatest: np.ndarray) -> tuple[int, int]:
    """One bit of each signature value, as two signed 64-bit numbers."""
    return tuple(int(np.packbits((word_hashes.mix(side.astype(np.uint64)) >> np.uint64(63)).astype(np.uint8)).view(">i8")[0])
                 for side in (least, greatest))


def _signatures(batches):
    hashes = word_hashes.WordHashes()
    for part in arrow.slices(batches, "text"):
        columns: list[list] = [[] for _ in _SIGNATURE_ARROW]
        for doc_id, text in zip(part.column("doc_id").to_pylist(), arrow.raw(part.column("text")), strict=True):
            own = shingle_set(text, hashes)
            if len(own):
                key = xxhash.xxh3_128_digest(own.tobytes())
                a, b = np.frombuffer(key, "<i8").tolist()
                least, greatest = signature(own)
                row = (doc_id, len(own), a, b, bands(least, greatest).view(np.int64), *sketch(least, greatest),
                       np.concatenate([least, greatest]).astype(np.uint8).tobytes())
            else:
                row = (doc_id, 0, None, None, None, None, None, None)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        yield arrow.batch(_SIGNATURE_ARROW, *columns)


def _whole_buckets(batches):
    """Column arrays of batches cut so that no bucket is torn; buckets of one node are left out."""
    names = ("bucket", "node", "n_shingles", "sketch_a", "sketch_b")
    held: list[list[np.ndarray]] = []
    last = None

    def flush(parts):
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        bucket = columns[0]
        same = bucket[1:] == bucket[:-1]
        many = np.append(same, False) | np.insert(same, 0, False)
        return [c[many] for c in columns]

    for part in batches:
        if not part.num_rows:
            continue
        columns = [part.column(n).to_numpy() for n in names]
        end = int(np.searchsorted(columns[0], columns[0][-1], "left"))  # the last bucket may go on
        if end or columns[0][0] != last:
            if held and columns[0][0] != last:
                yield flush(held)
                held = []
            if end:
                yield flush([*held, [c[:end] for c in columns]])
                held = []
        held.append([c[end:] for c in columns])
        last = columns[0][-1]
    if held:
        yield flush(held)


def _alike(size_a, size_b, bits):
    return (bits <= DIFFERENT_BITS) & (100 * np.minimum(size_a, size_b) >= SIMILAR * np.maximum(size_a, size_b))


def _bits(a1, b1, a2, b2) -> np.ndarray:
    return sum(np.bitwise_count((x ^ y).view(np.uint64)).astype(np.int32) for x, y in ((a1, a2), (b1, b2)))


def _majority(sketches: np.ndarray) -> np.int64:
    bits = np.unpackbits(sketches.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(0) >= len(bits)).view(">i8")[0].astype(np.int64)


def _pairs_of_buckets(batches):
    """Step 1: pairs ``u < v`` with their differing bits, and the members of large buckets."""
    for bucket, node, size, a, b in _whole_buckets(batches):
        if not len(bucket):
            continue
        starts = np.flatnonzero(np.insert(bucket[1:] != bucket[:-1], 0, True))
        lengths = np.diff(np.append(starts, len(bucket)))
        room = np.repeat(lengths, lengths)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for step in range(1, min(SMALL, int(lengths.max()))):
            i = np.flatnonzero((bucket[step:] == bucket[:-step]) & (room[step:] <= SMALL))
            pairs.append((i, i + step))
        for start, length in zip(starts[lengths > SMALL], lengths[lengths > SMALL], strict=True):
            own = np.arange(start, start + length)
            far = _bits(a[own], b[own], _majority(a[own]), _majority(b[own]))
            centre = own[int(np.lexsort((node[own], far))[0])]
            for one in {int(centre), int(own[int(node[own].argmin())])}:
                pairs.append((np.full(length, one), own))
        i, j = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int),) * 2
        bits = _bits(a[i], b[i], a[j], b[j])
        good = _alike(size[i], size[j], bits) & (node[i] != node[j])
        i, j, bits = i[good], j[good], bits[good]
        u, v = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        none = pa.nulls(len(u), pa.int64())
        yield arrow.batch(_FOUND_ARROW, u, v, bits, none, none, none, none, none)
        large = np.flatnonzero(room > SMALL)
        none = pa.nulls(len(large), pa.int64())
        yield arrow.batch(_FOUND_ARROW, none, none, pa.nulls(len(large), pa.int32()), bucket[large], node[large], size[large],
                          a[large], b[large])


def _cut(batches):
    """Batches sorted by bucket, slice and ``asks``, cut where one of these changes: ``(bucket, slice), asks, part``."""
    for part in batches:
        if not part.num_rows:
            continue
        keys = [part.column(n).to_numpy(zero_copy_only=False) for n in ("bucket", "slice", "asks")]
        starts = np.flatnonzero(np.insert(np.any([k[1:] != k[:-1] for k in keys], axis=0), 0, True))
        for start, end in zip(starts, [*starts[1:], part.num_rows], strict=True):
            yield (int(keys[0][start]), int(keys[1][start])), bool(keys[2][start]), part.slice(start, end - start)


def _likely(batches):
    """Step 3: the rows of a slice that may be similar to a row of another component, by sketch, size and signature."""
    names = ("node", "label", "n_shingles", "sketch_a", "sketch_b")

    def columns(part):
        values = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8).reshape(-1, 2 * PERMUTATIONS)
        return [*(part.column(n).to_numpy() for n in names), values]

    def rows(key, asks, node, label, chosen):
        n = int(chosen.sum())
        return arrow.batch(_SLICED_ARROW, np.full(n, key[0]), np.full(n, key[1]), np.full(n, asks), node[chosen], label[chosen])

    key, held, members, met = None, [], None, None
    for now, asks, part in _cut(batches):
        if now != key:
            if members is not None:
                yield rows(key, False, *members[:2], met)
            key, held, members = now, [], None
        if not asks:
            held.append(columns(part))
            continue
        if members is None:
            if not held:
                continue
            members = [np.concatenate(c) for c in zip(*held, strict=True)]
            met, held = np.zeros(len(members[0]), bool), []
        node, label, size, a, b, values = members
        own = columns(part)
        yes = np.zeros(part.num_rows, bool)
        for k, (_, its_label, its_size, its_a, its_b, its_values) in enumerate(zip(*own, strict=True)):
            near = np.flatnonzero(_alike(size, its_size, _bits(a, b, its_a, its_b)) & (label != its_label))
            near = near[(values[near] != its_values).sum(1) <= DIFFERENT_VALUES]
            met[near] = True
            yes[k] = len(near) > 0
        yield rows(key, True, *own[:2], yes)
    if members is not None:
        yield rows(key, False, *members[:2], met)


class _Index:
    """The shingles of a slice's members, each with who holds it."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray):
        self._labels, self._sizes = labels, np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        self._shingles, self._owners = every[order], np.repeat(np.arange(len(sets)), self._sizes)[order]

    def similar(self, own: np.ndarray) -> np.ndarray:
        """Labels of the members whose sets are similar to ``own``."""
        low = np.searchsorted(self._shingles, own, "left")
        n = np.searchsorted(self._shingles, own, "right") - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(self._owners[at], minlength=len(self._sizes))
        return np.unique(self._labels[100 * shared >= SIMILAR * (len(own) + self._sizes - shared)])


def _links_of_slices(batches):
    """Step 3: links between components that hold on full sets, as stars."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    hashes = word_hashes.WordHashes()
    key, held, index, ends, gathered = None, [], None, [], 0
    for now, asks, part in _cut(arrow.slices(batches, "text")):
        if now != key:
            key, held, index = now, [], None
        sets = [shingle_set(text, hashes) for text in arrow.raw(part.column("text"))]
        labels = part.column("label").to_numpy()
        if not asks:
            held.append((sets, labels))
            continue
        if index is None:
            if not held:
                continue
            index, held = _Index([s for part_sets, _ in held for s in part_sets], np.concatenate([x for _, x in held])), []
        for own, label in zip(sets, labels, strict=True):
            others = index.similar(own)
            ends.append((np.full(len(others), label), others))
            gathered += len(others)
        if gathered > GATHERED:
            yield arrow.batch(out, *components.local_stars(*(np.concatenate(x) for x in zip(*ends, strict=True))))
            ends, gathered = [], 0
    if ends:
        yield arrow.batch(out, *components.local_stars(*(np.concatenate(x) for x in zip(*ends, strict=True))))


def _confirm(batches):
    """``u, v, text_u, text_v`` to the links that hold on full sets."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    hashes = word_hashes.WordHashes()

    @functools.lru_cache(maxsize=64)
    def whole(_: int, text: bytes) -> np.ndarray:
        return shingle_set(text, hashes)

    for part in arrow.slices(batches, "text_u"):
        u, v = [], []
        columns = (part.column(n) for n in ("u", "v"))
        texts = (arrow.raw(part.column(n)) for n in ("text_u", "text_v"))
        for one, two, text_one, text_two in zip(*(c.to_pylist() for c in columns), *texts, strict=True):
            a, b = whole(one, text_one), whole(two, text_two)
            if len(a) > len(b):
                a, b = b, a
            if not len(a) or 100 * len(a) < SIMILAR * len(b):
                continue
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            shared = int((b[at] == a).sum())
            if 100 * shared >= SIMILAR * (len(a) + len(b) - shared):
                u.append(one)
                v.append(two)
        yield arrow.batch(out, u, v)


class _Links:
    """Components of the links confirmed so far, and the pairs that were looked at; all in the shared folder."""

    def __init__(self, spark: SparkSession, texts: DataFrame):
        self._spark, self._texts = spark, texts
        self.labels: DataFrame | None = None
        self.tested: DataFrame | None = None

    def _stored(self, df: DataFrame, what: str, schema: str) -> DataFrame:
        path = session.shared_dir(self._spark, what)
        df.write.parquet(path)
        return self._spark.read.schema(schema).parquet(path)

    def labelled(self, df: DataFrame, node: str, label: str) -> DataFrame:
        if self.labels is None:
            return df.withColumn(label, F.col(node))
        names = self.labels.select(F.col("id").alias(node), F.col("component").alias("_c"))
        return df.join(names, node, "left").withColumn(label, F.coalesce("_c", node)).drop("_c")

    def confirm(self, pairs: DataFrame) -> None:
        """Confirm those pairs that join different components and were not looked at."""
        new = pairs.select("u", "v").distinct()
        if self.labels is not None:
            new = self.labelled(self.labelled(new, "u", "lu"), "v", "lv").where("lu <> lv").select("u", "v")
        if self.tested is not None:
            new = new.join(self.tested, ["u", "v"], "left_anti")
        new = self._stored(new, "pairs", "u long, v long")
        if new.isEmpty():
            return
        self.tested = new if self.tested is None else self.tested.unionByName(new)
        ends = self._texts
        met = sized.small_side(new).join(ends.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v")), "v") \
            .join(ends.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u")), "u")
        self.add(met.select("u", "v", "text_u", "text_v").mapInArrow(_confirm, "u long, v long"))

    def add(self, links: DataFrame) -> None:
        """Join the components that links ``u, v`` tie together."""
        held = self._stored(links, "links", "u long, v long")
        if held.isEmpty():
            return
        if self.labels is not None:  # components so far are stars; new links tie them together
            held = held.unionByName(self.labels.select(F.col("id").alias("u"), F.col("component").alias("v")))
        self.labels = components.components(held)


def _sliced(labelled: DataFrame) -> DataFrame:
    """Members of buckets with several components, each in one slice; who is not in the largest one asks in every slice."""
    counts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum(F.col("n_shingles") + 50).alias("weight"))
    several = counts.groupBy("bucket").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels"),
        F.ceil(F.sum("weight") / SLICE).alias("slices")).where("labels > 1").drop("labels")
    at = F.array(F.struct(F.pmod(F.xxhash64("node"), F.col("slices")).alias("slice"), F.lit(False).alias("asks")))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1),
                        lambda s: F.struct(s.alias("slice"), F.lit(True).alias("asks")))
    place = F.when(F.col("label") == F.col("main"), at).otherwise(F.concat(at, every))
    return labelled.join(sized.splittable(several, "bucket"), "bucket").select(
        *labelled.columns, F.explode(place).alias("_p")).select(*labelled.columns, "_p.slice", "_p.asks")


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document. Writes intermediate tables to the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), arrow.text_column().alias("text"))

    def stored(df: DataFrame, what: str, schema: str) -> DataFrame:
        path = session.shared_dir(spark, what)
        df.write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    signed = stored(texts.mapInArrow(_signatures, _SIGNATURE), "signatures", _SIGNATURE)
    known = signed.where("doc_id is not null and n_shingles > 0")
    nodes = known.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    first = sized.splittable(nodes.select(F.col("node").alias("doc_id"), "set_a", "set_b"), "doc_id", "set_a", "set_b")
    rows = known.join(first, ["doc_id", "set_a", "set_b"], "left_semi").select(
        F.col("doc_id").alias("node"), "n_shingles", "bands", "sketch_a", "sketch_b")
    exploded = rows.select(F.explode("bands").alias("bucket"), "node", "n_shingles", "sketch_a", "sketch_b")
    dealt = exploded.repartition("bucket").sortWithinPartitions("bucket", "node")
    found = stored(dealt.mapInArrow(_pairs_of_buckets, _FOUND), "candidates", _FOUND)
    pairs = stored(found.where("u is not null").groupBy("u", "v").agg(F.min("bits").alias("bits")), "pairs",
                   "u long, v long, bits int")
    large = found.where("bucket is not null").select("bucket", "node", "n_shingles", "sketch_a", "sketch_b")
    ends = pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).union(large.select("node")).distinct()
    ends = stored(ends, "ends", "doc_id long")  # its size is known then: beyond the limit texts are shuffled instead
    involved = stored(texts.join(sized.small_side(ends), "doc_id", "left_semi"), "involved", "doc_id long, text string")
    links = _Links(spark, involved)
    both = pairs.select(F.col("u").alias("x"), "u", "v", "bits").union(pairs.select(F.col("v").alias("x"), "u", "v", "bits"))
    chosen = both.groupBy("x").agg(F.min(F.struct("bits", "u", "v")).alias("near"), F.min(F.struct("u", "v", "bits")).alias("least"))
    links.confirm(chosen.select(F.explode(F.array(F.struct("near.u", "near.v"), F.struct("least.u", "least.v"))).alias("p"))
                  .select("p.u", "p.v"))
    links.confirm(pairs)
    if not large.isEmpty():
        rows = _sliced(links.labelled(large, "node", "label")).join(
            known.select(F.col("doc_id").alias("node"), "signature"), "node")
        likely = stored(rows.repartition("bucket", "slice").sortWithinPartitions("bucket", "slice", "asks", "node").mapInArrow(
            _likely, _SLICED), "likely", _SLICED)
        met = likely.join(involved.select(F.col("doc_id").alias("node"), "text"), "node")
        links.add(met.repartition("bucket", "slice").sortWithinPartitions("bucket", "slice", "asks", "node")
                  .mapInArrow(_links_of_slices, "u long, v long"))
    named = known.select("doc_id", "n_shingles", "set_a", "set_b").join(sized.splittable(nodes, "set_a", "set_b"), ["set_a", "set_b"])
    named = links.labelled(named, "node", "component_id").select("doc_id", "n_shingles", "component_id")
    alone = signed.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    every = named.unionByName(alone)
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
