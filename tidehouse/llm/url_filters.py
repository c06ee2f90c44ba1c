"""URL rules behind a cascade of Bloom filters, with DataFrame functions only.

A rule is a host and the start of a path; it fits the host and its subdomains, and the longest fitting rule wins. Every
URL has candidate keys: each suffix of its host that begins at a label, with each start of its path that is as long as
some rule's path. Level 1 of the cascade encodes the listed keys. All candidate keys of the whole corpus that it lets
through although they are not listed are encoded in level 2, the listed keys that level 2 lets through in level 3, and so
on until a level lets nothing wrong through. For keys of that corpus, the cascade is then exact: a key is listed if the
first level that rejects it is an even one. No URL is joined with the list. A second, smaller cascade over the listed keys
alone tells the allowed from the blocked.

Level 1 is so large that about as many unlisted keys pass as there are listed ones, so all levels together take some
``log2(keys of the corpus)`` bits a rule. They reach the tasks as literals, each once in the expression. A list whose first
level would take more than ``LEVEL_BYTES`` is cut by a hash of the key into parts, each with cascades of its own. The parts
are asked one after the other, and what is found is written in between, so that driver and tasks hold one part at a time.

Defined results: a null URL and one without ``://`` have an empty host and path; a URL that no rule fits is allowed, as
the list names what is to be blocked; of rules with one key a blocking one counts; of fitting keys of one length the one
with the greater text wins; an empty list allows everything; repeated pages are judged row by row; other columns are left
out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidehouse import session

#: About the largest filter of one level; a longer list is cut into parts.
LEVEL_BYTES = 8 << 20
HASHES = 4
MAX_LEVELS = 40


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to ``/ ? #`` or the end with A-Z lower-cased, then up to ``?`` or ``#``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Every key of a rule that could fit: host suffixes at labels, with starts of the path."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring(path, 1, n).alias("start")) for n in path_lengths]),
                      lambda s: F.char_length(s["start"]) == s["n"])
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p["start"]))))


class Cascade:
    """Levels of (bits, words); level 1 encodes the listed keys."""

    def __init__(self, levels: list[tuple[int, list[int]]]):
        self.levels = levels

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        result = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            passed = _passes(key, number, *self.levels[number - 1])
            result = F.when(~passed, F.lit(number % 2 == 0)).otherwise(result)
        return result

    @property
    def n_bytes(self) -> int:
        return sum(len(words) * 8 for _, words in self.levels)


def _places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(bits)) for i in range(HASHES)]


def _passes(key: Column, level: int, bits: int, words: list[int]) -> Column:
    vector = F.from_json(F.lit(json.dumps(words)), "array<bigint>")  # folded into one literal
    seeds = F.array(*[F.lit(level * HASHES + i) for i in range(HASHES)])

    def is_set(seed: Column) -> Column:
        place = F.pmod(F.xxhash64(key, seed), F.lit(bits))
        return F.get(vector, F.shiftright(place, 6).cast("int")).bitwiseAND(_bit(place)) != 0

    return F.forall(seeds, is_set)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def _filter(keys: DataFrame, level: int, bits: int) -> tuple[int, list[int]]:
    """A filter of the keys in column ``key``: as many numbers reach the driver as the filter has words."""
    places = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits))).alias("place"))
    words = [0] * (-(-bits // 64))
    for row in places.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(_bit(F.col("place"))).alias("word")).collect():
        words[row["at"]] = row["word"]
    return bits, words


def _first_rate(listed: int, universe: int) -> float:
    """The share of unlisted keys that level 1 may let through."""
    return 1 / max(2.0, math.sqrt(2) * max(universe, 1) / max(listed, 1))


def _bits_a_key(rate: float) -> float:
    return -HASHES / math.log(1 - rate ** (1 / HASHES))


def build_cascade(listed: DataFrame, universe: Callable[[], DataFrame], universe_size: int) -> Cascade:
    """A cascade that is exact for all keys of ``universe()``; both have one column ``key``.

    ``universe`` may hold repeated keys and listed ones. It is read once for every even level.
    """
    n = max(1, listed.count())
    rate = _first_rate(n, universe_size)
    levels: list[tuple[int, list[int]]] = []
    sides = (listed, universe().join(listed, "key", "left_anti"))
    size = n
    for level in range(1, MAX_LEVELS + 1):
        own = sides[(level - 1) % 2]
        for number, (bits, words) in enumerate(levels, 1):
            own = own.where(_passes(F.col("key"), number, bits, words))
        if level > 1:
            size = own.distinct().count()
            if not size:
                return Cascade(levels)
        levels.append(_filter(own, level, max(64, math.ceil(size * _bits_a_key(rate if level == 1 else 0.5)))))
    raise RuntimeError("the cascade did not end")


def rule_keys(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` to ``key, blocked``; of rules with one key a blocking one counts."""
    return rules.groupBy(F.concat("host", "path").alias("key")).agg(F.max(F.col("verdict") == "block").alias("blocked"))


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


def _best_of_part(keys: DataFrame, universe: DataFrame, part: int, parts: int, n_keys: int, n_universe: int) -> Column:
    """``n, key, blocked`` of the longest key in ``keys`` that is listed in a part of the list; null if none is."""
    def own(df: DataFrame) -> DataFrame:
        return df.where(_part(F.col("key"), parts) == part) if parts > 1 else df

    listed = own(keys).select("key")
    members = build_cascade(listed, lambda: own(universe), n_universe // parts)
    blocking = build_cascade(own(keys).where("blocked").select("key"), lambda: listed, n_keys // parts)

    def holds(key: Column) -> Column:
        return (_part(key, parts) == part) & members.holds(key) if parts > 1 else members.holds(key)

    fitting = F.transform(F.filter("keys", holds), lambda k: F.struct(F.char_length(k).alias("n"), k.alias("key")))
    longest = F.slice(F.sort_array(fitting, asc=False), 1, 1)
    return F.get(F.transform(longest, lambda k: F.struct(k["n"].alias("n"), k["key"].alias("key"),
                                                         blocking.holds(k["key"]).alias("blocked"))), 0)


def url_verdicts(pages: DataFrame, rules: DataFrame, level_bytes: int = LEVEL_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    lengths = [r[0] for r in rules.select(F.char_length("path").alias("n")).distinct().orderBy("n").collect()]
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    if not lengths:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    candidates = candidate_keys(F.col("host"), F.col("path"), lengths)
    universe = parsed.select(F.explode(candidates).alias("key"))
    keys = rule_keys(rules)
    n_keys, n_universe = keys.count(), universe.agg(F.approx_count_distinct("key")).first()[0]
    parts = max(1, math.ceil(n_keys * _bits_a_key(_first_rate(n_keys, n_universe)) / (level_bytes * 8)))
    judged = parsed.withColumn("best", F.lit(None).cast("struct<n:int,key:string,blocked:boolean>"))
    for part in range(parts):
        found = judged.select("page_id", "host", "path", "best", candidates.alias("keys"))
        judged = found.select("page_id", "host", "path", F.greatest("best", _best_of_part(keys, universe, part, parts, n_keys,
                                                                                         n_universe)).alias("best"))
        if parts > 1:
            folder = session.shared_dir(pages.sparkSession, "url-part")
            judged.write.parquet(folder)
            judged = pages.sparkSession.read.schema(judged.schema).parquet(folder)
    verdict = F.when(F.coalesce("best.blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))
