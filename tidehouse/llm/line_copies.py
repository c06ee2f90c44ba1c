"""Lines that documents share are kept in one document only.

Texts are split at line feeds. A line's key is the line without white space at its ends, A-Z lower-cased. Lines are
exploded with their place, the key is hashed to 128 bits, and distinct documents are counted per hash; the counts are
combined before they are shuffled, so a line that every document has costs one row per task. Lines of a key that enough
documents share go everywhere but in the document with the smallest identifier. What is sent back to a document are the
places of its dropped lines, and the text is put together again from the places that stay. Line texts are never
shuffled; whole texts once, to meet the places.

Defined results: null text counts as empty, which is one empty line; a null identifier counts as the greatest one, and
all rows without one as one document; rows with one identifier are one document when documents are counted, each with
its own lines; repeated rows give equal rows; a shared line that its first document has twice stays there twice; a text
whose lines all go is empty; keys of fewer than ``least_chars`` code points always stay; an empty table gives no rows;
other columns are left out. A text's length matters nowhere but in its own row. Two keys or two texts of equal hashes
would be taken for one, with a chance of about 2**-128 a pair.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tidehouse import sized
from tidehouse.llm import arrow

#: ASCII white space (fixed values).
WHITE = " \t\n\x0b\x0c\r"
#: Code points of the shortest key that is compared, and the number of documents that make a line shared.
LEAST_CHARS, LEAST_DOCS = 10, 2

_LAST_ID = (1 << 63) - 1


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged; text of ASCII alone takes Spark's own faster function."""
    by_letter = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(by_letter)


def key_of(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _hashes(value: Column, *names: str) -> list[Column]:
    """128 bits of a text as two columns."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def _texts(docs: DataFrame) -> DataFrame:
    """Documents by identifier and the hash of their text."""
    text = arrow.text_column()
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("_id"), *_hashes(text, "_t1", "_t2"),
                       F.split(text, "\n", -1).alias("_lines"))


def shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """All comparable lines by place, and the hashes that enough documents share with the first document of each."""
    lines = _texts(docs).select("_id", "_t1", "_t2", F.posexplode("_lines").alias("_place", "_line"))
    keyed = lines.withColumn("_key", key_of(F.col("_line"))).where(F.char_length("_key") >= least_chars)
    hashed = keyed.select("_id", "_t1", "_t2", "_place", *_hashes(F.col("_key"), "_k1", "_k2"))
    once = hashed.select("_k1", "_k2", "_id").distinct()
    counted = once.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("_docs"), F.min("_id").alias("_first"))
    return hashed, counted.where(F.col("_docs") >= least_docs)


def without_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` of every document."""
    lines, shared = shared_lines(docs, least_chars, least_docs)
    places = lines.join(sized.splittable(shared, "_k1", "_k2"), ["_k1", "_k2"]).where("_id != _first")
    gone = places.groupBy("_id", "_t1", "_t2").agg(F.collect_set("_place").alias("_gone"))
    # the lines are split below the join, so that the look-up of a line by its place does not split them anew
    met = _texts(docs).join(sized.splittable(gone, "_id", "_t1", "_t2"), ["_id", "_t1", "_t2"], "left")
    n = F.size("_lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_gone"))
    cut = F.array_join(F.transform(stay, lambda place: F.col("_lines")[place]), "\n")
    dropped = F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone"))
    return met.select("doc_id", n.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"),
                      F.when(F.col("_gone").isNull(), F.array_join("_lines", "\n")).otherwise(cut).alias("kept_text"))
