"""Keywords of search texts and their windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidehouse.functions import textfns, timefns
from tidehouse import sized

# Fixed value: source name of keywords that were typed into the search box.
SEARCH = "SEARCH"


def explode_tokens(df: DataFrame, text: str = "full_word", name: str = "keyword",
                   dictionary: DataFrame | None = None) -> DataFrame:
    """One row per keyword of a text column, repeats included; the other columns are kept, the text is not.

    With a ``dictionary`` (one column of words) only its words count; it is broadcast when small enough.
    """
    words = df.select(F.explode(textfns.keywords(text)).alias(name), *[c for c in df.columns if c != text])
    if dictionary is None:
        return words
    known = dictionary.select(F.lower(F.col(dictionary.columns[0])).alias(name)).distinct()
    return words.join(sized.small_side(known), name, "left_semi")


def keyword_window(words: DataFrame, width: str = "10 seconds", source: str = SEARCH, tz: str = timefns.DEFAULT_TZ,
                   emit_time: bool = True) -> DataFrame:
    """Count of every keyword per tumbling window over ``row_time`` (on a stream with its watermark set)."""
    counted = words.groupBy(F.window("row_time", width).alias("window"), "keyword").agg(
        F.count(F.lit(1)).alias("keyword_count"))
    emit = [timefns.emit_time_ms().alias("ts")] if emit_time else []
    return counted.select(*timefns.window_bounds("window", tz), F.lit(source).alias("source"), "keyword",
                          "keyword_count", *emit)
