"""Search text to keyword lists."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Unicode blocks of scripts written without spaces (CJK ideographs, kana, Hangul syllables).
_CJK = r"一-鿿぀-ヿ가-힯"
# A run holds letters of any script with their marks, and digits.
_TOKEN = rf"[{_CJK}]+|(?:(?![{_CJK}])[\p{{L}}\p{{M}}\p{{N}}])+"

# Full-width forms of the printable ASCII characters, by rule: U+FF01..U+FF5E map to U+0021..U+007E.
_WIDE = "".join(chr(code) for code in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F))


def normalize(text: Column | str) -> Column:
    """Full-width characters to their plain form, then lower case."""
    text = F.col(text) if isinstance(text, str) else text
    return F.lower(F.translate(text, _WIDE, _NARROW))


def runs(text: Column | str) -> Column:
    """Runs of letters and digits, and runs of CJK characters, in text order."""
    return F.regexp_extract_all(normalize(text), F.lit(_TOKEN), F.lit(0))


def _pieces(run: Column) -> Column:
    # A CJK run has no word boundaries: cut it into overlapping pairs (a run of one character is kept).
    pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda at: F.substring(run, at, F.lit(2)))
    return F.when(~run.rlike(f"^[{_CJK}]") | (F.length(run) < 2), F.array(run)).otherwise(pairs)


def keywords(text: Column | str) -> Column:
    """Keyword list of a text; order and repeats are kept."""
    return F.flatten(F.transform(runs(text), _pieces))


def register_sql(spark: SparkSession, name: str = "keywords_of") -> None:
    """Make keyword lists available to SQL as a table function with one column ``word``:

    ``SELECT keyword, row_time FROM search_table, LATERAL keywords_of(full_word) AS t(keyword)``

    It is a SQL function over built-ins, so the query stays in the JVM.
    """
    def literal(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    found = f"regexp_extract_all(lower(translate(text, {literal(_WIDE)}, {literal(_NARROW)})), {literal(_TOKEN)}, 0)"
    pieces = ("transform(" + found + ", run -> CASE WHEN NOT run RLIKE " + literal(f"^[{_CJK}]") + " OR length(run) < 2 THEN array(run) "
              "ELSE transform(sequence(1, length(run) - 1), at -> substring(run, at, 2)) END)")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE(word STRING) "
              f"RETURN SELECT explode(flatten({pieces}))")
