"""Empty tables, nulls, repeated rows, ties and columns named like results, for url filters and language."""

from __future__ import annotations

from tidehouse.llm import language, url_filters

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, host string, rule string, keys string, best string"


def test_urls(spark):
    rules = spark.createDataFrame([("a.com", "/", "block"), ("com", "/xyzv", "allow")], RULES)
    rows = [(1, "http://a.com/xyzv", "h", "r", "k", "b"), (1, "http://a.com/xyzv", "h", "r", "k", "b"),
            (None, "http://a.com/q", None, None, None, None), (3, None, "h", "r", "k", "b"), (4, "http://" + "b." * 300 + "com/xyzv", "", "", "", "")]
    pages = spark.createDataFrame(rows, PAGES)
    got = sorted(((r.page_id, r.rule, r.verdict) for r in url_filters.url_verdicts(pages, rules).collect()), key=str)
    assert got == [(1, "com/xyzv", "allow")] * 2 + [(3, None, "allow"), (4, "com/xyzv", "allow"), (None, "a.com/", "block")]
    # Keys of one length: the greater text wins.
    tie = spark.createDataFrame([("a.com", "/", "block"), ("com", "/xy", "allow")], RULES)
    assert {r.rule for r in url_filters.url_verdicts(pages.where("page_id = 1"), tie).collect()} == {"com/xy"}
    assert url_filters.url_verdicts(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filters.url_verdicts(pages, rules.limit(0)).collect()} == {"allow"}


def test_language(spark):
    schema = "doc_id long, text string, lang string, lang_pred string, score double, _text string"
    rows = [(i, "abab abba " * 9 if i % 2 else "xyxy yxxy " * 9, "ab" if i % 2 else "xy", "no", 7.0, "no") for i in range(40)]
    odd = [(None, "abba baab", "xy", "no", 7.0, "no"), (90, None, "ab", "no", 7.0, "no"), (91, "12 ...", None, "no", 7.0, "no"),
           (92, "", None, "no", 7.0, "no"), (92, "", None, "no", 7.0, "no"), (93, "y", None, "no", 7.0, "no"), (94, "x" * 300_001, None, "no", 7.0, "no")]
    docs = spark.createDataFrame(rows + odd, schema)
    model = language.train(docs, steps=40)
    found = [(r.doc_id, r.lang_pred) for r in language.languages_of(docs, model, ["doc_id"]).collect()]
    assert len(found) == 47 and found.count((92, "und")) == 2
    assert {(None, "ab"), (90, "und"), (91, "und"), (93, "xy"), (94, "xy")} | {(r[0], r[2]) for r in rows} <= set(found)
    assert language.languages_of(docs.limit(0), model, ["doc_id"]).count() == 0
