"""The registered queries of the operators; where SQL can state the result on whole tables, it stands beside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidehouse import session
from tidehouse.llm import (
    chat, conversation_repair, decontaminate, exact_copies, language, line_copies, manifest, near_copies, packing,
    passages, token_counts, token_files, url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@query
def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(_table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


@query
def op4_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.exact_copies(_table(spark, sf_dir, "documents"), keep="largest")


SQL["op4_exact_copies"] = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""


#: The rules of the query: host, start of the path, verdict (fixed values).
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.url_verdicts(_table(spark, sf_dir, "pages"), rules)


SQL["op5_url_filters"] = r"""
WITH rules(rule_host, rule_path, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM cut),
fits AS (SELECT *, rule_host || rule_path AS rule FROM parsed LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(v, length(rule)), 'allow') AS verdict
FROM fits GROUP BY page_id, host, path
"""


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    parts = turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content"))
    return chat.digests(chat.format_conversations(parts))


SQL["op6_chat"] = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '</?s>|\[/?INST\]|\[/?ROLE\]|\[(OUT|SEP|IMAGE|AUDIO|DOCUMENT)\]')) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(chars + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 18 + length(role) END))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.languages_of(docs, language.train(docs), ["doc_id"])
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), language.held_out(F.col("doc_id")).alias("held_out"),
                        "lang_pred", "score")


@query
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = passages.without_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL["op8_passages"] = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS w
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM words WHERE len(ws) >= 20)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
placed AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM words),
kept AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS t
    FROM placed LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    longest = F.array_max(F.transform("matches", lambda m: m["n_words"]))
    return found.withColumn("longest_match", F.coalesce(longest, F.lit(0).cast("long"))).drop("matches")


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.shared_dir(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder)
    return token_files.read_token_files(spark, folder)


@query
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    is_hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(is_hit, line_copies.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    proofs = manifest.manifest(manifest.document_leaves(docs, text=tampered), "lang", "doc_id", "leaf", ["claimed"])
    folded = proofs.withColumn("folded_root", manifest.fold(F.col("claimed"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _crc32_sql(numbers: str, name: str, most: int) -> str:
    """Common table expressions that give crc32 of the decimal texts of ``numbers`` (query with a column ``v``)."""
    return f"""crc_bytes AS (SELECT range AS b, range AS c, 0 AS k FROM range(256) UNION ALL
        SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bytes WHERE k < 8),
    crc_table AS (SELECT b, c AS x FROM crc_bytes WHERE k = 8),
    crc_steps AS (SELECT v, v::VARCHAR AS t, 0 AS i, 4294967295 AS c FROM (SELECT DISTINCT v FROM ({numbers})) UNION ALL
        SELECT v, t, i + 1, xor(x, c >> 8) FROM crc_steps JOIN crc_table ON b = xor(c, ascii(substr(t, i + 1, 1))) & 255
        WHERE i < length(t) AND i < {most}),
    {name} AS (SELECT v, xor(c, 4294967295) AS crc FROM crc_steps WHERE i = length(t))"""


_FRAMED = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"

SQL["op11_manifest"] = f"""
WITH RECURSIVE {_crc32_sql("SELECT doc_id AS v FROM documents", "crcs", 30)},
leaves AS (SELECT doc_id, lang, sha256({" || ".join(_FRAMED.format(c) for c in manifest.DOCUMENT)}) AS leaf,
    sha256({" || ".join(_FRAMED.format(c) for c in manifest.DOCUMENT[:4])} || {_FRAMED.format(
        "(CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END)")}) AS claimed
    FROM documents LEFT JOIN crcs ON v = doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (SELECT lang, 0 AS l, r, n, leaf AS node FROM ranked UNION ALL
    SELECT lang, l + 1, r // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY r)) FROM nodes WHERE n > 1
    GROUP BY lang, l, r // 8, n),
tops AS (SELECT lang, l AS h, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r,
    count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (SELECT 0 AS l, r, n, subroot AS node FROM tops UNION ALL
    SELECT l + 1, r // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY r)) FROM upper WHERE n > 1 GROUP BY l, r // 8, n),
beside AS (SELECT lang, l, r, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z
    FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY lang, l, r // 8 ORDER BY r)),
above AS (SELECT l, r, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z
    FROM upper WHERE n > 1 WINDOW run AS (PARTITION BY l, r // 8 ORDER BY r)),
steps AS (SELECT ranked.lang, ranked.r, l, a, z FROM ranked JOIN beside
    ON beside.lang IS NOT DISTINCT FROM ranked.lang AND beside.r = ranked.r // (8 ** l)::BIGINT
    UNION ALL SELECT ranked.lang, ranked.r, h + l, a, z FROM ranked JOIN tops ON tops.lang IS NOT DISTINCT FROM ranked.lang
    JOIN above ON above.r = tops.r // (8 ** l)::BIGINT),
folds AS (SELECT lang, r, 0 AS l, claimed AS node FROM ranked UNION ALL
    SELECT f.lang, f.r, f.l + 1, sha256(a || node || z) FROM folds f JOIN steps s
    ON s.lang IS NOT DISTINCT FROM f.lang AND s.r = f.r AND s.l = f.l),
proofs AS (SELECT lang, r, string_agg(a || z, '' ORDER BY l) AS siblings, count(*) AS depth FROM steps GROUP BY lang, r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM ranked JOIN tops ON tops.lang IS NOT DISTINCT FROM ranked.lang CROSS JOIN (SELECT node AS root FROM upper WHERE n = 1)
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM ranked.lang AND p.r = ranked.r
JOIN folds f ON f.lang IS NOT DISTINCT FROM ranked.lang AND f.r = ranked.r AND f.l = coalesce(depth, 0)
"""


@query
def op12_line_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_copies.without_shared_lines(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL["op12_line_copies"] = """
WITH lines AS (SELECT doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT keyed.*, first IS NOT NULL AND doc_id != first AS gone FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    fixed = conversation_repair.repair(conversation_repair.damaged(rows))
    found = fixed.summary.join(conversation_repair.row_digests(fixed.rows).withColumnRenamed("conv_id", "_c"),
                               F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    found = found.withColumnRenamed("conv_id", "_c")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    whole = every.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    return whole.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


SQL["op13_conversation_repair"] = f"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS v FROM conversations),
{_crc32_sql("SELECT v FROM given", "crcs", 60)},
damaged AS (SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
    CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE crc % 20 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM given JOIN crcs USING (v) WHERE crc % 20 != 0),
placed AS (SELECT *, left(role, 1) AS i, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER own AS p, lag(left(role, 1)) OVER own AS i_before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
    FROM damaged WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
inserts(st, mid, ops, c, made) AS (VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
    (0, 2, 'I', 5, ['user:']), (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 2, 'I', 5, ['user:']),
    (1, 3, 'II', 10, ['user:', 'assistant:']), (2, 3, 'I', 5, ['assistant:']), (3, 2, 'I', 5, ['user:'])),
edits(mid, op, role_i, nx) AS (VALUES (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
    (0, 'R', NULL, 2), (1, 'R', NULL, 2), (3, 'R', NULL, 2), (2, 'R', NULL, 3),
    (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3)),
best AS (SELECT conv_id, 0 AS p, 0 AS st, {{'cost': 0, 'audit': '', 'made': []::VARCHAR[]}} AS b FROM (SELECT DISTINCT conv_id FROM judged)
    UNION ALL SELECT best.conv_id, best.p + 1, nx, min({{
        'cost': b.cost + inserts.c + CASE op WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
            + CASE WHEN op != 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
        'audit': b.audit || ops || op,
        'made': b.made || inserts.made::VARCHAR[] || CASE op WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
            ELSE [CASE nx WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] END}})
    FROM best JOIN judged j ON j.conv_id IS NOT DISTINCT FROM best.conv_id AND j.p = best.p + 1
    JOIN inserts USING (st) JOIN edits USING (mid)
    WHERE (op = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (role_i IS NULL OR role_i = j.i)
    GROUP BY best.conv_id, best.p, nx),
sums AS (SELECT conv_id, max(p) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (p > 1 AND i_before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ends AS (SELECT best.conv_id, min({{'cost': b.cost + c, 'audit': b.audit || ops, 'made': b.made || inserts.made::VARCHAR[]}}) AS e
    FROM best JOIN sums ON sums.conv_id IS NOT DISTINCT FROM best.conv_id AND best.p = n JOIN inserts USING (st)
    WHERE mid IN (0, 3) GROUP BY best.conv_id)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
    coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM every.conv_id
"""
