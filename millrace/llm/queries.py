"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, divergence, fim, langid, licenses, line_dedup, minhash, mixing, packing, quality_rules, simhash, tokens, warc
from millrace.llm.base import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL"]

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LEDGER_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents
), g AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), f AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1
), p AS (
  SELECT r, count(DISTINCT i + k) AS n FROM f, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), l AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS li FROM d
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(li) - len(list_distinct(li)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(li)::BIGINT AS n_lines
  FROM d JOIN l USING (r) LEFT JOIN p USING (r)
), b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits
  FROM m
)
"""

QUALITY_SQL = f"""
{LEDGER_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  (fail_bits & 63) = 0 AS kept, n_lines, fail_bits, (fail_bits & 3) = 0 AS kept_base, (fail_bits & 63) = 0 AS kept_v1,
  (fail_bits & 123) = 0 AS kept_v2_strict
FROM b
"""

ABLATION_SQL = f"""
{LEDGER_SQL}, r AS (
  SELECT * FROM (VALUES ('few_words', 1), ('repeated_windows', 2), ('many_symbols', 4), ('repeated_lines', 8),
    ('short_words', 16), ('long_words', 32), ('any_symbols', 64)) AS t(rule, bit)
), v AS (
  SELECT * FROM (VALUES ('base', 3), ('v1', 63), ('v2_strict', 123)) AS t(version, bits)
)
SELECT version, rule, count(*)::BIGINT AS n_docs, count_if(fail_bits & bits <> 0)::BIGINT AS n_rejected,
  count_if(fail_bits & bit <> 0)::BIGINT AS n_failed, count_if(fail_bits & bits = bit)::BIGINT AS n_alone,
  count_if(fail_bits & (bits - bit) = 0)::BIGINT AS kept_without
FROM b, r, v WHERE bits & bit <> 0 GROUP BY version, rule
"""


@query("op4_quality_rules", QUALITY_SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements and failure bits, and the verdicts of all policies, from the stored ledger."""
    entries = quality_rules.store(spark, table(spark, sf_dir, "documents"))
    return quality_rules.verdicts(quality_rules.apply_policy(entries)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "fail_bits",
        *[f"kept_{p.version}" for p in quality_rules.POLICIES],
    )


@query("quality_rules_ablation", ABLATION_SQL)
def quality_rules_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every policy would keep without each of its rules, over the whole table."""
    return quality_rules.ablation(quality_rules.store(spark, table(spark, sf_dir, "documents")))


MIX_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS_SQL})::BIGINT AS size, md5(concat_ws('|', doc_id::VARCHAR, text)) AS h FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s
), w AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][k % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap,
    [[3.0::DOUBLE, 2.0, 1.0], [1.0, 1.0, 1.0], [1.0, 2.0, 4.0]][k % 3 + 1] AS g
  FROM r
), o AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own
  FROM w
), v AS (
  SELECT *, (SELECT own FROM o WHERE own * weight < cap ORDER BY cap / weight, k LIMIT 1) AS level FROM o
), t AS (
  SELECT *, CASE WHEN level IS NULL THEN cap ELSE least(level * weight, cap) END AS target FROM v
), b AS (
  SELECT d.*, t.source_size, target, g,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN t.source_size > 0 THEN floor(target / t.source_size) ELSE 0 END AS passes
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, (passes + CASE WHEN passes < 2 AND 2 * before + size <= 2 * (target - passes * source_size) THEN 1 ELSE 0 END)::INTEGER
      AS copies,
    CASE WHEN target > 0 THEN least((before + size / 2.0::DOUBLE) / target, 1.0::DOUBLE) ELSE 0 END AS share,
    (g[1] + g[2]) / 2 * 0.5::DOUBLE AS a, (g[2] + g[3]) / 2 * 0.5::DOUBLE AS z
  FROM b
), q AS (
  SELECT *, share * (a + z) AS wanted FROM c
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, (size * copies)::BIGINT AS taken, copies,
  CASE WHEN copies = 0 THEN NULL
    WHEN wanted <= a THEN CASE WHEN wanted > 0 THEN
      2 * wanted / (g[1] + sqrt(g[1] * g[1] + 2 * ((g[2] - g[1]) / 0.5::DOUBLE) * wanted)) ELSE 0 END
    ELSE CASE WHEN wanted - a > 0 THEN 0.5::DOUBLE
      + 2 * (wanted - a) / (g[2] + sqrt(g[2] * g[2] + 2 * ((g[3] - g[2]) / 0.5::DOUBLE) * (wanted - a))) ELSE 0.5 END
  END AS position
FROM q
"""


@query("op10_mixing", MIX_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the production curriculum takes of every document, in the order of first positions."""
    return mixing.account(spark, table(spark, sf_dir, "documents"))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(spark, docs, learn=~langid.held_out())
    return langid.predict(spark, docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near duplicates, on sets of four-word shingles."""
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"), minhash.Settings(words=4))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes, counted in tokens."""
    return packing.pack_table(spark, table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokens.count_tokens(spark, table(spark, sf_dir, "documents"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p
), d AS (
  SELECT *, list_transform(range(40), lambda i: instr('0123456789abcdef', h[i + 1]) - 1) AS x FROM m
)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((x[(5 * i) // 4 + 1] * 16 + x[(5 * i) // 4 + 2]) >> (3 - (5 * i) % 4)) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM d
"""


@query("op6_warc", WARC_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the archives."""
    manifest = warc.write(spark, table(spark, sf_dir, "pages"))
    return warc.read(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


CHAT_SQL = """
WITH b AS (
  SELECT conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT *, coalesce(sum(length(body) + 8) OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, body
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS said_before, sum(length(body) + 8) OVER (PARTITION BY conv_id) AS total FROM b
), t AS (
  SELECT conv_id, (CASE WHEN total > 1048576 THEN said_before // 1048576 ELSE 0 END)::BIGINT AS part, turn, role, body FROM l
), s AS (
  SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role IS NOT NULL AND role <> 'system'
), j AS (
  SELECT t.*, speaker, CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
      WHEN role IS NULL THEN '<|user|>' ELSE '<|user name=' || replace(role, '<|', '< |') || '|>' END || chr(10) AS head,
    body || '<|end|>' || chr(10) AS said, coalesce(role = speaker, FALSE) AS own
  FROM t LEFT JOIN s USING (conv_id)
), o AS (
  SELECT *, row_number() OVER w AS k, sum(length(head) + length(said)) OVER w AS upto
  FROM j WINDOW w AS (PARTITION BY conv_id, part, speaker ORDER BY turn NULLS LAST, role NULLS FIRST, body
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, part, speaker, count(*)::INTEGER AS n_turns, string_agg(head || said, '' ORDER BY k) AS rendered,
  coalesce(string_agg(CASE WHEN own THEN (upto - length(said))::VARCHAR || '-' || (upto - 1)::VARCHAR END, ',' ORDER BY k), '') AS spans
FROM o GROUP BY conv_id, part, speaker
"""


@query("op9_chat", CHAT_SQL)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the side of each speaker; spans as text."""
    rows = chat.rotate(table(spark, sf_dir, "conversations"))
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.withColumn("spans", joined)


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text's and its neighbour's."""
    return simhash.compare_edited(spark, table(spark, sf_dir, "documents"))


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice found in a document."""
    return licenses.scan(spark, table(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), u AS (
  SELECT r, doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM u
), c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT r, k.doc_id, line, i, last IS NOT NULL AND k.doc_id <> last AS gone FROM k LEFT JOIN c USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


@query("op11_line_dedup", LINES_SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the lines that three documents or more share."""
    docs = table(spark, sf_dir, "documents")
    left = line_dedup.apply(docs, line_dedup.bitmaps(spark, docs))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


FIM_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents
), r AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), c AS (
  SELECT *, CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j FROM r
), p AS (
  SELECT *, array_to_string(u[1:i], '') AS pre, array_to_string(u[i + 1:j], '') AS mid, array_to_string(u[j + 1:n], '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


@query("op12_fill_in_middle", FIM_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-the-middle form, and the text rebuilt from it."""
    rows = fim.transform(spark, table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), v AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT lang, source, coalesce(total, 0)::HUGEINT AS total, coalesce(v, 0)::HUGEINT AS v, coalesce(lang_total, 0)::HUGEINT AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)
    LEFT JOIN v USING (lang)
), m AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v))::HUGEINT AS p,
    (1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v))::HUGEINT AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM m WHERE n > 0 AND p > q
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 200
"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source is from the others of its language, and the terms that set it apart."""
    found = divergence.audit(spark, table(spark, sf_dir, "documents"))
    return found.select("lang", "source", "part", "item", "value", "rank")
