"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can say it.

Each query applies its operator to the whole table and derives the columns of its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontam, license_scan, line_dedup, line_frequency, ngram_join, packing, quality, secret_scan,
               spelling, topk, urlfilter, warc)
from .common import load, tokenizer_path


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op3_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(load(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, k=5)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(load(spark, sf_dir, "documents"))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
                        F.sha2(secret_scan.written_out(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.written_out(F.col("spans")).alias("spans"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(load(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(load(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", F.coalesce(F.sha2("payload", 256), "digest").alias("payload_digest"),
                       "record_type", "refers_to")


URL_RULES = [urlfilter.Rule("block", "net", "/"), urlfilter.Rule("allow", "example.net", "/en/"),
             urlfilter.Rule("block", "example.com", "/de/"), urlfilter.Rule("allow", "org", "/fr/")]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    return (urlfilter.judge(pages, urlfilter.spam_list(pages), URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path())


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(load(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.verdicts(load(spark, sf_dir, "documents"))


def op13_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_line_dedup, op3_exact_topk_search, op4_secret_scans, op5_benchmark_decontamination,
                                   op6_ngram_jaccard_join, op7_warc, op8_url_filters, op9_license_scans,
                                   op10_best_fit_packing, op11_cross_tokenizer_alignment, op12_quality_rules,
                                   op13_spelling_variant_grouping)}

ORACLE_SQL = {
    "op3_exact_topk_search": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages),
        f AS (SELECT digest, min(page_id) AS first_id FROM p WHERE strlen(html) >= 100 GROUP BY digest)
        SELECT p.page_id, strlen(html) AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN f.first_id IS NULL OR f.first_id = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
        FROM p LEFT JOIN f USING (digest)""",
    "op8_url_filters": """
        WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
        b AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM a),
        c AS (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www[.]', '') AS plain,
                     list_has_any([regexp_extract(x, '^(spam-farm|casino|cheap-pills|free-bets|adult-x|ads-track)')
                                   FOR x IN string_split(host, '.')],
                                  ['spam-farm', 'casino', 'cheap-pills', 'free-bets', 'adult-x', 'ads-track']) AS spam
              FROM b),
        d AS (SELECT *, CASE WHEN plain = '' THEN '' ELSE plain || regexp_replace(path, '/+$', '') END AS canonical FROM c),
        e AS (SELECT *, CASE
                WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM d)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN canonical <> '' AND canonical IN (SELECT canonical FROM d WHERE spam) THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM e""",
    "op12_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text FROM documents),
        w AS (SELECT id, [x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM d),
        e AS (SELECT id, unnest(words) AS a, generate_subscripts(words, 1) AS pos FROM w),
        t AS (SELECT *, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM e WINDOW p AS (PARTITION BY id ORDER BY pos)),
        r AS (SELECT id, pos, count(*) OVER (PARTITION BY id, a, b, c) AS times FROM t WHERE c IS NOT NULL),
        m AS (SELECT DISTINCT id, pos + k AS pos FROM r, range(3) AS x(k) WHERE times > 1),
        n AS (SELECT id, count(*) AS n_repeat_words FROM m GROUP BY id),
        l AS (SELECT id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
        k AS (SELECT *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
                                                      'abcdefghijklmnopqrstuvwxyz000000000'),
                                            '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS key,
                     length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
              FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        f AS (SELECT source, key, count(DISTINCT text) AS held FROM k GROUP BY source, key),
        h AS (SELECT source, count(DISTINCT text) AS texts FROM d GROUP BY source),
        g AS (SELECT f.source, f.key FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source
              WHERE held > 20 AND held > 0.01 * texts),
        s AS (SELECT k.id, count(*) AS n_lines, count(*) - count(DISTINCT k.line) AS n_dup_lines,
                     count(*) FILTER (g.key IS NOT NULL) AS n_removed,
                     coalesce(sum(chars) FILTER (g.key IS NOT NULL), 0)::BIGINT AS chars_removed
              FROM k LEFT JOIN g ON k.key = g.key AND k.source IS NOT DISTINCT FROM g.source GROUP BY k.id),
        x AS (SELECT d.doc_id, len(w.words) AS n_words, length(array_to_string(w.words, '')) AS word_chars,
                     length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS n_symbols,
                     coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                     coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
                     coalesce(chars_removed, 0) AS chars_removed
              FROM d JOIN w USING (id) LEFT JOIN s USING (id) LEFT JOIN n USING (id))
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND chars_removed <= 0.5 * word_chars AS kept
        FROM x""",
    "op2_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT doc_id, pos, line,
                   translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        repeated AS (
            SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        marked AS (
            SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone
            FROM keyed k LEFT JOIN repeated r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
