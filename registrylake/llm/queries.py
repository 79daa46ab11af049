"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from registrylake.llm import (
    decontamination,
    filter_audit,
    fixity,
    minhash,
    mixing,
    passages,
    pii,
    quality_classifier,
    quality_rules,
    token_alignment,
    token_counts,
    topk,
    url_rules,
)
from registrylake.tables.work import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.remove_passages(docs).drop("removed")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(docs, path).drop("text")


def op4_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a second replica in which some pages were changed and some lost.

    The hash of a page's url tells which, one in 16 each; every record of the first replica
    gets its place and what the audit says of it. The second replica is made of the places of
    the first, so repeated pages and pages without id or url keep theirs.
    """
    pages = _table(spark, sf_dir, "pages")
    fate = F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 1)
    html = F.when(fate == "0", F.translate("html", "e", "c")).otherwise(F.col("html"))
    changed = fixity.warc_record(F.col("page_id"), F.col("url"), html)
    pages = pages.select("page_id", "url", "html", F.sha2(changed, 256).alias("then"), fate.alias("fate"))
    laid = staged(fixity.laid_out(fixity.hashed(pages, "then", "fate")))
    first = laid.drop("then", "fate")
    second = laid.where("fate != '1'").withColumn("digest", F.col("then")).drop("then", "fate")
    found = fixity.audit(first, second)
    return (
        first.join(found, ["file", "offset"], "left")
        .select("page_id", "file", "offset", "length", "digest", F.coalesce("status", F.lit("intact")).alias("status"))
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs).drop("text")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.classify(docs, _table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # Nearly equal sources, two and a half times the corpus: whole passes and a part of one.
    mixture = mixing.Mixture(entropy=0.9999, repeats=4.0, budget=2.5)
    return mixing.mix(docs, mixture).select("doc_id", "source", "n_tokens", "weight", "copies")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    items = _table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontamination.mark_contaminated(docs, items).drop("text")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    patterns = [*url_rules.PATTERNS, *url_rules.listed_patterns()]
    judged = url_rules.judge_urls(pages, url_rules.rule_table(spark, patterns=patterns))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = quality_rules.with_text_stats(docs).drop("text")
    voted = staged(quality_rules.with_votes(counted))
    judged = quality_rules.judge(voted, quality_rules.fit(voted))
    return judged.select("doc_id", *quality_rules.STATS, "base_failed", "kept", "quality")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align(docs, *paths)


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash": op1_minhash,
        "op2_passages": op2_passages,
        "op3_token_counts": op3_token_counts,
        "op4_fixity": op4_fixity,
        "op5_pii": op5_pii,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_mixing": op7_mixing,
        "op8_decontamination": op8_decontamination,
        "op9_url_rules": op9_url_rules,
        "op10_quality_rules": op10_quality_rules,
        "op11_alignment": op11_alignment,
        "op12_topk": op12_topk,
        "op13_filter_audit": op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }


def _url_rule_sql() -> str:
    rows = [(r, v, url_rules.site_regex(r), len(r)) for v, r in url_rules.SITE_RULES]
    rows += [
        (r, v, url_rules.pattern_regex(r), -1 if v == url_rules.BLOCK else -2)
        for v, r in [*url_rules.PATTERNS, *url_rules.listed_patterns()]
    ]
    return ", ".join(f"('{r}', '{v}', '{x}', {n})" for r, v, x, n in rows)


#: DuckDB: lower-cases A-Z only.
_LOWER = """translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash": rf"""
            WITH RECURSIVE words AS (
              SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w
              FROM documents),
            shingles AS (
              SELECT DISTINCT doc_id,
                     array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s,
                     least(5, len(w)) AS n
              FROM words, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i)
              WHERE len(w) > 0),
            sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
            common AS (
              SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
              FROM shingles x JOIN shingles y ON x.s = y.s AND x.n = y.n AND x.doc_id <> y.doc_id
              GROUP BY ALL),
            links AS (
              SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
              WHERE 100 * c >= 85 * (p.n + q.n - c)),
            reach AS (
              SELECT doc_id, doc_id AS other FROM documents
              UNION
              SELECT doc_id, b FROM reach JOIN links ON other = a)
            SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id,
                   doc_id = min(other) AS kept
            FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
        "op8_decontamination": rf"""
            WITH docs AS (
              SELECT doc_id,
                     regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
              FROM documents),
            items AS (
              SELECT item_id,
                     regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
              FROM benchmark),
            windows AS (
              SELECT DISTINCT item_id, least(10, len(w)) AS n,
                     array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
              FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i)
              WHERE len(w) > 0),
            found AS (
              SELECT doc_id, i, d.n, item_id
              FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
                    FROM docs, (SELECT DISTINCT n FROM windows),
                         unnest(range(1, len(w) - n + 2)) AS t(i)) d
              JOIN windows USING (s, n)),
            hits AS (
              SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
            named AS (
              SELECT doc_id, count(*) AS n_items,
                     string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found)
              GROUP BY doc_id)
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
                   coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
                   n_hit IS NOT NULL AS contaminated
            FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
        "op7_mixing": r"""
            WITH RECURSIVE docs AS (
              SELECT doc_id, source, coalesce('=' || source, '') AS src,
                     CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)
                       AS n_tokens,
                     md5('mix-1|' || doc_id) AS h
              FROM documents),
            sources AS (
              SELECT src, sum(n_tokens) AS tokens, sum(n_tokens) / sum(sum(n_tokens)) OVER () AS p
              FROM docs GROUP BY src HAVING sum(n_tokens) > 0),
            step AS (
              SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi,
                     CAST(0 AS DOUBLE) AS lo2, CAST(1 AS DOUBLE) AS hi2
              UNION ALL
              SELECT i + 1,
                     CASE WHEN entropy < 0.9999 * ln(n) THEN lo ELSE (lo + hi) / 2 END,
                     CASE WHEN entropy < 0.9999 * ln(n) THEN (lo + hi) / 2 ELSE hi END,
                     CASE WHEN 2.5 * most <= 4 THEN lo2 ELSE (lo2 + hi2) / 2 END,
                     CASE WHEN 2.5 * most <= 4 THEN (lo2 + hi2) / 2 ELSE hi2 END
              FROM (
                SELECT i, lo, hi, lo2, hi2, count(*) AS n,
                       ln(sum(pow(p, (lo + hi) / 2)))
                         - sum(pow(p, (lo + hi) / 2) * (lo + hi) / 2 * ln(p))
                           / sum(pow(p, (lo + hi) / 2)) AS entropy,
                       max(pow(p, (lo2 + hi2) / 2) / p) / sum(pow(p, (lo2 + hi2) / 2)) AS most
                FROM step, sources WHERE i < 36 GROUP BY ALL)),
            found AS (SELECT round(greatest(hi, CASE WHEN hi2 < 1e-9 THEN 0 ELSE hi2 END), 9) AS x
                      FROM step WHERE i = 36),
            quotas AS (
              SELECT src, tokens, weight, quota, quota // tokens AS passes, quota % tokens AS rest
              FROM (SELECT src, tokens, weight,
                           CAST(round(weight * (2.5 * total)) AS BIGINT) AS quota
                    FROM (SELECT src, tokens, pow(p, x) / sum(pow(p, x)) OVER () AS weight,
                                 sum(tokens) OVER () AS total FROM sources, found))),
            ranked AS (
              SELECT d.*, weight, passes, rest, substr(h, 1, 3) AS block,
                     md5('mix-1|' || CAST(CAST(passes + 1 AS BIGINT) AS VARCHAR) || '|' || d.src
                         || '|' || substr(h, 1, 3)) AS rank
              FROM docs d LEFT JOIN quotas q ON d.src = q.src),
            running AS (
              SELECT *, sum(n_tokens) OVER (PARTITION BY src ORDER BY rank, block, h) AS upto,
                     sum(n_tokens) OVER (PARTITION BY src ORDER BY rank, block) AS block_upto
              FROM ranked),
            cuts AS (
              SELECT src, min((rank, block)) AS cut FROM running WHERE block_upto > rest GROUP BY src)
            SELECT doc_id, source, n_tokens, coalesce(weight, 0) AS weight,
                   CAST(CASE WHEN n_tokens = 0 THEN 1
                        ELSE passes + CASE WHEN (rank, block) < cut THEN 1
                                           WHEN (rank, block) = cut AND upto <= rest THEN 1
                                           ELSE 0 END END AS BIGINT) AS copies
            FROM running LEFT JOIN cuts USING (src)""",
        "op9_url_rules": rf"""
            WITH cut AS (
              SELECT page_id, CASE WHEN instr(url, '://') > 0
                              THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail
              FROM pages),
            located AS (
              SELECT page_id,
                     translate(regexp_extract(tail, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
              FROM cut),
            rules(rule, verdict, regex, size) AS (VALUES {_url_rule_sql()}),
            best AS (
              SELECT page_id, arg_max(rule, size) AS rule, max(size) AS size,
                     arg_max(r.verdict, size) AS verdict
              FROM located JOIN rules r ON regexp_matches(host || path, regex)
              WHERE host || path <> '' GROUP BY page_id)
            SELECT page_id, host, path, CASE WHEN size > 0 THEN rule END AS rule,
                   coalesce(verdict, 'allow') AS verdict
            FROM located LEFT JOIN best USING (page_id)""",
        "op4_fixity": r"""
            WITH sized AS (
              SELECT page_id, url, html,
                     'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
                       || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
                       || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
                       || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
                       || octet_length(encode(html)) || chr(13) || chr(10) || chr(13) || chr(10)
                       || html || chr(13) || chr(10) || chr(13) || chr(10) AS record,
                     CASE WHEN (SELECT count(*) FROM pages) <= 16 * 2048 THEN 1 ELSE 2 END AS digits
              FROM pages),
            named AS (
              SELECT *, CAST('0x' || substr(md5(page_id || '|' || url || '|' || sha256(record)), 1, digits)
                          AS BIGINT) AS file,
                     CAST(octet_length(encode(record)) AS BIGINT) AS length,
                     sha256(record) AS digest, substr(md5(url), 1, 1) AS fate
              FROM sized)
            SELECT page_id, file, length, digest,
                   CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, url
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
                   CASE WHEN fate = '1' THEN 'lost'
                        WHEN fate = '0' AND html LIKE '%e%' THEN 'damaged'
                        ELSE 'intact' END AS status
            FROM named""",
        "op2_passages": r"""
            WITH hexed AS (
              SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
            pieces AS (
              SELECT doc_id, c, substr(h, 2 * c + 1, 2 * (128 + 49)) AS p
              FROM hexed, unnest(range(0, len(h) // 2 - 49, 128)) AS t(c)),
            windows AS (
              SELECT doc_id, c + i AS i, substr(p, 2 * i + 1, 100) AS s
              FROM pieces, unnest(range(0, len(p) // 2 - 49)) AS t(i)),
            covered AS (
              SELECT doc_id, i
              FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows)
              WHERE first < doc_id),
            grouped AS (
              SELECT doc_id, i, sum(CASE WHEN i > prev + 50 THEN 1 ELSE 0 END)
                       OVER (PARTITION BY doc_id ORDER BY i) AS g
              FROM (SELECT doc_id, i,
                           coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i) AS prev
                    FROM covered)),
            spans AS (
              SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM grouped GROUP BY doc_id, g),
            gaps AS (
              SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z,
                     b
              FROM spans),
            cut AS (
              SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
                     string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head,
                     max(b) AS tail
              FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id)
            SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
                   coalesce(n_spans, 0) AS n_spans,
                   sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1)))
                     AS kept_sha256
            FROM hexed LEFT JOIN cut USING (doc_id)""",
        "op12_topk": r"""
            WITH v AS (
              SELECT row_number() OVER () AS i, vec_id,
                     [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS v
              FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len([x for x in embedding if isfinite(x)]) = len(embedding)),
            scored AS (
              SELECT q.i, q.vec_id AS query_id, c.vec_id AS vec_id,
                     CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
              FROM v q JOIN v c ON q.i <> c.i AND len(q.v) = len(c.v)
              WHERE q.vec_id % 100 = 0)
            SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS r
                  FROM scored)
            WHERE r <= 10""",
        "op13_filter_audit": r"""
            WITH words AS (
              SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
              FROM documents),
            known AS (
              SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                     max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
              FROM labels GROUP BY doc_id),
            masks AS (
              SELECT doc_id, part,
                     CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
                     + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
                     + CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text)
                            THEN 4 ELSE 0 END
                     + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                     + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
              FROM words),
            cells AS (
              SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good,
                     coalesce(sum(toxic), 0) AS toxic
              FROM masks LEFT JOIN known USING (doc_id) GROUP BY part, mask),
            letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
            orders AS (
              SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                     [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
              FROM letters a JOIN letters b ON b.bit <> a.bit
              JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
              JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit)
              JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
            steps AS (
              SELECT filter_order, step, bits[step] AS bit,
                     CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS applied
              FROM orders, unnest(range(1, 6)) AS t(step)),
            counted AS (
              SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
                     CAST(coalesce(sum(n) FILTER (mask & (applied | bit) = 0), 0) AS BIGINT) AS kept,
                     CAST(coalesce(sum(n) FILTER (mask & applied = 0 AND mask & bit <> 0), 0) AS BIGINT)
                       AS removed,
                     CAST(coalesce(sum(n) FILTER (mask & applied <> 0 AND mask & bit <> 0), 0) AS BIGINT)
                       AS redundant,
                     CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
                     CAST(coalesce(sum(good) FILTER (mask & applied = 0 AND mask & bit <> 0), 0) AS BIGINT)
                       AS good_lost,
                     CAST(coalesce(sum(toxic) FILTER (mask & applied = 0 AND mask & bit <> 0), 0) AS BIGINT)
                       AS toxic_lost
              FROM cells, steps GROUP BY ALL)
            SELECT * EXCLUDE (bit),
                   CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
            FROM counted""",
    }
