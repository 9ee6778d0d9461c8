"""The registered queries of the text operators and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (alignment, bpe, embedding_dedup, exact_dedup, html_text, importance, language_id, line_dedup, packing, simhash,
                           url_filter, warc, wavelet)
from ledgerloom.llm.common import text_of

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs, ~language_id.held_out())
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "__lang.lang_pred", "__lang.score",
                        "__lang.rejected")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_recurring_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", F.col("__text").alias("text"), F.char_length("__text").cast("long").alias("n_chars"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(text_of("text"), 256))
    return exact_dedup.refine_duplicates(docs, carry=["text_sha256"])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(_table(spark, sf_dir, "documents"))


def op8_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.store_and_read(_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: Fixed values of the contract: the rules that the pages are judged by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", *[F.col(f"__{c}").alias(c) for c in ("host", "path", "rule", "verdict")])


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_html_text": op4_html_text,
    "op5_warc": op5_warc,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_bpe": op7_bpe,
    "op8_wavelet_shards": op8_wavelet_shards,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
    "op11_importance": op11_importance,
    "op12_url_filter": op12_url_filter,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_dedup": """
        WITH RECURSIVE pairs AS MATERIALIZED (
            SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
            AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9),
        reach AS (
            SELECT vec_id AS x, vec_id AS y FROM embeddings
            UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x)
        LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM pairs GROUP BY x) USING (vec_id)
    """,
    "op3_line_dedup": r"""
        WITH parts AS MATERIALIZED (
            SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
        numbered AS MATERIALIZED (
            SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM parts),
        lines AS MATERIALIZED (
            SELECT doc_id, line_no, string_split_regex(regexp_replace(
                trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                '[^ \t\x0b\f\r]*[0-9][^ \t\x0b\f\r]*', '<*>', 'g'), '[ \t\x0b\f\r]+') AS words,
                string_split_regex(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[ \t\x0b\f\r]+') AS whole
            FROM numbered),
        worded AS MATERIALIZED (SELECT *, len(words) AS n, words[1] AS w1, coalesce(words[2], '') AS w2 FROM lines WHERE words[1] <> ''),
        short AS MATERIALIZED (SELECT words, n, w1, w2, count(*) AS c FROM worded WHERE n <= 50 GROUP BY ALL),
        different AS MATERIALIZED (
            SELECT * FROM short WHERE (n, w1, w2) IN (
                SELECT (n, w1, w2) FROM short GROUP BY n, w1, w2 HAVING count(*) >= 2 AND sum(c) >= 10)),
        placed AS MATERIALIZED (
            SELECT words, n, w1, w2, c, unnest(words) AS word, unnest(range(n)) AS place FROM different),
        frequent AS MATERIALIZED (
            SELECT *, row_number() OVER () * 64 + place AS id FROM (
                SELECT n, w1, w2, place, word, sum(c) AS seen FROM placed WHERE place >= 2 GROUP BY ALL HAVING sum(c) >= 10)),
        found AS MATERIALIZED (
            SELECT words, any_value(n) AS n, any_value(w1) AS w1, any_value(w2) AS w2, any_value(c) AS c, count(*)::INT AS size,
                   list(id ORDER BY seen DESC, place) AS by_count, list(id ORDER BY place) AS by_place, row_number() OVER () AS line
            FROM placed JOIN frequent USING (n, w1, w2, place, word) GROUP BY words HAVING count(*) + 2 >= any_value(n) * 0.7),
        tops AS MATERIALIZED (
            SELECT line, n, c, list_sort(by_count[1:k]) AS mask
            FROM (SELECT *, unnest(range(greatest(1, ceil(n * 0.7 - 1e-9)::INT - 2), size + 1)) AS k FROM found)),
        buts AS MATERIALIZED (
            SELECT line, n, c, list_sort(list_concat(by_place[1:i - 1], by_place[i + w:size])) AS mask
            FROM (SELECT *, unnest(range(1, size - w + 2)) AS i FROM found, (VALUES (1), (2), (3)) t(w) WHERE size >= w)),
        masks AS MATERIALIZED (
            SELECT DISTINCT line, c, mask FROM (FROM tops UNION ALL FROM buts) WHERE len(mask) + 2 < n AND len(mask) + 2 >= n * 0.7),
        shared AS MATERIALIZED (
            SELECT mask, row_number() OVER () AS family FROM masks GROUP BY mask HAVING count(*) > 1 AND sum(c) >= 10),
        general AS MATERIALIZED (SELECT line, family, mask FROM masks JOIN shared USING (mask)),
        seen_in AS MATERIALIZED (SELECT DISTINCT line, doc_id FROM worded JOIN found USING (words)),
        counted AS MATERIALIZED (
            SELECT family, count(DISTINCT doc_id) AS docs FROM general JOIN seen_in USING (line)
            GROUP BY family HAVING count(DISTINCT doc_id) >= 10),
        chosen AS MATERIALIZED (
            SELECT line, arg_max(family, (docs, len(mask), list_sum(list_transform(mask, lambda x: 2 ** (x % 64))))) AS template
            FROM general JOIN counted USING (family) GROUP BY line),
        covered AS MATERIALIZED (SELECT words, template FROM chosen JOIN found USING (line)),
        named AS MATERIALIZED (
            SELECT doc_id, line_no, {'general': template, 'line': CASE WHEN template IS NULL THEN worded.words END,
                                     'whole': NULL::VARCHAR[]} AS template, CASE WHEN template IS NULL THEN 10 ELSE 1 END AS enough
            FROM worded LEFT JOIN covered USING (words)
            UNION ALL
            SELECT doc_id, line_no, {'general': NULL, 'line': words, 'whole': whole}, 2 FROM worded WHERE n > 50),
        recurring AS MATERIALIZED (
            SELECT template, min((doc_id, line_no)) AS first_place
            FROM named GROUP BY template, enough HAVING count(DISTINCT doc_id) >= enough),
        dropped AS MATERIALIZED (
            SELECT doc_id, list(DISTINCT line_no) AS places FROM named JOIN recurring USING (template)
            WHERE (doc_id, line_no) <> first_place GROUP BY doc_id)
        SELECT doc_id, CASE WHEN places IS NULL THEN text ELSE array_to_string(list_transform(
                   list_filter(range(len(parts)), lambda i: NOT list_contains(places, i)),
                   lambda i: parts[i + 1]), chr(10)) END AS text,
               coalesce(len(parts), 0)::INT AS n_lines, coalesce(len(places), 0)::INT AS n_dropped
        FROM documents JOIN parts USING (doc_id) LEFT JOIN dropped USING (doc_id)
    """,
    "op5_warc": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest FROM pages),
        firsts AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                           ELSE page_id END AS first_id FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM firsts
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_url_filter": r"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
            ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        placed AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*') END AS raw,
                   CASE WHEN contains(url, '://')
                        THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END AS path
            FROM pages),
        hosts AS (
            SELECT page_id, coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(path, '') AS path FROM placed),
        fitting AS (
            SELECT host, path, arg_max(rule_host || rule_path, (length(rule_host || rule_path), length(rule_host))) AS rule,
                   arg_max(rule_verdict, (length(rule_host || rule_path), length(rule_host))) AS verdict
            FROM (SELECT DISTINCT host, path FROM hosts) JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY host, path)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hosts LEFT JOIN fitting USING (host, path)
    """,
}
