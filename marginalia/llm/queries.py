"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marginalia.llm import decontamination, language_id, licenses, ngram_lm, packing, pu_quality, quality_rules, simhash, token_counts, url_filters

BPE = public_tokenizers.path("byte_bpe_50k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(_documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), BPE)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), BPE)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(_documents(spark, sf_dir))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(_documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(_documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash": op4_simhash,
    "op5_language_model": op5_language_model,
    "op6_language_id": op6_language_id,
    "op7_license_scan": op7_license_scan,
    "op8_decontamination": op8_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_url_filters": op10_url_filters,
}

_LETTERS = "list_filter(regexp_split_to_array(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

ORACLE_SQL: dict[str, str] = {
    "op8_decontamination": f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_LETTERS.format("text")} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_LETTERS.format("text")} AS w FROM benchmark),
i AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0),
win AS MATERIALIZED (SELECT DISTINCT item, array_to_string(w[s:s + 9], ' ') AS t, len(w[s:s + 9]) AS n FROM i),
lens AS (SELECT DISTINCT n FROM win),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS a FROM d),
occ AS MATERIALIZED (SELECT DISTINCT doc_id, a, lens.n, win.item FROM p, lens, win
  WHERE a + lens.n <= len(w) + 1 AND win.n = lens.n AND win.t = array_to_string(w[a:a + lens.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(a, a + n)) AS q FROM occ) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op10_url_filters": """
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
k AS (SELECT unnest(['casino', 'poker', 'free-bets', 'slot-machine', 'adult', 'xxx', 'porn', 'warez', 'phishing']) AS k),
m AS (SELECT page_id, host, path,
  (SELECT max((length(h || p), h || p, verdict)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best,
  (SELECT count(*) FROM k WHERE regexp_matches(host || path, '(?:^|[^0-9A-Za-z])' || k || '(?:[^0-9A-Za-z]|$)')) + (CASE WHEN regexp_matches(host || path, '(?:^|[./-])malware(?:[./-]|$)') THEN 1 ELSE 0 END) AS n FROM u)
SELECT page_id, host, path, best[2] AS rule, coalesce(best[3], CASE WHEN n > 0 THEN 'block' ELSE 'allow' END) AS verdict, n AS n_patterns FROM m""",
}
