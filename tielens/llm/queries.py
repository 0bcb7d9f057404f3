"""Queries of this package's operators over the driver tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_text, jaccard_join, packing, ppm, quality, quotient_dedup, token_counts, token_files, tokens, url_filter

#: Hosts whose pages make up the list of blocked URLs of op1.
JUNK_HOSTS = r"(^|\.)(spam-farm|cheap-pills)\."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    listed = pages.filter(host.rlike(JUNK_HOSTS)).select(url_filter.canonical(host, path).alias("canonical"))
    return url_filter.judge(pages, listed)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.default_path())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.through_files(table(spark, sf_dir, "documents"), tokens.default_path())


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient_dedup.find_copies(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokens.default_path())


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (op1_url_filter, op2_quality, op3_packing, op4_decontamination, op5_token_files, op6_lm_score, op7_exact_dedup, op8_jaccard_join, op9_token_counts, op10_html_text)
}

_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"


def _rule_case(column: str) -> str:
    whens = []
    for said, rule in sorted(url_filter.RULES, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        whens.append(f"WHEN {_FITS.format(h=name, p=slash + rest)} THEN '{rule if column == 'rule' else said}'")
    return f"CASE {' '.join(whens)} END"


ORACLE_SQL = {
    "op1_url_filter": rf"""
WITH parts AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
named AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(?:www|m)\.', '') || regexp_replace(path, '(?:\.html|/)+$', '') END AS canonical,
    {_rule_case("rule")} AS rule, {_rule_case("said")} AS said FROM parts),
judged AS (SELECT *, said IS NULL AS free FROM named),
listed AS (SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, '(^|\.)(spam-farm|cheap-pills)\.') AND canonical IS NOT NULL)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict, l.canonical IS NOT NULL AS listed
FROM judged j LEFT JOIN listed l ON j.canonical = l.canonical""",
    "op7_exact_dedup": r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha FROM documents),
r AS (SELECT *, count(*) OVER (PARTITION BY sha) AS group_size,
    first_value(doc_id) OVER (PARTITION BY sha ORDER BY chars DESC, doc_id) AS keep_id,
    row_number() OVER (PARTITION BY sha ORDER BY chars DESC, doc_id) = 1 AS kept FROM n)
SELECT doc_id, keep_id, group_size, kept, sha AS text_sha256 FROM r""",
}
