"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from culvert.llm import (
    convnet,
    decontamination,
    fair_mix,
    jaccard,
    language,
    licences,
    mixing,
    packing,
    phrases,
    quality,
    token_files,
    tokens,
    urls,
    whitening,
)
from culvert.llm.shared import table
from culvert.session import work_dir


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "quality.*")


VOCABULARY = "byte_bpe_50k.json"


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_tokens(docs, path, tokens.vocabulary(VOCABULARY), end_id=2)
    return token_files.digest(token_files.read_tokens(spark, path))


def op3_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op4_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokens.vocabulary(VOCABULARY), close_id=0)


URL_RULES = [
    urls.Rule("allow", "org/"),
    urls.Rule("block", "example.org/es/"),
    urls.Rule("block", "example.org/en/1"),
    urls.Rule("allow", "com/fr/"),
    urls.Rule("block", "com/de/"),
]


def op5_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity"
    )


def op6_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))


def op8_byte_convnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = convnet.classify(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lists = ("licence_ids", "licences", "licence_rules")
    return found.select(
        "doc_id", *[F.array_join(name, ",").alias(name) for name in lists], "licence_kind"
    )


def op10_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)
    return whitening.per_component(found)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_files": op2_token_files,
    "op3_language_kernel": op3_language_kernel,
    "op4_cost_packing": op4_cost_packing,
    "op5_url_templates": op5_url_templates,
    "op6_positional_index": op6_positional_index,
    "op7_context_mixing": op7_context_mixing,
    "op8_byte_convnet": op8_byte_convnet,
    "op9_licence_scan": op9_licence_scan,
    "op10_token_groups": op10_token_groups,
    "op11_whitening": op11_whitening,
    "op12_phrases": op12_phrases,
    "op13_fair_mix": op13_fair_mix,
}

# All pairs of texts with a common shingle: only for small tables.
CLASSES = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {jaccard.SHINGLE - 1}], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {jaccard.SHINGLE - 2}, least(len(w), 1) + 1))) AS i FROM doc)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM pair JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * c >= {jaccard.PERCENT} * (a.n + b.n - c)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM doc d LEFT JOIN size USING (doc_id)
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) ON x = d.doc_id
"""

ORACLES: dict[str, str] = {
    "op6_positional_index": decontamination.ORACLE,
    "op9_licence_scan": licences.oracle(),
    "op10_token_groups": CLASSES,
    "op12_phrases": phrases.ORACLE,
    "op13_fair_mix": fair_mix.ORACLE,
}
