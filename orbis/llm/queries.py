"""Registered queries of this folder's operators, each over its whole table, and
their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.llm import (bpe, centroid_clusters, conversation_repair, exact_dedup, license_scan, line_dedup, packing,
                       quality_classifier, quality_rules, simhash, sql, suffix_dedup, topk_search,
                       url_filter)

TOKENIZER_FILE = "word_bpe_49k.json"
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/")]


def tokenizer_path() -> str:
    """The place of the tokenizer file; operators take it as a parameter."""
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_read(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_read(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_path(), max_length=4096,
                        end_id=2, keep_ids=False)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_read(spark, sf_dir, "documents"),
                                             _read(spark, sf_dir, "labels"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_read(spark, sf_dir, "pages"), URL_RULES)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.suffix_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_read(spark, sf_dir, "documents"), tokenizer_path())


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(F.col("doc_id"), "n_lines", "n_dropped",
                       F.sha2("text", 256).alias("kept_sha256"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversation_repair.damage(rows), rows)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_report(_read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": op1,
    "op2_simhash": op2,
    "op3_license_scan": op3,
    "op4_packing": op4,
    "op5_quality_rules": op5,
    "op6_quality_classifier": op6,
    "op7_url_filter": op7,
    "op8_suffix_dedup": op8,
    "op9_bpe": op9,
    "op10_line_dedup": op10,
    "op11_topk_search": op11,
    "op12_conversation_repair": op12,
    "op13_centroid_clusters": op13,
}

# white space U+0020 and U+0009..U+000D, as DuckDB text
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)""",
    "op10_line_dedup": f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
           FROM documents),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
v AS (SELECT k.doc_id, pos, line, f.first_doc IS NOT NULL AND k.doc_id <> f.first_doc AS dropped
      FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM v GROUP BY doc_id""",
    "op11_topk_search": sql.TOPK_SEARCH,
    "op12_conversation_repair": sql.CONVERSATION_REPAIR,
    "op13_centroid_clusters": sql.CENTROID_CLUSTERS,
}
