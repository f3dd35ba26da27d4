"""The operators' queries, their production parameters and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hydroframe.llm import (exact_dedup, html_tree, iblt_fingerprint, jaccard_join, langid, license_lookup, packing, pfair_mix, pii,
                            prefix_trie, spelling, stratified_shards, toxicity)
from hydroframe.llm.common import documents
from hydroframe.sources.tables import read_table


def op1_iblt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt_fingerprint.fingerprints(documents(spark, sf_dir))


def op2_license_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_lookup.scan_licences(documents(spark, sf_dir))


def op3_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards.stratified_shards(documents(spark, sf_dir))


def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix.pfair_mix(documents(spark, sf_dir))


def op5_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract(read_table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(documents(spark, sf_dir))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_iblt_fingerprint, op2_license_lookup, op3_stratified_shards, op4_pfair_mix, op5_html_tree,
                                    op6_jaccard_join, op7_exact_dedup, op8_best_fit_packing, op9_toxicity,
                                    op10_language_id, op11_prefix_trie, op12_spelling_groups,
                                    op13_personal_data)}


def oracle_sql() -> dict[str, str]:
    return {"op2_license_lookup": license_lookup.oracle(), "op7_exact_dedup": OP7_SQL,
            "op11_prefix_trie": prefix_trie.oracle(), "op12_spelling_groups": spelling.oracle()}
