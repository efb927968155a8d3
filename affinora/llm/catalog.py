"""The queries of this subpackage over the given tables, with their SQL oracle where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from affinora.llm import decontaminate, infill, language, licenses, merkle, minhash, mixing, oracle, passages, pseudolikelihood, rollups, subspace, toxicity, wrappers
from affinora.llm.cut import checkpoint_dir, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudolikelihood.scores(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = rollups.Store(spark, f"{checkpoint_dir(spark)}/rollups-{uuid.uuid4().hex}")
    inserted, recounted, revised, taken = rollups.document_changes(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    for batch, rows in (inserted, revised):
        store.add(batch, rows)
    store.compact(revised[0])
    for batch, rows in (recounted, taken, recounted):  # a late delivery under a smaller name, and a repeated one
        store.add(batch, rows)
    return store.totals()


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.removed(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_html_extract": op3_html_extract,
    "op4_decontaminate": op4_decontaminate,
    "op5_pseudo_likelihood": op5_pseudo_likelihood,
    "op6_language_id": op6_language_id,
    "op7_near_vectors": op7_near_vectors,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_token_rollups": op10_token_rollups,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op1_minhash_dedup": oracle.NEAR_DUPLICATES,
    "op2_mix_sources": oracle.MIX,
    "op4_decontaminate": oracle.CONTAMINATION,
    "op7_near_vectors": oracle.NEAR_VECTORS,
    "op10_token_rollups": oracle.ROLLUPS,
    "op11_fill_in_middle": oracle.INFILL,
    "op12_substring_dedup": oracle.PASSAGES,
    "op13_merkle_manifest": oracle.MERKLE,
}
