"""The named queries of this subpackage over the tables of a folder, and the same results in SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from dialogeval.llm import (
    decontaminate,
    fingerprints,
    htmlcut,
    jaccard,
    licenses,
    manifest,
    minhash,
    mixing,
    periodic,
    secrets,
    substrings,
    toxicity,
    warc,
)
from dialogeval.llm.oracle import ORACLES  # noqa: F401


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints_with_edits(_table(spark, folder, "documents"))


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    linked = jaccard.jaccard_components(_table(spark, folder, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id")


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    def said(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(spans)

    cut = substrings.dedup_substrings(_table(spark, folder, "documents"))
    return cut.select("doc_id", "text", "n_chars", "n_removed", said("removed"), said("kept"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, folder, "labels")))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(_table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return htmlcut.extract(_table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    # Some texts are made periodic from a word on, as their ids say.
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = _table(spark, folder, "documents").select("doc_id", "text", F.floor(h / 10).alias("g"), (h % 10 == 0).alias("planted"))
    words = F.when(F.col("planted"), F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)))
    docs = docs.withColumn("words", words).withColumn("n", F.size("words"))
    docs = docs.withColumn("begin", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = 1 + F.floor((F.col("n") - F.col("begin")) / (3 + F.col("g") % 8)).cast("bigint")
    repeated = F.transform(
        "words", lambda w, i: F.when(i < F.col("begin"), w).otherwise(F.get("words", (F.col("begin") + (i - F.col("begin")) % period).cast("int")))
    )
    text = F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    rows = periodic.periodic_runs(docs.select("doc_id", text.alias("text")))
    best, line = F.col("best"), lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = manifest.manifest(_table(spark, folder, "documents"), tampered)
    digest = manifest.proof_digest(F.col("proof")).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", digest, "folded_root", "verified")


def op13_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    placed = minhash.minhash_components(_table(spark, folder, "documents"))
    return placed.select("doc_id", "n_shingles", "component_id", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_mix_sources": op5_mix_sources,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_secret_scan": op8_secret_scan,
    "op9_warc": op9_warc,
    "op10_html_extraction": op10_html_extraction,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_minhash_dedup": op13_minhash_dedup,
    "pipeline": corpus_pipeline.run,
}
