"""Registered queries over the text tables and their oracle SQL (DuckDB)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspan.llm import (alignment, centroids, decontam, html_text, license_scan, oracle, packing, quality, secret_scan,
                          sharding, simhash, token_count, url_filter, warc)
from tickspan.llm.common import read, shared_path


def op1_license_scan(spark, sf_dir):
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return token_count.token_counts(read(spark, sf_dir, "documents"), model="piece_bpe_32k.model", limit=4096)


def op3_url_filter(spark, sf_dir):
    return url_filter.judged(read(spark, sf_dir, "pages"))


def op4_simhash_neardup(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)


def op5_packing(spark, sf_dir):
    out = packing.pack(read(spark, sf_dir, "documents"), model="word_bpe_49k.json", end_id=1, length=2048)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "round")


def op6_quality_rules(spark, sf_dir):
    return quality.judged(read(spark, sf_dir, "documents")).drop("_key")


def op7_secret_scan(spark, sf_dir):
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("_keys")


def op9_warc(spark, sf_dir):
    """Every page written to archives in the shared folder and read back; a gap there is an error."""
    path = shared_path(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path, least=0)
    records = warc.intact(warc.read(spark, path, with_payload=False))
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), warc.page_of(F.col("refers_to_id")).alias("refers_to"))


def op10_html_text(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages"))


def op11_centroids(spark, sf_dir):
    return centroids.clusters(read(spark, sf_dir, "embeddings"))


def op12_sharding(spark, sf_dir):
    return sharding.shards(read(spark, sf_dir, "documents"), n=8)


def op13_alignment(spark, sf_dir):
    return alignment.align(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_token_counts": op2_token_counts,
    "op3_url_filter": op3_url_filter,
    "op4_simhash_neardup": op4_simhash_neardup,
    "op5_packing": op5_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_scan": op7_secret_scan,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_html_text": op10_html_text,
    "op11_centroids": op11_centroids,
    "op12_sharding": op12_sharding,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": oracle.LICENSES,
    "op3_url_filter": oracle.URL_FILTER,
    "op6_quality_rules": oracle.QUALITY,
    "op8_decontamination": oracle.DECONTAMINATION,
    "op11_centroids": oracle.CENTROIDS,
    "op12_sharding": oracle.SHARDING,
}
