"""The registered queries: each reads its whole table, calls its operator with production
parameters and returns the columns of the operator's contract first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (bpe_replay, decontaminate, filter_audit, kneser_ney, license_scan, packing, pii, repetition,
                           secret_scan, simhash, spans, subvector_kmeans, token_store, warc)
from salesmart.llm.common import ship, stored, table
from salesmart.session import scratch_path


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives, read back and assembled: one row per capture."""
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    records = stored(warc.read(spark, path, payloads=False), "warc-records")
    page_id = F.get(F.filter(F.flatten(F.transform("metadata", lambda m: m["fields"])),
                             lambda f: f["key"] == "page-id"), F.lit(0))["value"].cast("long")
    captures = stored(warc.assemble(records).select(
        page_id.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.warc_type").alias("record_type"),
        F.col("response.target_uri").alias("target_uri"), F.col("response.http_status").alias("http_status"),
        F.size("requests").alias("n_requests"), F.size("metadata").alias("n_metadata")), "warc-captures")
    revisit = F.col("record_type") == "revisit"
    answers = (captures.where(~revisit).groupBy(F.col("payload_digest").alias("digest"))
               .agg(F.min("page_id").alias("refers_to")))
    first = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    rest = [c for c in captures.columns if c not in first]
    plain = captures.where(~revisit).withColumn("refers_to", F.lit(None).cast("long"))
    repeats = captures.where(revisit).join(answers, F.col("payload_digest") == F.col("digest"), "left")
    return plain.select(*first, *rest).union(repeats.select(*first, *rest))


def op2_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens",
        "sequence_cost")


def op3_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places and labels of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document leaks."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-perplexity, threshold and verdict of every document."""
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_perfect_hash_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shards written in key order and read back through their indexes."""
    path = scratch_path(spark, "token-shards")
    token_store.write(table(spark, sf_dir, "documents"), path)
    return token_store.read_digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "copy", "shard")


def _digest(base: Column) -> Column:
    return F.sha2(spans.as_text(base), 256)


def _n(items: Column, kind: str) -> Column:
    return F.size(F.filter(items, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a new ledger."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    base = F.filter("findings", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *(_n(base, k) for k in kinds), _digest(spans.ordered(base)).alias("base_sha256"),
                        spans.as_text(spans.ordered("findings")).alias("spans"), F.lower(F.hex("blob")).alias("blob"))


def op8_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.extract(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(_n(F.col("base"), k) for k in pii.KINDS), _digest(F.col("base")).alias("base_sha256"),
                        spans.as_text(F.col("spans")).alias("spans"))


def op10_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and repetition counts and verdict of every document."""
    return repetition.repetition(table(spark, sf_dir, "documents"))


def op11_subvector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector."""
    return subvector_kmeans.cluster(table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter does at each step of every order, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of what they decode to."""
    return bpe_replay.round_trip(table(spark, sf_dir, "documents"))


_ALL = (op1_warc_transactions, op2_cost_packing, op3_license_index, op4_edit_decontamination,
        op5_kneser_ney_quality, op6_perfect_hash_store, op7_secret_ledger, op8_golay_simhash, op9_contextual_pii,
        op10_repetition_coverage, op11_subvector_clusters, op12_filter_audit, op13_merge_replay)


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {fn.__name__: _shipped(fn) for fn in _ALL}
