"""From raw documents to packed training sequences.

``STAGES`` are applied in order; each is written as Parquet and read again before the next. Every
stage works on all that its predecessor kept, and all but the last return the columns of documents:

1. quality: documents that the Kneser-Ney classifier rejects go;
2. near_duplicates: each SimHash class keeps the document with its least id;
3. decontamination: documents that leak a benchmark item go;
4. secrets: found secrets are replaced by a mark, and ``n_chars`` follows; no document goes;
5. packing: token pieces in fixed-length sequences, with their ids (little-endian 16 bits) and digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import decontaminate, kneser_ney, packing, secret_scan, simhash
from salesmart.llm.common import ship, stored, table
from salesmart.session import ensure_checkpoint_dir, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship(spark)
    return kneser_ney.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ledger = scratch_path(spark, "secret-ledger")
    secret_scan.update(docs, ledger)
    return secret_scan.redact(docs, ledger, length_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship(spark)
    return packing.pack(docs, with_ids=True).withColumnRenamed("ids", "token_ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", pack)]

#: Tokens, fingerprints and the language model have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
