"""Small helpers shared by the operators: stored intermediates and partition counts."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    The written table cuts the lineage with files that outlive any executor, and its size on
    disk lets the optimiser decide by a measured figure whether a later join may broadcast it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs, under fixed names; a null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


_SHIPPED: set[str] = set()
#: Rows of whole texts that a Python worker is handed at once, unless the session says otherwise.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application, and texts in small
    batches: a worker and its executor each hold a batch going in and one coming out."""
    context = spark.sparkContext
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        name = os.path.join(tempfile.mkdtemp(prefix="salesmart-code-"), "salesmart")
        context.addPyFile(shutil.make_archive(name, "zip", root, "salesmart"))
        _SHIPPED.add(context.applicationId)
