"""Small helpers that several operators share on the driver: tables and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.sources.shared import settle


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, few: bool = False, outlive: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, in not many more files than there
    are cores. ``few``: the rows are few for the work that they take, so they are dealt anew
    after it, and the work keeps its own tasks."""
    cores = max(2, df.sparkSession.sparkContext.defaultParallelism)
    return settle(df.repartition(cores) if few else df.coalesce(2 * cores), label, outlive)


def bounded_batches(spark: SparkSession, size: str = "8m", rows: int = 2000) -> None:
    """From now on this session hands Python small batches: a batch is held by the executor and
    by its Python worker at once, outside the heap, and grows by doubling."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text); whatever other columns there are can't clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
