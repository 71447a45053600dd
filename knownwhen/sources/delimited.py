"""Tab-separated raw files, as a batch or as a stream.

One folder per quarter; everything is read as text and nothing is altered.
Lines that do not have the declared number of fields keep their text in the
rescue column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.functions.values import quarter_token
from knownwhen.sources.schemas import RESCUED, raw_columns, raw_schema

LAYOUT = "{root}/quarter=*/{kind}.txt"

# Quoting and escaping are off: a stray quote in a label is part of the label.
# Column pruning in the parser is off because a pruned parser cannot tell that
# a line has the wrong number of fields.
OPTIONS = {
    "sep": "\t", "header": "true", "quote": "", "escape": "", "multiLine": "false",
    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED, "columnPruning": "false",
}


def with_provenance(raw: DataFrame) -> DataFrame:
    return raw.select(
        "*", F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        quarter_token("_metadata.file_path").alias("quarter"),
    )


def read_raw(spark: SparkSession, root: str, kind: str, layout: str = LAYOUT) -> DataFrame:
    reader = spark.read.format("csv").options(**OPTIONS).schema(raw_schema(kind))
    return with_provenance(reader.load(layout.format(root=root, kind=kind)))


def stream_raw(spark: SparkSession, root: str, kind: str, layout: str = LAYOUT) -> DataFrame:
    """The same rows as :func:`read_raw`, each file delivered once per checkpoint."""
    reader = spark.readStream.format("csv").options(**OPTIONS).schema(raw_schema(kind))
    return with_provenance(reader.load(layout.format(root=root, kind=kind)))


def write_raw(rows: DataFrame, root: str, kind: str) -> str:
    """Write text rows with a ``quarter`` column as raw files; returns their layout.

    Spark names its own part files, so the kind becomes a folder above the
    quarters instead of a file name below them.
    """
    (rows.select(*raw_columns(kind), "quarter").write.partitionBy("quarter")
     .options(sep="\t", header="true", quote="", escape="", emptyValue="", nullValue="",
              ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
     .csv(f"{root}/{kind}"))
    return "{root}/{kind}/quarter=*"
