"""Raw files read by what their own header says.

A file's columns are matched with the layout by name. A file that has every required column,
each once, is read whatever the order of its columns; layout columns that it lacks are NULL,
and columns that the layout lacks are kept, row by row, as JSON in the rescue column. A line
with a field too many or too few keeps its text there, as usual. Any other file is not
read; it is listed with the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knownwhen.functions.values import first_match, quarter_token
from knownwhen.sources import delimited, files
from knownwhen.sources.schemas import REQUIRED, RESCUED, raw_columns

AS_DECLARED, BY_NAME, QUARANTINE = "as_declared", "by_name", "quarantine"
# Different headers that one read may meet; files written by one program have few.
MAX_HEADERS = 200
_BOM = "﻿"


def routes(spark: SparkSession, glob: str | Sequence[str], kind: str) -> DataFrame:
    """(file, quarter, columns, route, reason): how each file is to be read, by its first line."""
    declared = F.array(*[F.lit(c) for c in raw_columns(kind)])
    required = F.array(*[F.lit(c) for c in REQUIRED[kind]])
    head = F.transform("columns", lambda c: F.trim(F.replace(c, F.lit(_BOM), F.lit(""))))
    found = files.headers(spark, glob).withColumn("columns", head)
    missing = F.array_except(required, F.col("columns"))
    reason = first_match({
        "repeated_column": F.size(F.array_distinct("columns")) < F.size("columns"),
        "missing_column": F.size(missing) > 0,
        "blank_column": F.array_contains("columns", "")})
    return found.withColumn("reason", reason).withColumn("route", first_match({
        QUARANTINE: F.col("reason").isNotNull(),
        AS_DECLARED: F.col("columns") == declared}, BY_NAME)).select(
        "file", "quarter", "columns", "route", "reason")


def read_by_header(spark: SparkSession, glob: str | Sequence[str], kind: str) -> DataFrame:
    """The rows of all files that fit, in layout columns. One reader per header that occurs."""
    found = routes(spark, glob, kind).where(F.col("route") != QUARANTINE)
    # Names of files and headers, of which a read has as many as files.
    groups = found.groupBy("columns").agg(F.collect_list("file").alias("files")).limit(
        MAX_HEADERS + 1).collect()
    if len(groups) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers in {glob}")
    out = _no_rows(spark, kind)
    for group in groups:
        out = out.unionByName(_read(spark, group["columns"], sorted(group["files"]), kind))
    return out


def _read(spark: SparkSession, columns: list[str], paths: list[str], kind: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RESCUED]])
    rows = spark.read.format("csv").options(**delimited.OPTIONS).schema(schema).load(paths)
    rows = delimited.with_provenance(rows)
    known = raw_columns(kind)
    extra = [c for c in columns if c not in known]
    aside: Column = F.lit(None).cast("string")
    if extra:
        aside = F.when(F.coalesce(*extra).isNotNull(), F.to_json(F.struct(*extra)))
    return rows.select(
        *[F.col(c) if c in columns else F.lit(None).cast("string").alias(c) for c in known],
        F.coalesce(RESCUED, aside).alias(RESCUED), "_ingested_at", "_source_file", "quarter")


def _no_rows(spark: SparkSession, kind: str) -> DataFrame:
    text = ", ".join(f"`{c}` string" for c in [*raw_columns(kind), RESCUED])
    return spark.createDataFrame(
        [], f"{text}, _ingested_at timestamp, _source_file string, quarter string")


def not_read(spark: SparkSession, glob: str | Sequence[str], kind: str) -> DataFrame:
    """(file, quarter, columns, reason, rows): the files that don't fit, with their rows."""
    bad = routes(spark, glob, kind).where(F.col("route") == QUARANTINE)
    counts = files.row_counts(spark, glob).select("file", "rows")
    return bad.join(counts, "file").select(
        "file", quarter_token("file").alias("quarter"), "columns", "reason", "rows")
