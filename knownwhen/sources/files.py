"""Facts about raw files themselves: row counts, headers, how full the columns are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.functions.values import quarter_token


def _lines(spark: SparkSession, glob: str | Sequence[str]) -> DataFrame:
    return spark.read.text(glob if isinstance(glob, str) else list(glob)).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"))


def row_counts(spark: SparkSession, glob: str | Sequence[str]) -> DataFrame:
    """Rows per file: lines without the header, never below zero."""
    return (
        _lines(spark, glob).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))
        .select("file", quarter_token("file").alias("quarter"),
                F.greatest(F.col("lines") - 1, F.lit(0)).alias("rows"))
    )


def manifest(spark: SparkSession, globs: dict[str, str]) -> DataFrame:
    """Per quarter a map from file kind to its number of rows."""
    counted = None
    for kind, glob in globs.items():
        part = row_counts(spark, glob).select("quarter", F.lit(f"{kind}.txt").alias("name"), "rows")
        counted = part if counted is None else counted.unionByName(part)
    per_name = counted.groupBy("quarter", "name").agg(F.sum("rows").alias("rows"))
    # One entry per file kind, so the list has a handful of entries.
    entries = F.array_sort(F.collect_list(F.struct("name", "rows")))
    return per_name.groupBy("quarter").agg(F.map_from_entries(entries).alias("row_counts"))


def headers(spark: SparkSession, glob: str | Sequence[str], sep: str = "\t") -> DataFrame:
    """The column names each file starts with."""
    # Only blocks at offset 0 can hold a header; ids count up within a block.
    first = (
        _lines(spark, glob).where("block_start = 0")
        .withColumn("at", F.monotonically_increasing_id())
        .groupBy("file").agg(F.min_by("value", "at").alias("header"))
    )
    return first.select(
        "file", quarter_token("file").alias("quarter"),
        F.split("header", sep).alias("columns"))


def column_profile(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of rows that hold a value, per column (and per ``by`` group), in one pass."""
    by = by or []
    names = [c for c in rows.columns if c not in by]
    counted = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in names])
    per_column = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in names])
    return (
        counted.select(*by, F.col("_rows").alias("rows"), F.inline(per_column))
        .withColumn("populated", F.try_divide(F.col("filled").cast("double"), F.col("rows")))
    )
