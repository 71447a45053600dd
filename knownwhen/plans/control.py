"""One row per quarter to fetch, and how far each got."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.operators.upsert import apply_updates, insert_missing
from knownwhen.sources.schemas import CONTROL

KEY = ["quarter"]
ERROR_LENGTH = 900


def as_control(rows: DataFrame) -> DataFrame:
    """Rows with any subset of the control columns, completed and typed."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(
            f.name, metadata=f.metadata)
        for f in CONTROL.fields])


def offer(links: DataFrame, discovered_at: str) -> DataFrame:
    """Newly discovered quarters, waiting."""
    return as_control(links.select(
        "quarter", "zip_url", F.lit("PENDING").alias("status"), F.lit(0).alias("attempts"),
        F.lit(discovered_at).alias("discovered_at")))


def merge_discovered(control: DataFrame, offered: DataFrame) -> DataFrame:
    """Re-running discovery never resets a known quarter."""
    return insert_missing(control, offered, KEY)


def start(control: DataFrame, quarters: DataFrame) -> DataFrame:
    """Mark quarters as running; finished ones are left alone."""
    open_ones = quarters.join(control.where("status <> 'DONE'").select(*KEY), KEY, "left_semi")
    return apply_updates(control, open_ones, KEY, {
        "status": "'RUNNING'", "attempts": "coalesce(old.attempts, 0) + 1"})


def finish(control: DataFrame, done: DataFrame) -> DataFrame:
    """``done``: quarter, bytes_downloaded, files_extracted, row_counts, completed_at."""
    return apply_updates(control, done, KEY, {
        "status": "'DONE'", "last_error": "CAST(NULL AS STRING)",
        **{c: f"new.{c}" for c in
           ("bytes_downloaded", "files_extracted", "row_counts", "completed_at")}})


def fail(control: DataFrame, failed: DataFrame) -> DataFrame:
    """``failed``: quarter, error. Quotes are dropped and the text is kept short."""
    return apply_updates(control, failed, KEY, {
        "status": "'FAILED'",
        "last_error": f"substring(replace(new.error, \"'\", ''), 1, {ERROR_LENGTH})"})


def status_counts(control: DataFrame) -> DataFrame:
    return control.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def pending(control: DataFrame) -> DataFrame:
    return control.where("status <> 'DONE'").select(*KEY, "status").orderBy(*KEY)
