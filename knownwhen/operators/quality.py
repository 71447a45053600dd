"""Contracts on rows: count breaches, or stop on the first one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def breaches_of(rule: Column) -> Column:
    """A rule that is false or unknown is breached."""
    return ~F.coalesce(rule, F.lit(False))


def watch(rows: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Pass every row on and count breaches while the rows are written.

    Nothing that reads its input twice (a range partitioning does, to sample it) may
    follow before the write; :func:`knownwhen.sources.tables.publish` sees to that.
    """
    seen = Observation()
    counts = [F.count_if(breaches_of(rule)).alias(name) for name, rule in rules.items()]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def breach_counts(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: rows looked at, breaches, and the rate; a single pass."""
    counted = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(breaches_of(rule)).alias(f"_{name}") for name, rule in rules.items()])
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_{name}").alias("breaches"))
        for name in rules])
    return (
        counted.select("rows", F.inline(per_rule))
        .withColumn("rate", F.try_divide(F.col("breaches").cast("double"), F.col("rows")))
        .select("rule", "rows", "breaches", "rate")
    )


def enforce(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Abort the job on any breach.

    The check sits in the filter, so it runs for every row whichever columns
    are read later.
    """
    keep = F.lit(True)
    for name, rule in rules.items():
        keep = F.when(breaches_of(rule), F.raise_error(F.lit(f"contract broken: {name}"))
                      .cast("boolean")).otherwise(keep)
    return rows.where(keep)
