"""How often rules were broken, run by run, and whether that has changed.

A run is whatever ``run_col`` says: a delivery, a quarter, a batch; its values are in order of
time. Counting is one pass with partial sums, and all that follows works on the ledger, which
has a row per run and rule however many rows were counted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.operators.quality import breaches_of
from knownwhen.operators.upsert import insert_missing
from knownwhen.sources import tables

LEDGER = "run string, rule string, rows bigint, breaches bigint"
#: Chi-square of two rates, one degree of freedom, that one in a thousand steady runs exceeds.
CHI_SQUARE = 10.83
#: With very many rows any difference is certain: it also has to be this much of the earlier rate.
LEAST_CHANGE = 0.25


def run_counts(rows: DataFrame, rules: Mapping[str, Column], run_col: str) -> DataFrame:
    """(run, rule, rows, breaches): every run of ``rows`` under every rule. Rows of no run
    (NULL) are the run ''."""
    run = F.coalesce(F.col(run_col).cast("string"), F.lit(""))
    counted = rows.select(run.alias("run"), *[
        breaches_of(rule).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    ).groupBy("run").agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(f"_{i}").alias(f"_{i}") for i in range(len(rules))])
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("breaches"))
        for i, name in enumerate(rules)])
    return counted.select("run", "rows", F.inline(per_rule)).select(
        "run", "rule", "rows", "breaches")


def record(counts: DataFrame, root: str) -> int:
    """Append runs to the ledger under ``root``; what is recorded stays as it is, so a run that
    is repeated changes nothing. Returns the ledger's version."""
    spark = counts.sparkSession
    schema = spark.createDataFrame([], LEDGER).schema
    tables.create_if_absent(spark, root, "quality_run", schema)
    return tables.update(spark, root, "quality_run",
                         lambda known: insert_missing(known, counts, ["run", "rule"]))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_published(spark, root, "quality_run")


def _differ(rows: Column, broken: Column, rows_b: Column, broken_b: Column) -> Column:
    """Chi-square of two counts of breaches; 0 where neither or all rows are broken."""
    rows, broken, rows_b, broken_b = (c.cast("double") for c in (rows, broken, rows_b, broken_b))
    apart = broken * rows_b - broken_b * rows
    both, all_rows = broken + broken_b, rows + rows_b
    spread = rows * rows_b * both * (all_rows - both)
    return F.coalesce(F.try_divide(apart * apart * all_rows, spread), F.lit(0.0))


def _rate(broken: Column, rows: Column) -> Column:
    return F.try_divide(broken.cast("double"), rows.cast("double"))


def _changed(chi: Column, rate: Column, before: Column, level: float, least: float) -> Column:
    return F.coalesce((chi >= level) & (F.abs(rate - before) >= before * least), F.lit(False))


def jumps(runs: DataFrame, level: float = CHI_SQUARE, least: float = LEAST_CHANGE) -> DataFrame:
    """Every run and rule with its rate against that of all earlier runs together; the first
    run of a rule has none and is no jump."""
    earlier = Window.partitionBy("rule").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    seen = runs.withColumns({
        "_rows": F.sum("rows").over(earlier), "_breaches": F.sum("breaches").over(earlier)})
    chi = _differ(F.col("rows"), F.col("breaches"), F.col("_rows"), F.col("_breaches"))
    rated = seen.select(
        "run", "rule", "rows", "breaches", _rate(F.col("breaches"), F.col("rows")).alias("rate"),
        _rate(F.col("_breaches"), F.col("_rows")).alias("earlier_rate"),
        F.when(F.col("_rows").isNotNull(), chi).alias("chi_square"))
    return rated.withColumn("jumped", _changed(
        F.col("chi_square"), F.col("rate"), F.col("earlier_rate"), level, least))


def change_points(runs: DataFrame, level: float = CHI_SQUARE, least: float = LEAST_CHANGE
                  ) -> DataFrame:
    """Per rule with at least two runs: the run from which on its rate differs most from that
    before (of equals the first), both rates, and if that counts as a change. A change that a
    single run doesn't show, because it lasts, does so here."""
    before = Window.partitionBy("rule").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy("rule").orderBy("run").rowsBetween(0, Window.unboundedFollowing)
    sides = runs.select("run", "rule", *[
        F.sum(c).over(w).alias(f"{c}_{side}")
        for side, w in (("before", before), ("after", onward)) for c in ("rows", "breaches")])
    split = sides.where("rows_before IS NOT NULL").select(
        "rule", "run", _differ(*[F.col(c) for c in (
            "rows_after", "breaches_after", "rows_before", "breaches_before")]).alias("chi_square"),
        _rate(F.col("breaches_before"), F.col("rows_before")).alias("rate_before"),
        _rate(F.col("breaches_after"), F.col("rows_after")).alias("rate_after"))
    first = Window.partitionBy("rule").orderBy(F.desc("chi_square"), "run")
    best = split.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    return best.withColumn("changed", _changed(
        F.col("chi_square"), F.col("rate_after"), F.col("rate_before"), level, least))
