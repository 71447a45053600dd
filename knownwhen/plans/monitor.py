"""Reports read by people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.functions.values import rounded


def coverage_by_quarter(facts: DataFrame) -> DataFrame:
    """Filings and facts per quarter.

    Facts are counted per filing first, so a busy quarter is spread over its filings.
    """
    per_filing = facts.groupBy("quarter", "adsh").agg(F.count(F.lit(1)).alias("_n"))
    return per_filing.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("filings"), F.sum("_n").alias("facts")).orderBy("quarter")


def fact_explorer(pit: DataFrame, concept: str, qtrs: int, cik: int | None = None) -> DataFrame:
    """Everything ever believed about one concept, of one company or of each."""
    chosen = (F.col("canonical_tag") == concept) & (F.col("qtrs") == qtrs)
    if cik is not None:
        chosen = chosen & (F.col("cik") == cik)
    return pit.where(chosen).select(
        "cik", "ddate", "value", "known_from_ts", "known_to_ts", "revision_seq", "change_class",
        rounded(F.col("pct_change") * 100, 2).alias("pct"),
    ).orderBy("cik", "ddate", "known_from_ts")


def restatement_monitor(revisions: DataFrame, companies: DataFrame, above: float,
                        top: int = 200) -> DataFrame:
    """The largest restatements of figures above ``above``, with the company's name today.

    ``companies`` has (cik, company). Only the chosen rows are joined to the names; equal
    changes are ordered by key.
    """
    rank = [F.abs("pct_change").desc(), "cik", "canonical_tag", "ddate", "qtrs", "uom",
            "revised_at_ts"]
    largest = revisions.where(F.abs("prev_value") > above).orderBy(*rank).limit(top)
    return largest.join(companies, "cik", "left").orderBy(*rank).select(
        "company", "canonical_tag", "ddate", "qtrs", "prev_value", "revised_value",
        rounded(F.col("pct_change") * 100, 1).alias("pct_change"), "revised_at_ts",
        "source_form")
