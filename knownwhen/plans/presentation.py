"""What the presentation files say about tags: on which statement they stand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.functions.values import is_blank
from knownwhen.plans.concepts import statement_of

#: How much of a tag's votes its statement needs to overrule the guess by words.
MAJORITY = 0.5


def statement_votes(presented: DataFrame, facts: DataFrame) -> DataFrame:
    """(tag, statement, votes, share): on which statements filings show a tag.

    A filing votes for each statement that it shows the tag on, once, with as many votes as it
    reports facts of the tag, at least one. Lines without a statement or a tag don't vote. Facts
    and lines are folded to one row per filing and tag before they meet.
    """
    shown = presented.where(~is_blank("stmt") & F.col("tag").isNotNull()).groupBy(
        "adsh", "tag").agg(F.collect_set(F.upper(F.trim("stmt"))).alias("statements"))
    weight = facts.groupBy("adsh", "tag").agg(F.count(F.lit(1)).alias("facts"))
    votes = shown.join(weight, ["adsh", "tag"], "left").select(
        "tag", F.explode("statements").alias("statement"),
        F.coalesce("facts", F.lit(1)).alias("facts"))
    counted = votes.groupBy("tag", "statement").agg(F.sum("facts").alias("votes"))
    total = counted.groupBy("tag").agg(F.sum("votes").alias("all_votes"))
    return counted.join(total, "tag").select(
        "tag", "statement", "votes", (F.col("votes").cast("double") / F.col("all_votes")).alias("share"))


def statement_vote(votes: DataFrame) -> DataFrame:
    """Per tag the statement with most votes (of equals the first by name), and the guess that
    its words give."""
    first = F.struct((-F.col("votes")).alias("_less"), "statement", "votes", "share")
    return votes.groupBy("tag").agg(F.min(first).alias("_top")).select(
        "tag", "_top.statement", "_top.votes", "_top.share",
        statement_of("tag").alias("guessed"),
        (F.col("_top.statement") == statement_of("tag")).alias("agrees"))


def placed(concept_map: DataFrame, voted: DataFrame, majority: float = MAJORITY) -> DataFrame:
    """The concept map with the statements that filings use, for tags nobody decided on (SELF)
    whose statement has more than ``majority`` of the votes."""
    known = voted.where(F.col("share") > majority).select(
        F.col("tag").alias("src_tag"), F.col("statement").alias("_shown"))
    own = (F.col("mapping_method") == "SELF") & (F.col("canonical_tag") == F.col("src_tag"))
    return concept_map.join(known, "src_tag", "left").withColumn(
        "statement", F.when(own, F.coalesce("_shown", "statement")).otherwise(F.col("statement"))
    ).select(concept_map.columns)
