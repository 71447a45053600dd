"""The bitemporal fact table and what is read straight off it.

A row says: for this key, this value was the public figure from
``known_from_ts`` (inclusive) to ``known_to_ts`` (exclusive).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.functions.revisions import RESTATEMENT, with_revision
from knownwhen.functions.values import open_end
from knownwhen.operators import timeline as tl
from knownwhen.operators.dedup import fold_copies

KEY = ["cik", "canonical_tag", "ddate", "qtrs", "uom"]
FACT_LINE = tl.Timeline(
    key=tuple(KEY), at="accepted_ts", state=("value",),
    tie=("adsh", "value", "statement"), entity=("cik",),
    dealt_by=("cik", "canonical_tag", "ddate", "qtrs"))

PIT_COLUMNS = [
    *KEY, "value", "known_from_ts", "known_to_ts", "is_current", "source_adsh",
    "source_form", "is_amendment", "revision_seq", "prev_value", "change_class",
    "pct_change", "statement",
]


def attach_filings(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts of known filings, with who filed and when it became public."""
    return facts.join(filings.select("adsh", "cik", "accepted_ts", "form"), "adsh")


def sliced_filings(filings: DataFrame, limit: int = tl.SLICE_INSTANTS) -> DataFrame:
    """Filings with the slice of time their facts belong to; a small table learns it, so that
    facts get it from the join with their filings."""
    known = filings.select("adsh", "cik", "accepted_ts", "form")
    slices = tl.plan_slices(known, list(FACT_LINE.entity), FACT_LINE.at, limit)
    return tl.in_slices(known, slices, list(FACT_LINE.entity), FACT_LINE.at)


def fact_rows(facts: DataFrame) -> DataFrame:
    """Facts worth joining: no unknown values, copies folded."""
    return fold_copies(facts.where(F.col("value").isNotNull()), "value")


def pit_from_silver(facts: DataFrame, submissions: DataFrame, *,
                    limit: int = tl.SLICE_INSTANTS, today: bool = False) -> DataFrame:
    """Knowledge intervals from typed facts and submissions."""
    used = facts.select("adsh", "canonical_tag", "statement", "ddate", "qtrs", "uom", "value")
    joined = fact_rows(used).join(sliced_filings(submissions, limit), "adsh")
    return fundamental_pit(joined, today=today)


def fundamental_pit(attributed: DataFrame, *, today: bool = False) -> DataFrame:
    """Knowledge intervals of facts joined with :func:`sliced_filings`.

    With ``today`` the column ``current_value`` carries each key's value in force now.
    """
    return described(_built(attributed, today), today)


def _built(attributed: DataFrame, today: bool) -> DataFrame:
    rows = attributed.select(*KEY, "value", "accepted_ts", "adsh", "form", "statement", tl.SLICE)
    return tl.build(rows, FACT_LINE, final_state=today)


def change_points(attributed: DataFrame) -> DataFrame:
    """First reports and changes, each with the value that it replaces."""
    return _built(attributed, False).select(
        *KEY, F.col("opened_at").alias("accepted_ts"), "adsh", "value",
        F.col("prior").alias("prev_value"))


def described(intervals: DataFrame, today: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    return with_revision(intervals, "prior", "value").select(
        *KEY, "value",
        F.col("opened_at").alias("known_from_ts"),
        F.col("closed_at").alias("known_to_ts"),
        (F.col("closed_at") == open_end()).alias("is_current"),
        F.col("adsh").alias("source_adsh"),
        F.col("form").alias("source_form"),
        F.col("form").endswith("/A").alias("is_amendment"),
        F.col("seq").alias("revision_seq"),
        F.col("prior").alias("prev_value"),
        "change_class", "pct_change", "statement",
        *([F.col("final").alias("current_value")] if today else []), *keep,
    )


def fact_revision(pit: DataFrame) -> DataFrame:
    """Genuine restatements only: what the figure was, what it became, who changed it."""
    return pit.where(F.col("change_class") == RESTATEMENT).select(
        *KEY, "prev_value", F.col("value").alias("revised_value"), "pct_change",
        F.col("known_from_ts").alias("revised_at_ts"),
        "source_adsh", "source_form", "revision_seq", "statement",
    )
