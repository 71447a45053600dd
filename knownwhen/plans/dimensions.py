"""Company attributes over transaction time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.functions.values import open_end
from knownwhen.operators import timeline as tl

COMPANY_LINE = tl.Timeline(
    key=("cik",), at="accepted_ts", state=("name", "sic", "fye"), entity=("cik",))


def company_scd2(filings: DataFrame, limit: int = tl.SLICE_INSTANTS) -> DataFrame:
    """One row per company and run of unchanged attributes.

    Of several filings at one instant the smallest (name, sic, fye) counts,
    NULL sorting first. Attributes are compared as a struct, so NULL and the
    empty string differ.
    """
    line = COMPANY_LINE
    known = filings.where(F.col("cik").isNotNull())
    instants = (
        known.groupBy("cik", "accepted_ts").agg(F.min(line.stated()).alias("_a"))
        .select("cik", "accepted_ts", "_a.name", "_a.sic", "_a.fye")
    )
    slices = tl.plan_slices(known, ["cik"], line.at, limit)
    versions = tl.build(tl.in_slices(instants, slices, ["cik"], line.at), line, folded=True)
    return versions.select(
        "cik", "name", "sic", "fye", F.col("opened_at").alias("valid_from_ts"),
        F.col("closed_at").alias("valid_to_ts"), F.col("seq").alias("version_seq"),
        (F.col("closed_at") == open_end()).alias("is_current"))


def current_names(filings: DataFrame) -> DataFrame:
    """(cik, company): the name each company has today, as :func:`company_scd2` would say.

    Two aggregates; the versions before are not built.
    """
    last = filings.where(F.col("cik").isNotNull()).groupBy("cik", "accepted_ts").agg(
        F.min(COMPANY_LINE.stated()).alias("_a"))
    return last.groupBy("cik").agg(F.max_by("_a.name", "accepted_ts").alias("company"))
