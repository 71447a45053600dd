"""One company under several numbers and names.

A company that reorganises files under a new number. Two things in its filings tie the
numbers together: a tax number that both state, and a *former* name that the other one
files under. Numbers so tied, over any number of steps, are one entity, known by its
smallest number, and the entity has one line of names over time.

Names and tax numbers are nodes of the graph beside company numbers, so what thousands of
companies share is a hub, not a join of them with each other. A name is a node only if
somebody gives it as a former name; to bear the same name today ties nobody.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownwhen.functions.values import open_end
from knownwhen.operators import timeline as tl
from knownwhen.operators.closure import components

ENTITY_LINE = tl.Timeline(
    key=("entity",), at="accepted_ts", state=("name", "cik"), entity=("entity",))


def folded(name: str) -> Column:
    """A name without what filers write differently: case and white space; '' is unknown."""
    return F.nullif(F.upper(F.trim(F.regexp_replace(name, r"\s+", " "))), F.lit(""))


def ties(filings: DataFrame) -> DataFrame:
    """(a, b): company numbers, each a struct (kind, cik, text), with what they share.

    Every company number is tied to itself, so each has a component.
    """
    said = filings.where(F.col("cik").isNotNull()).select(
        F.col("cik").cast("long").alias("cik"), folded("name").alias("name"),
        folded("former").alias("former"), folded("ein").alias("ein")).distinct()
    # Companies sort before what they share, so the smallest node of any component is one.
    company = _node(0, F.col("cik"), F.lit(""))
    hubs = said.where("former IS NOT NULL").select("former").distinct()
    borne = said.select("cik", "name").distinct().join(hubs, F.col("name") == F.col("former"),
                                                       "left_semi")
    return (said.select("cik").distinct().select(company.alias("a"), company.alias("b"))
            .union(_shared(said, company, "ein", 1)).union(_shared(said, company, "former", 2))
            .union(_shared(borne, company, "name", 2)))


def _node(kind: int, cik: Column, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), cik.alias("cik"), text.alias("text"))


def _shared(said: DataFrame, company: Column, column: str, kind: int) -> DataFrame:
    return said.where(F.col(column).isNotNull()).select(
        company.alias("a"), _node(kind, F.lit(0).cast("long"), F.col(column)).alias("b"))


def entities(filings: DataFrame) -> DataFrame:
    """(cik, entity): the smallest company number that each is tied to, itself included."""
    return components(ties(filings)).where("node.kind = 0").select(
        F.col("node.cik").alias("cik"), F.col("component.cik").alias("entity"))


def entity_names(filings: DataFrame, members: DataFrame | None = None,
                 limit: int = tl.SLICE_INSTANTS) -> DataFrame:
    """One row per entity and run of an unchanged (name, cik), with when it was in force.

    A filing that gives a former name and the date of the change says its name from that
    date on, if it is before the filing. Of several statements at one instant the smallest
    (name, cik) counts. ``members``: :func:`entities` of the filings.
    """
    line = ENTITY_LINE
    known = filings.where(F.col("cik").isNotNull() & F.col("accepted_ts").isNotNull())
    since = F.col("changed").cast("timestamp_ntz")
    told = known.select("cik", "name", "accepted_ts").union(
        known.where(folded("former").isNotNull() & (since < F.col("accepted_ts")))
        .select("cik", "name", since)).groupBy("cik", "accepted_ts").agg(F.min("name").alias("name"))
    rows = told.join(entities(filings) if members is None else members, "cik")
    instants = rows.groupBy("entity", "accepted_ts").agg(F.min(line.stated()).alias("_s")).select(
        "entity", "accepted_ts", "_s.name", "_s.cik")
    slices = tl.plan_slices(rows, ["entity"], line.at, limit)
    versions = tl.build(tl.in_slices(instants, slices, ["entity"], line.at), line, folded=True)
    return versions.select(
        "entity", "name", "cik", F.col("opened_at").alias("valid_from_ts"),
        F.col("closed_at").alias("valid_to_ts"), F.col("seq").alias("version_seq"),
        (F.col("closed_at") == open_end()).alias("is_current"))
