"""Compare what two windows of filings said about the same facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.functions.values import first_match, ratio, share
from knownwhen.operators.dedup import best_row
from knownwhen.plans.silver import (
    REASON, UNIT_IN_SCOPE, is_consolidated, is_standard_tag, typed_facts, typed_submissions)

KEY = ["cik", "canonical_tag", "ddate", "qtrs"]
CHANGED_ABOVE_PCT = 1.0

# Right-closed bins of the percentage change.
BIN_EDGES = (0, 0.01, 1, 5, 25, 100, 1000, 1e12)
SAME_BAND = (0.999, 1.001)
SCALE_POWERS = (-3, -2, -1, 1, 2, 3)


def within(window: tuple[str, str], at: str = "accepted_ts") -> Column:
    """From the first day up to, not including, the second."""
    start, end = (F.lit(x).cast("timestamp_ntz") for x in window)
    return (F.col(at) >= start) & (F.col(at) < end)


def comparable(facts: DataFrame, concept_map: DataFrame, concepts: list[str]) -> DataFrame:
    """Sound USD values of the chosen concepts as the whole company states them.

    ``facts`` are raw: breakdowns by segment or co-registrant and filers' own tags are
    left out, since comparing them with totals is what makes false changes.
    """
    kept = typed_facts(facts).where(
        F.col(REASON).isNull() & is_consolidated() & is_standard_tag()
        & (F.col("uom") == UNIT_IN_SCOPE) & F.col("value_dec").isNotNull())
    mapping = concept_map.where(F.col("canonical_tag").isin(*concepts)).select(
        F.col("src_tag").alias("tag"), "canonical_tag")
    return kept.join(mapping, "tag").select(
        "adsh", "canonical_tag", F.col("ddate_dt").alias("ddate"), F.col("qtrs_i").alias("qtrs"),
        F.col("value_dec").alias("value"))


def filed(submissions: DataFrame) -> DataFrame:
    """Who filed and when, from raw submissions."""
    return typed_submissions(submissions).where(
        F.col("cik").isNotNull() & F.col("accepted_ts").isNotNull()).select(
        "adsh", "cik", "accepted_ts")


def resolve(attributed: DataFrame) -> DataFrame:
    """The latest accepted value per key; at one instant the last filing, then the larger value."""
    rows = attributed.select(*KEY, "value", "adsh", "accepted_ts")
    return best_row(rows, KEY, ["accepted_ts", "adsh", "value"])


def diff(attributed: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Keys told in both windows with the change between them, ``pct`` in percent.

    Both windows, (from, until) each, are resolved in one aggregate over the facts.
    """
    told = F.struct("accepted_ts", "adsh", "value")

    def latest(window: tuple[str, str]) -> Column:
        return F.max(F.when(within(window), told))

    both = attributed.where(within(first) | within(second)).groupBy(*KEY).agg(
        latest(first).alias("_a"), latest(second).alias("_b")).where(
        F.col("_a").isNotNull() & F.col("_b").isNotNull())
    sides = both.select(*KEY, *[
        F.col(f"_{s}.{c}").alias(f"{c}_{s}")
        for s in ("a", "b") for c in ("value", "adsh", "accepted_ts")])
    a, b = F.col("value_a").cast("double"), F.col("value_b").cast("double")
    return sides.withColumns({
        "delta": F.col("value_b") - F.col("value_a"),
        "pct": ratio(F.abs(b - a), F.abs(a)) * 100,
        "factor": F.abs(ratio("value_b", "value_a")),
    })


def _is_changed() -> Column:
    """Unknown change, from a zero base, does not count as changed."""
    return F.coalesce(F.col("pct") > CHANGED_ABOVE_PCT, F.lit(False))


def rates(diffs: DataFrame, *by: str) -> DataFrame:
    """Facts and share materially changed for each value of each column, in one pass.

    ``grouped`` is the value; values of all columns but the first carry its name.
    """
    n = F.count(F.lit(1))
    counted = diffs.groupingSets([[F.col(c)] for c in by], *by).agg(
        F.grouping_id().alias("_level"), n.alias("n"),
        share(F.count_if(_is_changed()), n, 1).alias("chg_pct"))
    label = F.coalesce(F.col(by[0]).cast("string"), *[
        F.concat(F.lit(f"{c} "), F.col(c).cast("string")) for c in by[1:]])
    return counted.select(label.alias("grouped"), "n", "chg_pct")


def sign_differs() -> Column:
    """Also true for a move to or from zero."""
    return F.signum("value_a") != F.signum("value_b")


def artefacts(diffs: DataFrame) -> DataFrame:
    """Counts of changes that look like presentation rather than news, in one pass."""
    def inside(low: float, high: float) -> Column:
        return F.count_if((F.col("factor") > low) & (F.col("factor") < high))

    kinds = {"identical": inside(*SAME_BAND)}
    for k in SCALE_POWERS:
        kinds[f"scale_1e{k}"] = inside(10.0 ** k * 0.99, 10.0 ** k * 1.01)
    kinds["sign_flip"] = F.count_if(sign_differs())
    counted = diffs.agg(*[c.alias(name) for name, c in kinds.items()])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("artefact"), F.col(name).alias("n")) for name in kinds])))


def bin_label(low: float, high: float) -> str:
    return f"({low:g}, {high:g}]"


def histogram(diffs: DataFrame) -> DataFrame:
    """Facts per bin of ``pct``; unchanged facts and unknown changes fall in no bin."""
    bins = list(zip(BIN_EDGES, BIN_EDGES[1:]))
    label = first_match({
        bin_label(lo, hi): (F.col("pct") > lo) & (F.col("pct") <= hi) for lo, hi in bins})
    return (
        diffs.select(label.alias("bin")).where(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )


def year_mix(diffs: DataFrame) -> DataFrame:
    return diffs.groupBy(F.year("ddate").alias("year")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("year")


def largest_revisions(diffs: DataFrame, n: int = 15) -> DataFrame:
    return diffs.where(_is_changed()).orderBy(F.desc("pct"), *KEY).limit(n)


@dataclass(frozen=True)
class Verifiable:
    """Changes worth checking by hand: annual, moderate, on a large figure."""

    qtrs: int = 4
    pct_from: float = 3.0
    pct_to: float = 40.0
    base_above: float = 5e8


def candidates(diffs: DataFrame, want: Verifiable = Verifiable(), n: int = 25) -> DataFrame:
    chosen = diffs.where(
        _is_changed() & (F.col("qtrs") == want.qtrs)
        & F.col("pct").between(want.pct_from, want.pct_to)
        & (F.abs("value_a") > want.base_above))
    return chosen.orderBy(F.abs("value_a").desc(), *KEY).limit(n)


def buckets(diffs: DataFrame, large: float, very_large: float, revenue: str,
            top: int = 8) -> DataFrame:
    """The ``top`` largest bases in each of four overlapping groups of changes.

    Groups are labelled in one pass; the rank filter prunes before the shuffle.
    """
    base, pct = F.abs("value_a"), F.col("pct")
    groups = {
        "large_pct_nonrevenue": (pct > 15) & (F.col("canonical_tag") != revenue) & (base > large),
        "small_material": pct.between(1, 5) & (base > very_large),
        "sign_flip": sign_differs(),
        "balance_sheet": (F.col("qtrs") == 0) & (pct > 10) & (base > very_large),
    }
    labels = F.array_compact(F.array(*[F.when(rule, name) for name, rule in groups.items()]))
    labelled = diffs.where(_is_changed()).withColumn("bucket", F.explode(labels))
    order = Window.partitionBy("bucket").orderBy(base.desc(), *KEY)
    return (
        labelled.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
        .select("bucket", "place", *KEY, "value_a", "value_b", "pct")
    )


def filing_path(rows: DataFrame, base: str, filing: str) -> DataFrame:
    """Where the document of a filing is found."""
    return rows.withColumn("path", F.concat(
        F.lit(base), F.col("cik").cast("string"), F.lit("/"),
        F.regexp_replace(F.col(filing).cast("string"), "-", ""), F.lit("/")))
