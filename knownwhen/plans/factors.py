"""Rank companies by return on assets twice: with today's figures and with those of the day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownwhen.functions.values import ratio, share
from knownwhen.operators.asof import Quarters, as_of_grid
from knownwhen.operators.ranking import ntile
from knownwhen.plans.gold import KEY


@dataclass(frozen=True)
class Factor:
    """Numerator and denominator as (concept, periods), and how old they may be."""

    top: tuple[str, int] = ("NET_INCOME", 4)
    bottom: tuple[str, int] = ("Assets", 0)
    months_back: int = 24
    unit: str = "USD"

    def is_top(self) -> Column:
        return (F.col("canonical_tag") == self.top[0]) & (F.col("qtrs") == self.top[1])

    def is_bottom(self) -> Column:
        return (F.col("canonical_tag") == self.bottom[0]) & (F.col("qtrs") == self.bottom[1])


# The calendar of the published experiment.
STUDY_FROM, STUDY_TO = "2012-03-31", "2025-12-31"


def study_calendar() -> Quarters:
    return Quarters.between(STUDY_FROM, STUDY_TO)


def calendar_of(filings: DataFrame, at: str = "accepted_ts") -> Quarters:
    """The quarter ends the filings span."""
    return Quarters.of(filings, at)


def observed(pit: DataFrame, calendar: Quarters, factor: Factor) -> DataFrame:
    """Intervals of either input on every date they could be used on."""
    wanted = pit.where((factor.is_top() | factor.is_bottom()) & (F.col("uom") == factor.unit))
    recent = F.col("ddate") > F.add_months("rebalance_dt", -factor.months_back)
    return as_of_grid(
        wanted, calendar, F.col("ddate") <= F.col("rebalance_dt"), recent,
        first=F.col("ddate"), last=F.add_months("ddate", factor.months_back + 1))


def with_current_value(pit: DataFrame) -> DataFrame:
    """Published intervals with each key's value in force today."""
    now = pit.where("is_current").select(*KEY, F.col("value").alias("current_value"))
    return pit.join(now, KEY, "left")


def latest_inputs(pit: DataFrame, calendar: Quarters, factor: Factor) -> DataFrame:
    """Per date and company the newest period of both inputs, side by side.

    ``pit`` needs ``current_value``. One aggregate serves both inputs and both
    views; it combines on the map side, so no date or company becomes a hot task.
    """
    grid = observed(pit, calendar, factor)
    top_at = F.when(factor.is_top(), F.col("ddate"))
    bottom_at = F.when(factor.is_bottom(), F.col("ddate"))
    return grid.groupBy("rebalance_dt", "cik").agg(
        F.max(top_at).alias("ni_ddate"), F.max(bottom_at).alias("assets_ddate"),
        F.max_by("value", top_at).alias("pit_ni"),
        F.max_by("value", bottom_at).alias("pit_assets"),
        F.max_by("current_value", top_at).alias("naive_ni"),
        F.max_by("current_value", bottom_at).alias("naive_assets"),
    )


def roa_comparison(pit: DataFrame, calendar: Quarters, factor: Factor) -> DataFrame:
    """Both ratios for companies with both inputs. Same companies, same periods; only values differ."""
    both = latest_inputs(pit, calendar, factor).where(
        F.col("pit_ni").isNotNull() & F.col("naive_ni").isNotNull()
        & (F.col("pit_assets") > 0) & (F.col("naive_assets") > 0))
    return both.select(
        "rebalance_dt", "cik", "ni_ddate", "assets_ddate", "pit_ni", "pit_assets",
        "naive_ni", "naive_assets",
        ratio("pit_ni", "pit_assets").alias("pit_roa"),
        ratio("naive_ni", "naive_assets").alias("naive_roa"),
        (F.col("naive_ni") != F.col("pit_ni")).alias("ni_revised"),
        (F.col("naive_assets") != F.col("pit_assets")).alias("assets_revised"))


def roa_deciles(comparison: DataFrame) -> DataFrame:
    """Decile 1 is the highest ratio; equal ratios are ordered by company.

    Both views are stacked, so one sort and one stored table number them both.
    """
    views = F.array(*[F.struct(F.lit(v).alias("view"), F.col(f"{v}_roa").alias("roa"))
                      for v in ("pit", "naive")])
    stacked = comparison.select(
        "rebalance_dt", "cik", "ni_revised", "assets_revised", F.inline(views))
    order = [F.col("roa").desc(), F.col("cik").asc()]
    ranked = ntile(stacked, ["view", "rebalance_dt"], order, 10, "decile")

    def of(view: str, column: str) -> Column:
        return F.max(F.when(F.col("view") == view, F.col(column)))

    return ranked.groupBy("rebalance_dt", "cik").agg(
        of("pit", "roa").alias("pit_roa"), of("naive", "roa").alias("naive_roa"),
        of("pit", "decile").alias("pit_decile"), of("naive", "decile").alias("naive_decile"),
        F.first("ni_revised").alias("ni_revised"),
        F.first("assets_revised").alias("assets_revised"),
    ).select(
        "rebalance_dt", "cik", "pit_roa", "naive_roa", "pit_decile", "naive_decile",
        (F.col("pit_decile") != F.col("naive_decile")).alias("decile_moved"),
        "ni_revised", "assets_revised")


def bias_by_quarter(ranked: DataFrame) -> DataFrame:
    """How far the two rankings disagree on each date.

    Turnover is the part of today's top decile that was not in the top decile then.
    """
    top_now = F.col("naive_decile") == 1
    everyone = F.count(F.lit(1))
    return ranked.groupBy("rebalance_dt").agg(
        everyone.alias("universe"),
        share(F.count_if(F.col("decile_moved")), everyone).alias("pct_decile_moved"),
        share(F.count_if(F.col("ni_revised") | F.col("assets_revised")), everyone)
        .alias("pct_any_input_revised"),
        share(F.count_if(top_now & (F.col("pit_decile") != 1)), F.count_if(top_now))
        .alias("pct_top_decile_turnover"))


def settled_quarters(bias: DataFrame, before: str) -> DataFrame:
    """Quarters old enough for corrections to have arrived."""
    return bias.where(F.col("rebalance_dt") < F.lit(before).cast("date")).select(
        "rebalance_dt", "pct_decile_moved", "pct_top_decile_turnover", "pct_any_input_revised",
    ).orderBy("rebalance_dt")
