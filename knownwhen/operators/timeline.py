"""Turn reported states into knowledge intervals.

A *timeline* is everything reported about one key, in the order it became
public. A state is in force from the instant it was reported until the instant
a different state replaces it; repeats open nothing, and of several reports at
one instant only the last in tie order counts.

A key may have more reports than one task should hold. Entities with many instants
are therefore cut into slices of time, and windows run per (key, slice). What
crosses a cut (the state carried in, the number of changes before, the next change
after) travels in one row per (key, slice). Entities without slices have a NULL
slice, so one plan serves keys of any size, and the slice table is data like any
other: nothing is counted while the plan is made.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from knownwhen.functions.values import open_end

# Instants of an entity that a slice holds, about.
SLICE_INSTANTS = 2_000_000
# Parts a day is cut into at most: its seconds.
DAY_PARTS = 86_400

SLICE = "_slice"


@dataclass(frozen=True)
class Timeline:
    """Which columns say what a timeline is about, when, and what was stated."""

    key: tuple[str, ...]
    at: str
    state: tuple[str, ...]
    tie: tuple[str, ...] = field(default=())
    entity: tuple[str, ...] = field(default=())
    # Columns of the key that rows are dealt out by, if not all: one that holds a constant
    # would make Spark deal them out again for the windows.
    dealt_by: tuple[str, ...] = field(default=())

    def order(self) -> list[Column]:
        return [F.col(self.at).asc(), *[F.col(c).asc() for c in self.tie]]

    def stated(self) -> Column:
        """What one report says: the column itself, or a struct of several."""
        return F.col(self.state[0]) if len(self.state) == 1 else F.struct(*self.state)

    def reports(self, rows: DataFrame) -> DataFrame:
        """Rows that state something; an unknown value is no report."""
        return rows.where(F.col(self.state[0]).isNotNull()) if len(self.state) == 1 else rows


# ---------------------------------------------------------------- slices

def plan_slices(events: DataFrame, entity: list[str], at: str,
                limit: int = SLICE_INSTANTS) -> DataFrame:
    """Slices for entities with more than ``limit`` events.

    ``events`` is the (small) table with one row per report of an entity, for example
    one per filing; a key of an entity has at most one surviving row per event. The
    result has (entity, day, slice, parts): consecutive days share a slice until it
    holds about ``limit`` instants; a day with more is cut into ``parts`` of equal
    length. Distinct instants are counted per day first, so the running total has one
    row per calendar day of an entity, whatever the number of events.
    """
    per_day = (
        events.groupBy(*entity, at).agg(F.count("*").alias("_n"))
        .groupBy(*entity, F.to_date(at).alias("_day"))
        .agg(F.sum("_n").alias("_events"), F.count("*").alias("_instants"))
    )
    days = Window.partitionBy(*entity)
    before = days.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    parts = F.least(F.ceil(F.col("_instants") / limit), F.lit(DAY_PARTS)).cast("int")
    return (
        per_day
        .withColumn("_total", F.sum("_events").over(days))
        .where(F.col("_total") > limit)
        # Only days of the few large entities are put in order.
        .withColumn("_before", F.coalesce(F.sum("_instants").over(before), F.lit(0)))
        .select(*entity, "_day", parts.alias("_parts"),
                F.floor(F.col("_before") / limit).alias("_run"))
    )


def in_slices(events: DataFrame, slices: DataFrame, entity: list[str], at: str) -> DataFrame:
    """Add the slice to ``events``; NULL for entities that need none."""
    second = F.hour(at) * 3600 + F.minute(at) * 60 + F.floor(F.second(at))
    # A full day starts a run of its own, so its parts follow each other in order.
    part = F.floor(second * F.col("_parts") / DAY_PARTS)
    number = (F.col("_run") * 2 + (F.col("_parts") > 1).cast("int")) * DAY_PARTS + part
    return (
        events.withColumn("_day", F.to_date(at))
        .join(slices, [*entity, "_day"], "left")
        .withColumn(SLICE, number.cast("bigint")).drop("_day", "_parts", "_run")
    )


# ---------------------------------------------------------------- building

def where_state_changes(rows: DataFrame, line: Timeline, window: WindowSpec) -> DataFrame:
    """Keep first rows and rows whose state differs from the one before.

    ``_prior`` is the replaced state. Dropping repeats leaves the predecessor's
    state as it was, so it needs no second look-back.
    """
    return (
        rows.withColumn("_prior", F.lag(line.stated()).over(window))
        .where(~F.col("_prior").eqNullSafe(line.stated()))
    )


def build(rows: DataFrame, line: Timeline, final_state: bool = False,
          folded: bool = False, lying: bool = False) -> DataFrame:
    """Intervals for every key of ``rows``, which carry the slice of :func:`in_slices`.

    Adds ``opened_at``, ``closed_at`` (open end when still in force), ``seq``
    and ``prior`` (the replaced state, NULL for the first report); with
    ``final_state`` also ``final``, the state in force today. A state of several
    columns is given as a struct. ``folded`` rows have one row per key and instant.
    Rows of a key that are ``lying`` together stay where they are, but for sliced ones: those
    come back in ranges of key and time, for their key may be more than one task should write.
    """
    part = [*line.key, SLICE]
    said, by = line.reports(rows), [*(line.dealt_by or line.key), SLICE]
    # The one exchange: folding, windows and edges all run on rows dealt out like this.
    dealt = (said.where(F.col(SLICE).isNotNull()) if lying else said).repartition(*by)
    # A condition on the partition can't be pushed below the exchange, so all three readers
    # share it, and rows of the other kind go before anything is sorted.
    slice_of = F.when(F.spark_partition_id() >= 0, F.col(SLICE))
    unsliced = said.where(F.col(SLICE).isNull()) if lying else dealt.where(slice_of.isNull())
    whole = _changes(unsliced, line, part, folded)
    sliced = _changes(dealt.where(slice_of.isNotNull()), line, part, folded)
    again = _changes(dealt.where(slice_of.isNotNull()), line, part, folded)
    same = [F.col(c) == F.col(f"_of_{c}") for c in part]
    joined = sliced.join(_across_slices(again, line, part), same, "left").drop(
        *[f"_of_{c}" for c in part])
    # A slice whose first state equals the one carried in opens nothing there.
    repeats = F.coalesce(F.col("_repeats"), F.lit(False))
    first = F.col("_nth") == 1
    rest = [c for c in rows.columns if c not in {SLICE, line.at}]

    def intervals(found: DataFrame, seq: Column, closed_at: Column, prior: Column,
                  final: Column) -> DataFrame:
        return found.select(
            F.col(line.at).alias("opened_at"), *rest, seq.cast("int").alias("seq"),
            F.coalesce(closed_at, open_end()).alias("closed_at"), prior.alias("prior"),
            *([final.alias("final")] if final_state else []))

    cut = intervals(
        joined.where(~(first & repeats)),
        F.col("_nth") - repeats.cast("int") + F.coalesce(F.col("_changes_before"), F.lit(0)),
        F.coalesce("_next", "_next_slice_change"),
        F.when(first, F.col("_carried")).otherwise(F.col("_prior")),
        F.coalesce("_key_final", "_local_final"))
    return intervals(
        whole, F.col("_nth"), F.col("_next"), F.col("_prior"), F.col("_local_final"),
    ).unionByName(cut.repartitionByRange(*line.key, "opened_at") if lying else cut)


def _changes(dealt: DataFrame, line: Timeline, part: list[str], folded: bool) -> DataFrame:
    """First reports and changes of each (key, slice), numbered, with the instant of the next."""
    instants = dealt if folded else last_of_instants(dealt, line, part)
    local = Window.partitionBy(*part).orderBy(line.at)
    return where_state_changes(instants, line, local).withColumns({
        "_nth": F.row_number().over(local),
        "_next": F.lead(line.at).over(local),
        "_local_final": F.last(line.stated()).over(
            local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })


def last_of_instants(rows: DataFrame, line: Timeline, part: list[str]) -> DataFrame:
    """The same rows as :func:`fold_instants`, by the order in which windows need them anyway."""
    rest = [c for c in rows.columns if c not in {*part, line.at, *line.tie}]
    order = Window.partitionBy(*part).orderBy(line.at, *line.tie, *rest)
    more = F.lead(F.lit(True), 1, False).over(order)
    return (
        rows.withColumns({"_later": F.lead(line.at).over(order), "_more": more})
        .where(~(F.col("_more") & F.col("_later").eqNullSafe(F.col(line.at))))
        .drop("_later", "_more")
    )


def fold_instants(rows: DataFrame, line: Timeline, part: list[str]) -> DataFrame:
    """One row per (key, instant), the last in tie order, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in {*part, line.at}]
    ordered = [*line.tie, *[c for c in rest if c not in line.tie]]
    folded = rows.groupBy(*part, line.at).agg(F.max(F.struct(*ordered)).alias("_last"))
    return folded.select(*part, line.at, *[F.col("_last")[c].alias(c) for c in ordered])


def _across_slices(found: DataFrame, line: Timeline, part: list[str]) -> DataFrame:
    """One row per (key, slice) of the sliced entities: what its neighbours tell it."""
    state = line.stated()
    edges = found.groupBy(*part).agg(
        F.min_by(state, line.at).alias("_first"),
        F.max_by(state, line.at).alias("_last"),
        F.count("*").alias("_changes"),
        F.min(line.at).alias("_first_at"),
        F.min("_next").alias("_second_at"),
    )
    slices = Window.partitionBy(*line.key).orderBy(SLICE)
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    later = slices.rowsBetween(1, Window.unboundedFollowing)
    whole = slices.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        edges
        .withColumn("_carried", F.lag("_last").over(slices))
        .withColumn("_repeats", F.col("_carried").eqNullSafe(F.col("_first")))
        .withColumn("_starts", F.when(F.col("_repeats"), F.col("_second_at"))
                    .otherwise(F.col("_first_at")))
        .select(
            *[F.col(c).alias(f"_of_{c}") for c in part], "_carried", "_repeats",
            F.sum(F.col("_changes") - F.col("_repeats").cast("int")).over(earlier)
             .alias("_changes_before"),
            F.first("_starts", ignorenulls=True).over(later).alias("_next_slice_change"),
            F.last("_last").over(whole).alias("_key_final"),
        )
    )


def with_next(rows: DataFrame, key: list[str], at: str, tie: list[str], out: str) -> DataFrame:
    """Add the ``at`` of the next row of the same key as ``out``.

    The look-ahead stays within (key, slice); the first row of the next slice is
    fetched from a table with one row per (key, slice).
    """
    part = [*key, SLICE]
    found = rows.withColumn(out, F.lead(at).over(Window.partitionBy(*part).orderBy(at, *tie)))
    starts = (
        rows.where(F.col(SLICE).isNotNull()).groupBy(*part).agg(F.min(at).alias("_starts"))
        .withColumn("_next_start",
                    F.lead("_starts").over(Window.partitionBy(*key).orderBy(SLICE)))
        .drop("_starts")
    )
    return (
        found.join(starts, part, "left")
        .withColumn(out, F.coalesce(out, "_next_start")).drop("_next_start", SLICE)
    )
