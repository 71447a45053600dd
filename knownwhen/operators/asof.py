"""What was knowable at an instant, and at every instant of a calendar."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.functions.values import as_instant, quarter_end


def in_force(at: Column, opened: str = "known_from_ts", closed: str = "known_to_ts") -> Column:
    """Inclusive start, exclusive end."""
    return (F.col(opened) <= at) & (F.col(closed) > at)


def as_of(intervals: DataFrame, instant: datetime | str) -> DataFrame:
    """The rows in force at ``instant``. Not yet known means absent, never zero.

    Two comparisons on stored columns: they reach the parquet scan, and no
    window is needed at read time.
    """
    return intervals.where(in_force(F.lit(str(instant)).cast("timestamp_ntz")))


@dataclass(frozen=True)
class Quarters:
    """A calendar: all quarter ends from the quarter of ``first`` to the quarter of ``last``."""

    first: Column
    last: Column

    @classmethod
    def between(cls, first: str, last: str) -> Quarters:
        return cls(F.lit(first).cast("date"), F.lit(last).cast("date"))

    @classmethod
    def of(cls, rows: DataFrame, at: str) -> Quarters:
        """The quarters that the instants in ``rows`` span, as a scalar subquery."""
        span = rows.agg(F.struct(F.min(at).cast("date").alias("first"),
                                 F.max(at).cast("date").alias("last"))).scalar()
        return cls(span["first"], span["last"])

    def dates(self, spark: SparkSession) -> DataFrame:
        """The calendar itself. Stepping runs over quarter starts, so every date is a true
        month end."""
        return _dated(spark.range(1).select(F.explode(
            _starts(self.first, self.last)).alias("_start"))).drop("_start")


def _starts(first: Column, last: Column) -> Column:
    """The first days of the quarters from one date to another; NULL if there is none."""
    begin, end = F.trunc(first, "quarter"), F.trunc(last, "quarter")
    return F.when(begin <= end, F.sequence(begin, end, F.expr("INTERVAL 3 MONTH")))


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rebalance_dt", quarter_end("_start")).withColumn(
        "rebalance_ts", as_instant("rebalance_dt"))


def as_of_grid(intervals: DataFrame, calendar: Quarters, *conditions: Column,
               first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Each interval once per calendar date it is in force on.

    Every interval makes its own dates, clipped to the calendar and to ``first`` and
    ``last``, so the cost is that of the result and nothing is joined.
    """
    begin = F.greatest(*[x for x in (calendar.first, F.col("known_from_ts").cast("date"), first)
                         if x is not None])
    end = F.least(*[x for x in (calendar.last, F.col("known_to_ts").cast("date"), last)
                    if x is not None])
    dated = _dated(intervals.withColumn("_start", F.explode(_starts(begin, end)))).drop("_start")
    on = in_force(F.col("rebalance_ts"))
    for extra in conditions:
        on = on & extra
    return dated.where(on)
