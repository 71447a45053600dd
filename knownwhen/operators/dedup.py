"""One value per key: within a filing, and within an instant.

All forms combine on the map side, so any number of copies of one key is
folded before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def bounded_tasks(spark: SparkSession, size: str = "16m") -> None:
    """From now on this session merges shuffled partitions up to ``size`` only, unless it was
    told another size: a task that sorts or hashes wide rows holds many times what it reads."""
    if spark.conf.get(_TASK_SIZE, None) is None:
        spark.conf.set(_TASK_SIZE, size)


def best_row(rows: DataFrame, by: list[str], rank: list[Column | str]) -> DataFrame:
    """Per ``by`` group the row that is largest in ``rank``; other columns break ties."""
    bounded_tasks(rows.sparkSession)
    names = [f"_r{i}" for i in range(len(rank))]
    ranked = rows.withColumns({
        n: r if isinstance(r, Column) else F.col(r) for n, r in zip(names, rank)})
    rest = [c for c in rows.columns if c not in by]
    best = ranked.groupBy(*by).agg(F.max(F.struct(*names, *rest)).alias("_best"))
    return best.select(*[
        F.col(c) if c in by else F.col("_best")[c].alias(c) for c in rows.columns])


def one_per_filing(facts: DataFrame, key: list[str], filing: str, value: str) -> DataFrame:
    """A filing that reports a key more than once keeps the largest signed value."""
    return best_row(facts, [*key, filing], [value])


def one_per_instant(facts: DataFrame, key: list[str], at: str, filing: str) -> DataFrame:
    """Of several filings at one instant the last by filing name stays."""
    return best_row(facts, [*key, at], [filing])


def fold_copies(facts: DataFrame, value: str) -> DataFrame:
    """Largest value per combination of all other columns.

    A cheaper first step than :func:`one_per_filing` (hash aggregate on one
    number); it leaves at most one row per filing, key and carried label.
    """
    rest = [c for c in facts.columns if c != value]
    return facts.groupBy(*rest).agg(F.max(value).alias(value)).select(*facts.columns)
