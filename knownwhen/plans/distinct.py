"""Exact distinct counts that are kept up to date from new deliveries only.

How many different filings use a tag can't be added up over quarters, since a filing may be
delivered with several. So every item (a filing) gets a number when it is first met, numbers
being dense, and a delivery stores one bitmap per group and run of 32,768 numbers. Merging
deliveries is OR, counting is adding up bits: exact, and the facts of earlier deliveries are
not read again. A delivery that comes again replaces its bitmaps. Numbers and bitmaps are
switched by one log entry, so a run that dies leaves the state before.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.sources.shared import settle
from knownwhen.sources.versions import Log

# Parts in which new items are numbered.
NUMBERING = 256


@dataclass(frozen=True)
class DistinctStore:
    """Items per group under ``root``."""

    spark: SparkSession
    root: str

    @property
    def log(self) -> Log:
        return Log(self.spark, self.root)

    def _read(self, folders: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders]) if folders else None

    def take(self, delivery: str, rows: DataFrame, group: str, item: str) -> int:
        """Store which items each group of a delivery has; returns the version."""
        version, state = self.log.latest()
        pairs = settle(rows.where(F.col(item).isNotNull()).select(
            F.col(group).cast("string").alias("grouped"), F.col(item).cast("string").alias("item")
        ).distinct(), "pairs")
        numbers = state.get("numbers", [])
        known = self._read(numbers)
        items = pairs.select("item").distinct()
        fresh = settle(numbered(items if known is None else items.join(known, "item", "left_anti"),
                                state.get("last", 0)), "numbers")
        last = fresh.agg(F.max("number")).first()[0]
        if last is not None:
            folder = f"numbers-{uuid.uuid4().hex}"
            fresh.write.parquet(f"{self.root}/{folder}")
            numbers = [*numbers, folder]
            known = fresh if known is None else known.unionByName(fresh)
        folder = f"bitmaps-{uuid.uuid4().hex}"
        if known is not None:
            pairs.join(known, "item").groupBy(
                "grouped", F.bitmap_bucket_number("number").alias("run")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
            ).write.parquet(f"{self.root}/{folder}")
        deliveries = state.get("deliveries", {}) | ({delivery: folder} if known is not None else {})
        return self.log.commit(version, {
            "last": last or state.get("last", 0), "numbers": numbers, "deliveries": deliveries})

    def _bitmaps(self) -> DataFrame | None:
        return self._read(sorted(self.log.latest()[1].get("deliveries", {}).values()))

    def counts(self) -> DataFrame:
        """(grouped, items): how many different items each group has over all deliveries."""
        return _counted(self._bitmaps(), ["grouped"], self.spark)

    def total(self) -> DataFrame:
        """(items): how many different items there are at all."""
        return _counted(self._bitmaps(), [], self.spark)


def _counted(bitmaps: DataFrame | None, by: list[str], spark: SparkSession) -> DataFrame:
    if bitmaps is None:
        return spark.createDataFrame([], ", ".join([*[f"{c} string" for c in by], "items bigint"]))
    merged = bitmaps.groupBy(*by, "run").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("items"))


def numbered(items: DataFrame, after: int) -> DataFrame:
    """(item, number): numbers from ``after`` + 1 on without gaps, in no particular order.

    Items are numbered within parts of their hash; the parts' beginnings, ``NUMBERING`` of
    them, are broadcast.
    """
    parted = items.withColumn("_part", F.pmod(F.xxhash64("item"), F.lit(NUMBERING)))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy("item"))
    return parted.withColumn("_nth", nth).join(F.broadcast(starts), "_part").select(
        "item", (F.lit(after) + F.col("_start") + F.col("_nth")).cast("bigint").alias("number"))
