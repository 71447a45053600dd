"""Equal-sized rank groups, also when one group of rows is very large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.sources.shared import settle


def ntile(rows: DataFrame, by: list[str], order: list[Column], tiles: int, out: str) -> DataFrame:
    """Add the ``tiles``-quantile number within each ``by`` group as ``out``.

    ``order`` must be total. Rows are range-sorted across the cluster and numbered
    from partition totals, so a group may be of any size.
    """
    numbered = with_position(rows, by, order)
    size = F.col("_size").cast("long")
    base, longer = F.floor(size / tiles), size % tiles
    in_longer = longer * (base + 1)
    at = F.col("_position") - 1
    tile = F.when(at < in_longer, F.floor(at / (base + 1)) + 1).otherwise(
        longer + F.floor((at - in_longer) / F.greatest(base, F.lit(1))) + 1)
    return numbered.withColumn(out, tile.cast("int")).drop("_position", "_size")


def with_position(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """Add the 1-based ``_position`` and the ``_size`` of each row's group.

    Rows are range-partitioned on (group, order), so a large group spreads over
    many partitions. The sorted rows are written once, which fixes the
    partition of every row; group totals per partition then give the offsets.
    That table has at most (groups + partitions) rows.
    """
    # The id counts up within a partition and its high bits are the partition.
    placed = (
        rows.repartitionByRange(*[F.col(c) for c in by], *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    fixed = settle(placed, "ranked").withColumn("_piece", F.shiftright("_id", 33))
    pieces = fixed.groupBy(*by, "_piece").agg(
        F.min("_id").alias("_first_id"), F.count("*").alias("_rows"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *by, "_piece", "_first_id",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(group).alias("_size"))
    return (
        fixed.join(offsets, [*by, "_piece"])
        .withColumn("_position", F.col("_offset") + F.col("_id") - F.col("_first_id") + 1)
        .drop("_id", "_piece", "_first_id", "_offset")
    )
