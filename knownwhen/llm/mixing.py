"""Mixing sources to target weights with a low-discrepancy schedule. DataFrame operations only.

* A source's documents, in an order set by a hash of their id, form one stream of
  words, cut into blocks of ``BLOCK`` words: the shuffled equal-token blocks.
* Targets: the sources share ``SHARE`` times all words by weight; no target exceeds
  ``EPOCHS`` times its source, and what is cut off goes to the others by weight.
* Slot n of the mix gets the point frac(n * golden ratio), which falls into one
  source's part of the cumulative target shares. Slots are ranked within their
  source, and the slot of rank r takes block r mod (number of blocks), so a block
  comes again only after all others, and never more than ``EPOCHS`` times.

Every prefix of the schedule is close to the target shares, whatever the sizes.
Running sums over a source (ranks of slots, places in a stream) are taken in two
steps, inside pieces and over piece totals, since one source may hold most rows.

Defined results: a null text has size 0; documents of size 0 take nothing. A null
source is a source of its own and comes last. Rows that repeat a document count
separately. Weights repeat in code-point order of the sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from knownwhen.sources.shared import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
BLOCK = 64
WORD = r"[^\x20\x09-\x0D]+"
#: Equal parts of [0, 1) by which points find their source.
GRID = 4096
#: frac of the golden ratio, and of 2 ** 20 times it: n is split so that doubles suffice.
GOLDEN, GOLDEN_20 = 0.6180339887498949, 0.7087122380733490
LOW = 1 << 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _bits(rows: int) -> int:
    """So many pieces (as a power of two) that pieces and rows in a piece both stay few."""
    return max(1, math.ceil(math.log2(max(2, rows)) / 2) + 1)


def running(df: DataFrame, group: str, piece: str, order: list, value: Column, name: str
            ) -> DataFrame:
    """``name``: the sum of ``value`` over the group's earlier rows. ``piece`` must follow the
    order, so that whole earlier pieces can be added as totals. Groups may be null."""
    totals = df.groupBy(group, piece).agg(F.sum(value).alias("_total"))
    before = F.sum("_total").over(
        W.partitionBy(group).orderBy(piece).rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select(F.col(group).alias("_group"), F.col(piece).alias("_piece"),
                           F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(value).over(
        W.partitionBy(group, piece).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    rows = df.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    same = rows[group].eqNullSafe(totals["_group"]) & (rows[piece] == totals["_piece"])
    return rows.join(totals, same).withColumn(
        name, F.col("_before") + F.col("_inside")).drop("_group", "_piece", "_before", "_inside")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, key): what the mix has to know of a document."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target, low, high): targets, and parts of [0, 1) in their ratio."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((place - 1) % len(weights) + 1).cast("int"))
    per = per.withColumns({"place": place, "weight": weight,
                           "cap": F.lit(float(epochs)) * F.col("source_size")})
    # Sources in the order in which a rising level (words per weight) reaches their caps.
    rise = W.orderBy(F.col("cap") / F.col("weight"), "place")
    total = F.sum("source_size").over(W.partitionBy())
    filled = F.coalesce(F.sum("cap").over(rise.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(rise.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("level", (F.lit(share) * total - filled) / rest)
    free = F.col("cap") > F.col("weight") * F.col("level")
    level = F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(
        W.partitionBy())["level"]
    per = per.withColumn("target", F.least("cap", F.coalesce(F.col("weight") * level, F.col("cap"))))
    whole = F.nullif(F.sum("target").over(W.partitionBy()), F.lit(0.0))
    per = per.withColumn("high", F.sum("target").over(
        W.orderBy("place").rowsBetween(W.unboundedPreceding, 0)) / whole)
    low = F.coalesce(F.lag("high").over(W.orderBy("place")), F.lit(0.0))
    return per.select("source", "source_size", "target", low.alias("low"), "high")


def _frac(x: Column) -> Column:
    return x - F.floor(x)


def point(slot: Column) -> Column:
    """frac(slot * golden ratio)."""
    low = (slot % LOW).cast("double") * F.lit(GOLDEN)
    high = F.floor(slot / LOW).cast("double") * F.lit(GOLDEN_20)
    return _frac(_frac(low) + _frac(high))


def schedule(spark: SparkSession, goals: DataFrame, slots: int) -> DataFrame:
    """(slot, source, rank): which source a slot belongs to, and its place among that source's."""
    grid = F.explode(F.sequence(F.floor(F.col("low") * GRID),
                                F.least(F.floor(F.col("high") * GRID), F.lit(GRID - 1))))
    parts = goals.filter("high > low").select("source", "low", "high", grid.alias("cell"))
    last = F.col("high") >= F.max("high").over(W.partitionBy())  # so that no point is left over
    parts = parts.withColumn("high", F.when(last, F.lit(2.0)).otherwise(F.col("high")))
    points = spark.range(slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("at"))
    points = points.withColumn("cell", F.floor(F.col("at") * GRID))
    placed = points.join(parts, "cell").filter("at >= low and at < high").select("slot", "source")
    piece = 1 << _bits(slots)
    placed = placed.withColumn("piece", F.floor(F.col("slot") / piece))
    return running(placed, "source", "piece", ["slot"], F.lit(1), "rank").drop("piece")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        epochs: int = EPOCHS, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs``."""
    spark = docs.sparkSession
    sizes = settle(sized(docs, id_col, text_col, source_col), "mix-sizes")
    goals = settle(targets(sizes, weights, share, epochs), "mix-targets")
    rows, wanted = sizes.count(), goals.agg(F.sum("target")).first()[0] or 0.0
    slots = schedule(spark, goals, math.ceil(wanted / block))

    # How often the mix takes each block of a source.
    blocks = F.ceil(F.col("source_size") / block)
    of = goals.select(F.col("source").alias("_source"), "source_size")
    taken = slots.join(of, slots["source"].eqNullSafe(of["_source"])).filter(
        F.col("rank") < F.lit(epochs) * blocks)
    taken = taken.groupBy("source", (F.col("rank") % blocks).alias("block")).agg(
        F.count(F.lit(1)).alias("times")).select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "times")

    # Where each document lies in its source's stream, and the blocks it touches.
    shift = 32 - _bits(rows)
    number = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = sizes.filter("size > 0").withColumn("piece", F.shiftright(number, shift))
    placed = running(placed, "source", "piece", ["key", "doc_id", "size"], F.col("size"), "begin")
    end = F.col("begin") + F.col("size")
    touched = placed.select("source", "begin", end.alias("end"), F.explode(F.sequence(
        F.floor(F.col("begin") / block), F.floor((end - 1) / block))).alias("block"))
    words = (F.least("end", (F.col("block") + 1) * block)
             - F.greatest("begin", F.col("block") * block))
    used = touched.join(taken, touched["source"].eqNullSafe(taken["_source"])
                        & (touched["block"] == taken["_block"]))
    used = used.groupBy("source", "begin").agg(F.sum(words * F.col("times")).alias("taken")).select(
        F.col("source").alias("_source"), F.col("begin").alias("_begin"), "taken")
    found = placed.join(used, placed["source"].eqNullSafe(used["_source"])
                        & (placed["begin"] == used["_begin"]), "left").select(
        "doc_id", "size", "source", "taken")
    empty = sizes.filter("size = 0").select("doc_id", "size", "source", F.lit(0).alias("taken"))
    every = found.unionByName(empty)
    goals = goals.select(F.col("source").alias("_source"), "source_size", "target")
    return every.join(goals, every["source"].eqNullSafe(goals["_source"])).select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
