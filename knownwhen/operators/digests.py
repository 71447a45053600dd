"""Do two large tables hold the same rows? Digests first, rows only where these differ.

Both tables are cut into parts by a hash of the key. A part's digest is its number of rows and
two sums of row hashes, so it doesn't depend on order and counts repeated rows; it is
aggregated before it is shuffled, and what is shuffled is a few numbers per task and part. Rows
are compared only in parts whose digests differ, as multisets: each distinct row with how often
either side has it. Two different parts of equal digest would need two 64-bit sums to agree
at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownwhen.sources.shared import settle

# Parts of a table; the list of differing ones, at most this many, is broadcast.
PARTS = 4096
_PART = "_part"


def _row_hash(columns: list[str], salt: int) -> Column:
    """Nulls count: without their flags, a value would hash alike in whichever column it is."""
    return F.xxhash64(F.lit(salt), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def _parted(rows: DataFrame, key: list[str], parts: int) -> DataFrame:
    flags = [x for c in key for x in (F.col(c).isNull(), F.col(c))]
    return rows.withColumn(_PART, F.pmod(F.xxhash64(*flags), F.lit(parts)).cast("int"))


def digest(rows: DataFrame, key: list[str], parts: int = PARTS) -> DataFrame:
    """(part, rows, one, two): one row per part that has rows."""
    columns = sorted(rows.columns)
    sums = [F.sum(_row_hash(columns, salt).cast("decimal(20,0)")).alias(name)
            for salt, name in ((1, "one"), (2, "two"))]
    return _parted(rows, key, parts).groupBy(F.col(_PART).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), *sums)


def differing_parts(a: DataFrame, b: DataFrame) -> DataFrame:
    """(part, rows_a, rows_b) of two digests where they differ."""
    left = a.select("part", F.struct("rows", "one", "two").alias("_a"))
    right = b.select("part", F.struct("rows", "one", "two").alias("_b"))
    both = left.join(right, "part", "full").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return both.select("part", F.coalesce("_a.rows", F.lit(0)).alias("rows_a"),
                       F.coalesce("_b.rows", F.lit(0)).alias("rows_b"))


def differences(a: DataFrame, b: DataFrame, key: list[str], parts: int = PARTS) -> DataFrame:
    """Every distinct row that the tables don't have equally often, with ``in_a`` and ``in_b``."""
    types = {f.name: f.dataType for f in a.schema.fields}
    if types != {f.name: f.dataType for f in b.schema.fields}:
        raise ValueError("the tables differ in their columns")
    found = settle(differing_parts(digest(a, key, parts), digest(b, key, parts)), "differing")
    wanted = F.broadcast(found.select(F.col("part").alias(_PART)))  # at most ``parts`` rows

    def chosen(rows: DataFrame, in_a: int) -> DataFrame:
        return _parted(rows, key, parts).join(wanted, _PART, "left_semi").select(
            *a.columns, F.lit(in_a).alias("_a"), F.lit(1 - in_a).alias("_b"))

    counted = chosen(a, 1).unionByName(chosen(b, 0)).groupBy(*a.columns).agg(
        F.sum("_a").alias("in_a"), F.sum("_b").alias("in_b"))
    return counted.where(F.col("in_a") != F.col("in_b"))
