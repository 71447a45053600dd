"""Rows laid out along a Z-order curve, so that several columns prune files at once.

A lexicographic layout prunes by its first column and hardly by the others. Along the
curve rows that are near in *every* column lie in the same files.

Each column is cut at quantiles of all its rows (one aggregate, ``2 ** bits - 1`` numbers a
column), so a column's ranges hold about as many rows each, however its values are spread. A
binary search gives a row's range, and a list the ranges' numbers with their bits already
spread out, so the place on the curve is a sum of one look-up per column. (Written out as a
tree of comparisons it is a method too long for the JVM to compile.)

Columns are numbers, dates or timestamps; nulls come first. A value that fills several
ranges is one range: rows of one company then differ by the other columns only, and since
files are cut by place *and* columns, one place that holds many rows is spread over files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

BITS = 6
ACCURACY = 10_000


def edges(rows: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Where each column is cut: distinct quantiles of all rows, in order."""
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = rows.agg(*[F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or ())) for c in columns}


def place(rows: DataFrame, cuts: Mapping[str, Sequence], bits: int = BITS) -> Column:
    """The place of a row on the curve through ``cuts``; the first column has the highest bits."""
    total = F.lit(0).cast("long")
    for n, (name, at) in enumerate(cuts.items()):
        # Few ranges are spread over all numbers, or their column would only have low bits.
        numbers = [i * 2 ** bits // (len(at) + 1) for i in range(len(at) + 1)]
        codes = [_spread(i, bits, len(cuts), len(cuts) - 1 - n) for i in numbers]
        kind = rows.schema[name].dataType
        total = total + F.when(F.col(name).isNull(), codes[0]).otherwise(
            _range_code(F.col(name), at, codes, kind))
    return total


def _spread(number: int, bits: int, step: int, shift: int) -> int:
    return sum((number >> b & 1) << (b * step + shift) for b in range(bits))


def _range_code(value: Column, at: Sequence, codes: Sequence[int], kind: DataType) -> Column:
    """The code of the range, whose number is how many cuts are not above the value: a binary
    search, one step per bit."""
    if not at:
        return F.lit(codes[0])
    cuts = F.array(*[F.lit(str(x)).cast(kind) for x in at])
    steps = F.array(*[F.lit(2 ** b) for b in reversed(range(len(at).bit_length()))])
    number = F.aggregate(steps, F.lit(0), lambda i, step: i + F.when(
        F.coalesce(F.get(cuts, i + step - 1) <= value, F.lit(False)), step).otherwise(0))
    return F.get(F.array(*[F.lit(c).cast("long") for c in codes]), number)


def along_curve(rows: DataFrame, columns: Sequence[str], bits: int = BITS,
                files: int | None = None) -> DataFrame:
    """``rows`` clustered by their place on the curve, in about ``files`` files if written.

    ``rows`` are read three times (quantiles, cuts of the files, rows), so costly ones
    should be settled before.
    """
    if bits * len(columns) > 62:
        raise ValueError("the curve has more than 62 bits")
    name = "_place"
    while name in rows.columns:
        name += "_"
    placed = rows.withColumn(name, place(rows, edges(rows, columns, bits), bits))
    by = [name, *columns]
    ranged = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by).drop(name)


def extents(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """(file, n_rows, least, most) of a stored table; ``least`` and ``most`` are structs of
    ``columns``, as the footers' statistics say."""
    cols = list(columns)
    return spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.struct(*[F.min(c).alias(c) for c in cols]).alias("least"),
        F.struct(*[F.max(c).alias(c) for c in cols]).alias("most"))


def files_between(files: DataFrame, column: str, low, high) -> DataFrame:
    """Those of :func:`extents` that a reader of ``low <= column <= high`` can't skip."""
    return files.filter((F.col(f"most.{column}") >= F.lit(low))
                        & (F.col(f"least.{column}") <= F.lit(high)))
