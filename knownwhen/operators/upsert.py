"""Keyed changes to a state table, as joins (plain files have no MERGE)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def one_per_key(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: the largest by its columns from left to right, NULL smallest.

    Maps have no order and don't count.
    """
    order = [F.col(f.name).desc_nulls_last() for f in rows.schema.fields
             if f.name not in key and not isinstance(f.dataType, T.MapType)]
    window = Window.partitionBy(*key).orderBy(*(order or [F.lit(0)]))
    return rows.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def insert_missing(known: DataFrame, offered: DataFrame, key: list[str]) -> DataFrame:
    """``known`` plus the offered rows whose key it lacks; known rows stay as they are.

    Of several offers for one key :func:`one_per_key` counts.
    """
    new = one_per_key(offered.join(known.select(*key), key, "left_anti"), key)
    return known.unionByName(new, allowMissingColumns=True).select(*known.columns)


def apply_updates(known: DataFrame, updates: DataFrame, key: list[str],
                  assign: dict[str, str]) -> DataFrame:
    """Set columns of ``known`` where ``updates`` has the key.

    ``assign`` maps a column to SQL over ``old`` and ``new``. Keys that are not
    known are ignored, as UPDATE does, and rows never multiply: of several updates
    of one key :func:`one_per_key` counts.
    """
    updates = one_per_key(updates, key)
    hit = updates.select(F.struct(*updates.columns).alias("new"), *key)
    both = known.select(F.struct(*known.columns).alias("old"), *key).join(hit, key, "left")
    return both.select(*[
        F.when(F.col("new").isNotNull(), F.expr(assign[c]).cast(known.schema[c].dataType))
         .otherwise(F.col(f"old.{c}")).alias(c)
        if c in assign else F.col(f"old.{c}").alias(c)
        for c in known.columns])
