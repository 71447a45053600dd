"""Checks over the whole interval table, and a second way to build it.

Each check is one row: its name, the number of violations, and how much was checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.functions.values import open_end
from knownwhen.operators import timeline as tl
from knownwhen.plans.gold import KEY
from knownwhen.sources.shared import settle


def _result(name: str, violation: Column, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(violation).alias("violations"),
                    F.count(F.lit(1)).alias("checked")).select(
        F.lit(name).alias("check"), "violations", "checked")


def with_following(pit: DataFrame, filings: DataFrame,
                   limit: int = tl.SLICE_INSTANTS) -> DataFrame:
    """Intervals with the start of the next interval of their key."""
    slices = tl.plan_slices(filings, ["cik"], "accepted_ts", limit)
    rows = pit.select(*KEY, "known_from_ts", "known_to_ts")
    rows = tl.in_slices(rows, slices, ["cik"], "known_from_ts")
    return tl.with_next(rows, KEY, "known_from_ts", ["known_to_ts"], "next_from")


def no_overlap(pit: DataFrame, filings: DataFrame) -> DataFrame:
    return _result("I1_no_overlap", F.col("next_from") < F.col("known_to_ts"),
                   with_following(pit, filings))


def no_gap(pit: DataFrame, filings: DataFrame) -> DataFrame:
    return _result("I3_no_gap", F.col("next_from") != F.col("known_to_ts"),
                   with_following(pit, filings))


def one_open(pit: DataFrame, filings: DataFrame | None = None) -> DataFrame:
    per_key = pit.groupBy(*KEY).agg(F.count_if(F.col("is_current")).alias("n_open"))
    return _result("I2_one_open", F.col("n_open") != 1, per_key)


def source_match(pit: DataFrame, filings: DataFrame) -> DataFrame:
    starts = pit.select(F.col("source_adsh").alias("adsh"), "known_from_ts")
    both = starts.join(filings.select("adsh", "accepted_ts"), "adsh")
    return _result("I4_source_match", F.col("known_from_ts") != F.col("accepted_ts"), both)


def no_zero_width(pit: DataFrame, filings: DataFrame | None = None) -> DataFrame:
    return _result("I4b_zero_width", F.col("known_from_ts") >= F.col("known_to_ts"), pit)


def seq_contiguous(pit: DataFrame, filings: DataFrame | None = None) -> DataFrame:
    per_key = pit.groupBy(*KEY).agg(
        F.max("revision_seq").alias("last_seq"), F.count(F.lit(1)).alias("n"))
    return _result("I6_seq_contiguous", F.col("last_seq") != F.col("n"), per_key)


CHECKS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "inv_i1_no_overlap": no_overlap,
    "inv_i2_one_open": one_open,
    "inv_i3_no_gap": no_gap,
    "inv_i4_source_match": source_match,
    "inv_i4b_zero_width": no_zero_width,
    "inv_i6_seq_contiguous": seq_contiguous,
}


def report(pit: DataFrame, filings: DataFrame) -> DataFrame:
    """All checks as one table. ``pit`` should be a stored table: it is read once per check."""
    out = None
    for check in CHECKS.values():
        row = check(pit, filings)
        out = row if out is None else out.unionByName(row)
    return out.withColumn("passed", F.col("violations") == 0)


def key_sample(pit: DataFrame, n: int, seed: str) -> DataFrame:
    """``n`` revised keys in an order fixed by ``seed``, whatever the partitioning."""
    keys = pit.where(F.col("revision_seq") > 1).select(*KEY).distinct()
    spot = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in KEY], F.lit(seed)))
    return keys.orderBy(spot, *KEY).limit(n)


def of_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of the given keys, from facts or from intervals."""
    return rows.join(keys, KEY, "left_semi")


# ---------------------------------------------------------------- second build

def rebuilt(attributed: DataFrame) -> DataFrame:
    """Intervals computed from one sorted array per (key, slice), without look-back windows.

    ``attributed`` is joined with sliced filings, so arrays never exceed a slice, and runs
    that continue across a cut are joined from slice edges. The arrays are stored once,
    since runs and edges are both read from them.
    """
    rows = attributed
    part = [*KEY, tl.SLICE]
    # Copies are folded first: largest value of a filing, then the last filing of an instant.
    instants = (
        rows.where(F.col("value").isNotNull())
        .groupBy(*part, "accepted_ts", "adsh").agg(F.max("value").alias("value"))
        .groupBy(*part, "accepted_ts").agg(F.max_by("value", "adsh").alias("value"))
    )
    listed = instants.groupBy(*part).agg(
        F.array_sort(F.collect_list(F.struct("accepted_ts", "value"))).alias("told"))
    runs = listed.select(*part, F.filter(
        "told", lambda x, i: (i == 0) | (x["value"] != F.get("told", i - 1)["value"])
    ).alias("runs"))
    linked = runs.select(
        *part, "runs", F.col("runs")[0]["value"].alias("_head"),
        F.element_at("runs", -1)["value"].alias("_tail"))
    stored = settle(linked, "rebuilt")
    opened = stored.join(_slice_links(stored), part, "left").select(
        *part, F.filter(
            "runs", lambda x, i: (i > 0) | ~F.coalesce("_continues", F.lit(False))
        ).alias("runs"), "_reopens")
    return opened.select(
        *KEY, F.posexplode("runs").alias("_i", "_run"), "runs", "_reopens",
    ).select(
        *KEY, F.col("_run.value").alias("value"), F.col("_run.accepted_ts").alias("known_from_ts"),
        F.coalesce(F.get("runs", F.col("_i") + 1)["accepted_ts"], "_reopens", open_end())
        .alias("known_to_ts"))


def _slice_links(linked: DataFrame) -> DataFrame:
    """For sliced keys: does a slice continue the run before it, and when does the next one open?"""
    order = Window.partitionBy(*KEY).orderBy(tl.SLICE)
    edges = linked.where(F.col(tl.SLICE).isNotNull()).select(
        *KEY, tl.SLICE, F.lag("_tail").over(order).eqNullSafe(F.col("_head")).alias("_continues"),
        F.col("runs")[0]["accepted_ts"].alias("_one"),
        F.get("runs", F.lit(1))["accepted_ts"].alias("_two"))
    after = order.rowsBetween(1, Window.unboundedFollowing)
    opens = F.when(F.col("_continues"), F.col("_two")).otherwise(F.col("_one"))
    return edges.select(*KEY, tl.SLICE, "_continues",
                        F.first(opens, ignorenulls=True).over(after).alias("_reopens"))


def equivalence(pit: DataFrame, again: DataFrame) -> DataFrame:
    """Compare two builds over all keys: keys on either side only, and intervals that differ.

    Both sides are tagged, stacked and counted per interval, so one shuffle serves
    every comparison and nothing is collected.
    """
    columns = [*KEY, "value", "known_from_ts", "known_to_ts"]
    tagged = pit.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        again.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    intervals = tagged.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    keys = intervals.groupBy(*KEY).agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"),
        F.sum(F.abs(F.col("_a") - F.col("_b"))).alias("_differing"))
    return keys.agg(
        F.count_if(F.col("_a") > 0).alias("keys_built"),
        F.count_if(F.col("_b") > 0).alias("keys_rebuilt"),
        F.count_if((F.col("_a") > 0) & (F.col("_b") > 0)).alias("keys_in_both"),
        F.count_if(F.col("_b") == 0).alias("keys_only_built"),
        F.count_if(F.col("_a") == 0).alias("keys_only_rebuilt"),
        F.count_if(F.col("_differing") > 0).alias("keys_differing"),
        F.coalesce(F.sum("_a"), F.lit(0)).alias("intervals"))
