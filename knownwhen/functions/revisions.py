"""What kind of change is it when a reported value is replaced by another?

All comparisons are made on doubles, so the same boundaries hold wherever the
rules are re-checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownwhen.functions._cols import ColumnOrName, col_of
from knownwhen.functions.values import any_of, computed_once, first_match, ratio

# Fixed values.
MATERIAL_FROM = 0.005
SAME_MAGNITUDE_WITHIN = 0.02
SCALE_POWERS = (-3, -2, -1, 1, 2, 3)
SCALE_BAND = (0.99, 1.01)
FIRST_REPORT = "FIRST_REPORT"
UNIT_SCALE = "UNIT_SCALE"
IMMATERIAL = "IMMATERIAL"
SIGN_FLIP = "SIGN_FLIP"
RESTATEMENT = "RESTATEMENT"


def relative_change(before: ColumnOrName, after: ColumnOrName) -> Column:
    """|after - before| / |before|; NULL without a non-zero ``before``."""
    b, a = col_of(before).cast("double"), col_of(after).cast("double")
    return ratio(F.abs(a - b), F.abs(b))


def size_ratio(before: ColumnOrName, after: ColumnOrName) -> Column:
    """|after / before|; NULL when either is zero."""
    return F.nullif(F.abs(ratio(after, before)), F.lit(0.0))


def near_power_of_ten(factor: ColumnOrName) -> Column:
    low, high = SCALE_BAND
    return any_of([
        col_of(factor).between(low * 10 ** k, high * 10 ** k) for k in SCALE_POWERS])


def sign_reversed(before: ColumnOrName, after: ColumnOrName) -> Column:
    return F.signum(col_of(before)) * F.signum(col_of(after)) < 0


def magnitude_kept(before: ColumnOrName, after: ColumnOrName) -> Column:
    return relative_change(F.abs(col_of(before)), F.abs(col_of(after))) < SAME_MAGNITUDE_WITHIN


def with_revision(rows: DataFrame, before: str, after: str) -> DataFrame:
    """Add ``pct_change`` and ``change_class`` for ``before`` being replaced by ``after``.

    The class tests the doubles and the quotients many times over, and wide decimals are slow
    to convert, so these are worked out once.
    """
    pair = F.struct(F.col(before).cast("double").alias("before"),
                    F.col(after).cast("double").alias("after"))

    def measured(p: Column) -> Column:
        return F.struct(
            p["before"].alias("before"), p["after"].alias("after"),
            size_ratio(p["before"], p["after"]).alias("factor"),
            relative_change(p["before"], p["after"]).alias("change"))

    def named(m: Column) -> Column:
        return first_match(
            {
                UNIT_SCALE: near_power_of_ten(m["factor"]),
                IMMATERIAL: m["change"] < MATERIAL_FROM,
                SIGN_FLIP: sign_reversed(m["before"], m["after"])
                & magnitude_kept(m["before"], m["after"]),
            },
            otherwise=RESTATEMENT)

    told = F.col(before).isNotNull()
    change_class = computed_once(pair, lambda p: computed_once(measured(p), named))
    return rows.withColumns({
        "pct_change": F.when(told, computed_once(
            pair, lambda p: relative_change(p["before"], p["after"]))),
        "change_class": F.when(told, change_class).otherwise(FIRST_REPORT)})
