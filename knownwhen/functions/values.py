"""Scalar helpers: blank tests, lenient parsing, first-match labels, safe ratios."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from knownwhen.functions._cols import ColumnOrName, col_of

VALUE_TYPE = "decimal(28,4)"
OPEN_END = "9999-12-31 00:00:00"


def is_blank(c: ColumnOrName) -> Column:
    """NULL, empty or only spaces."""
    return F.coalesce(F.trim(col_of(c)), F.lit("")) == ""


def day_of(c: ColumnOrName) -> Column:
    """``yyyyMMdd`` text as a date, NULL when it is not one."""
    return F.try_to_date(col_of(c), "yyyyMMdd")


def instant_of(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a zone-free timestamp, NULL when it is not one."""
    return col_of(c).try_cast("timestamp_ntz")


def as_instant(c: ColumnOrName) -> Column:
    """A date at the start of its day."""
    return col_of(c).cast("timestamp_ntz")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def first_match(rules: Mapping[str, Column], otherwise: str | None = None) -> Column:
    """The label of the first rule that is true; rules are tried in mapping order."""
    pairs = list(rules.items())
    head_label, head_rule = pairs[0]
    chain = reduce(lambda c, p: c.when(p[1], p[0]), pairs[1:], F.when(head_rule, head_label))
    return chain.otherwise(F.lit(otherwise))


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used.

    A named column doesn't do that: a filter that is pushed below the projection takes the
    whole expression with it, once for every use.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def ratio(top: ColumnOrName, bottom: ColumnOrName) -> Column:
    """Quotient in double precision, NULL when the divisor is zero.

    Decimal quotients widen until they overflow under ANSI, so ratios are
    always taken on doubles.
    """
    return col_of(top).cast("double") / F.nullif(col_of(bottom).cast("double"), F.lit(0.0))


def rounded(x: ColumnOrName, digits: int) -> Column:
    """Half-up rounding of a double by its decimal value.

    Eight places are settled first, so the last binary digit of a quotient does
    not decide a tie. Numbers too large for that are rounded as they are.
    """
    c = col_of(x)
    settled = F.round(c.try_cast("decimal(38,8)"), digits).cast("double")
    return F.coalesce(settled, F.round(c, digits))


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of ``whole`` that is ``part``, rounded half up."""
    return rounded(ratio(part * F.lit(100.0), whole), digits)


def quarter_token(path: ColumnOrName) -> Column:
    """The ``2024q1`` style token of a ``quarter=`` folder in a file path."""
    return F.regexp_extract(col_of(path), r"quarter=(\d{4}q[1-4])", 1)


def quarter_of(ts: ColumnOrName) -> Column:
    """The ``2024q1`` style token of a timestamp."""
    c = col_of(ts)
    return F.concat(F.year(c).cast("string"), F.lit("q"), F.quarter(c).cast("string"))


def quarter_end(ts: ColumnOrName) -> Column:
    return F.last_day(F.add_months(F.trunc(col_of(ts), "quarter"), 2))
