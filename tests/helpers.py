"""Facts from short notes, and a plain-Python statement of the rules to check against."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from knownwhen.operators import timeline as tl
from knownwhen.plans import gold

FACT = ("cik bigint, canonical_tag string, ddate string, qtrs int, uom string, "
        "value decimal(28,4), adsh string, accepted_ts string, form string, statement string")
OPEN = datetime(9999, 12, 31)


def fact(value, at, adsh=None, cik=1, tag="REVENUE", ddate="2021-12-31", qtrs=4, form="10-K"):
    return (cik, tag, ddate, qtrs, "USD", None if value is None else Decimal(str(value)),
            adsh or f"filing of {at}", at, form, "IS")


def frame(spark, rows):
    return spark.createDataFrame(rows, FACT).withColumns({
        "ddate": F.col("ddate").cast("date"), "qtrs": F.col("qtrs").cast("smallint"),
        "accepted_ts": F.col("accepted_ts").cast("timestamp_ntz")})


def filings_of(facts):
    return facts.select("adsh", "cik", "accepted_ts", "form").distinct()


def in_slices(facts, limit=tl.SLICE_INSTANTS):
    slices = tl.plan_slices(filings_of(facts), ["cik"], "accepted_ts", limit)
    return tl.in_slices(facts, slices, ["cik"], "accepted_ts")


def intervals(spark, rows, limit=tl.SLICE_INSTANTS, **options):
    return gold.fundamental_pit(in_slices(frame(spark, rows), limit), **options)


def timeline(spark, rows, **options):
    got = intervals(spark, rows, **options)
    return got.orderBy("cik", "canonical_tag", "known_from_ts").collect()


def by_hand(rows):
    """(key, value, from, to, seq, previous) by scanning sorted facts of each key."""
    keys, out = {}, []
    for r in rows:
        if r[5] is not None:
            keys.setdefault(r[:5], []).append((datetime.fromisoformat(r[7]), r[6], r[5]))
    for key, told in keys.items():
        last_told = {}
        for at, adsh, value in sorted(told):
            last_told[at] = value
        runs = []
        for at, value in sorted(last_told.items()):
            if not runs or runs[-1][1] != value:
                runs.append((at, value))
        for i, (at, value) in enumerate(runs):
            end = runs[i + 1][0] if i + 1 < len(runs) else OPEN
            out.append((key, value, at, end, i + 1, runs[i - 1][1] if i else None))
    return sorted(out, key=str)


def as_by_hand(collected):
    return sorted((
        ((r.cik, r.canonical_tag, r.ddate.isoformat(), r.qtrs, r.uom), r.value,
         r.known_from_ts, r.known_to_ts, r.revision_seq, r.prev_value) for r in collected), key=str)
