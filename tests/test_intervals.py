import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from knownwhen.functions.revisions import with_revision
from knownwhen.operators import asof, dedup
from knownwhen.operators import timeline as tl
from knownwhen.plans import gold, invariants
from tests.helpers import (
    OPEN, as_by_hand, by_hand, fact, filings_of, frame, in_slices, intervals, timeline)


def values(rows):
    return [int(r.value) for r in rows]


def test_later_acceptance_replaces_whatever_the_input_order(spark):
    got = timeline(spark, [fact(200, "2024-01-01"), fact(100, "2022-01-01")])
    assert values(got) == [100, 200]
    assert got[0].known_to_ts == datetime(2024, 1, 1)
    assert got[1].known_to_ts == OPEN and got[1].is_current and not got[0].is_current


def test_equal_instants_do_not_depend_on_input_order(spark):
    a = fact(100, "2022-01-01 09:00:00", adsh="a-22-000001")
    b = fact(200, "2022-01-01 09:00:00", adsh="a-22-000002")
    one, two = timeline(spark, [a, b]), timeline(spark, [b, a])
    assert one == two and values(one) == [200]
    assert one[0].source_adsh == "a-22-000002"


def test_repeats_open_nothing(spark):
    got = timeline(spark, [fact(100, f"{y}-01-01") for y in (2022, 2023, 2024)])
    assert len(got) == 1 and got[0].revision_seq == 1 and got[0].known_to_ts == OPEN


def test_return_to_an_old_value_is_news(spark):
    got = timeline(spark, [fact(100, "2022-01-01"), fact(200, "2023-01-01"),
                           fact(100, "2024-01-01")])
    assert values(got) == [100, 200, 100]
    assert [r.revision_seq for r in got] == [1, 2, 3]


def test_unknown_never_replaces(spark):
    got = timeline(spark, [fact(100, "2022-01-01"), fact(None, "2023-01-01")])
    assert values(got) == [100] and got[0].known_to_ts == OPEN


@pytest.mark.parametrize("rows", [[fact(None, "2022-01-01")], []])
def test_nothing_known_gives_nothing(spark, rows):
    assert timeline(spark, rows) == []


MESSY = [fact(v, at) for v, at in [
    (100, "2020-03-01"), (100, "2020-08-01"), (150, "2021-03-01"), (150, "2021-08-01"),
    (90, "2022-03-01"), (None, "2022-08-01"), (90, "2023-03-01"), (200, "2024-03-01")]]


def test_messy_sequence_keeps_every_invariant(spark):
    facts = frame(spark, MESSY)
    pit = intervals(spark, MESSY)
    assert values(pit.orderBy("known_from_ts").collect()) == [100, 150, 90, 200]
    report = invariants.report(pit, filings_of(facts)).collect()
    assert len(report) == 6 and all(r.passed and r.checked > 0 for r in report)


def test_keys_have_their_own_timelines(spark):
    got = timeline(spark, [fact(100, "2022-01-01"), fact(200, "2023-01-01", tag="ASSETS")])
    assert [(r.canonical_tag, int(r.value), r.revision_seq) for r in got] == [
        ("ASSETS", 200, 1), ("REVENUE", 100, 1)]


@pytest.mark.parametrize("when,expected", [
    ("2020-01-01", None), ("2021-01-01", None), ("2022-02-15", None), ("2022-02-16", 100),
    ("2023-06-01", 100), ("2024-02-22 23:59:59", 100), ("2024-02-23", 70), ("2026-01-01", 70)])
def test_as_of_is_inclusive_then_exclusive_and_absent_before(spark, when, expected):
    pit = intervals(spark, [fact(100, "2022-02-16"), fact(70, "2024-02-23")])
    got = [int(r.value) for r in asof.as_of(pit, when).collect()]
    assert got == ([] if expected is None else [expected])


CLASSES = [
    (None, 100, "FIRST_REPORT"), (1000, 1002, "IMMATERIAL"), (1000, 1_000_000, "UNIT_SCALE"),
    (1000, -1000, "SIGN_FLIP"), (1000, 1500, "RESTATEMENT"), (168_864, 134_038, "RESTATEMENT"),
    (-327_673_000, 239_000_000, "RESTATEMENT"), (0, 5, "RESTATEMENT"), (5, 0, "RESTATEMENT"),
    (1000, -1_000_000, "UNIT_SCALE"), (100, 990, "UNIT_SCALE"), (100, 1010, "UNIT_SCALE"),
    (100, 989, "RESTATEMENT"), (1000, 1005, "RESTATEMENT"), (1000, -1019, "SIGN_FLIP"),
    (1000, -1020, "RESTATEMENT"), ("99999999999999999999999", "-99999999999999999999999", "SIGN_FLIP")]


def test_classes_and_their_boundaries(spark):
    rows = [(i, None if b is None else Decimal(str(b)), Decimal(str(a)))
            for i, (b, a, _) in enumerate(CLASSES)]
    df = spark.createDataFrame(rows, "i int, b decimal(28,4), a decimal(28,4)")
    got = {r.i: r.change_class for r in with_revision(df, "b", "a").collect()}
    assert [got[i] for i in range(len(CLASSES))] == [c for _, _, c in CLASSES]


def test_change_from_and_to_zero(spark):
    got = timeline(spark, [fact(0, "2022-01-01"), fact(5, "2023-01-01"), fact(0, "2024-01-01")])
    assert [r.pct_change for r in got] == [None, None, 1.0]


def test_restated_revenue_of_a_large_company(spark):
    rows = [fact(168_864_000_000, "2022-02-16 06:30:00", cik=732717),
            fact(134_038_000_000, "2023-02-13 16:12:00", cik=732717)]
    pit = intervals(spark, rows)
    feed = gold.fact_revision(pit).collect()
    assert len(feed) == 1 and round(feed[0].pct_change, 3) == 0.206
    assert feed[0].revised_at_ts == datetime(2023, 2, 13, 16, 12)
    assert values(asof.as_of(pit, "2022-06-01").collect()) == [168_864_000_000]
    assert values(asof.as_of(pit, "2026-08-01").collect()) == [134_038_000_000]
    assert asof.as_of(pit, "2022-01-15").count() == 0


def test_sign_change_with_another_magnitude_is_a_restatement(spark):
    got = timeline(spark, [fact(-327_673_000, "2022-02-10 16:36:00"),
                           fact(239_000_000, "2023-02-15 16:44:00")])
    assert got[1].change_class == "RESTATEMENT" and round(got[1].pct_change, 4) == 1.7294


def test_same_second_gives_one_interval_of_positive_width(spark):
    got = timeline(spark, [fact(100, "2020-11-18 16:16:00", adsh="20-000001"),
                           fact(200, "2020-11-18 16:16:00", adsh="20-000002")])
    assert values(got) == [200] and got[0].known_from_ts < got[0].known_to_ts


TWICE = [fact(988507, "2011-11-10 16:01:00", adsh="11-17"),
         fact(156247, "2012-11-08 16:32:00", adsh="12-70"),
         fact(988507, "2012-11-08 16:32:00", adsh="12-70"),
         fact(989000, "2013-03-14 16:15:00", adsh="13-06")]


def test_one_filing_that_reports_twice_counts_its_larger_value(spark):
    assert values(timeline(spark, TWICE)) == [988507, 989000]
    best = dedup.one_per_filing(frame(spark, TWICE), gold.KEY, "adsh", "value")
    assert sorted(values(best.collect())) == [988507, 988507, 989000]


def test_larger_is_meant_with_its_sign(spark):
    rows = [fact(-100, "2022-01-01", adsh="x"), fact(-20, "2022-01-01", adsh="x")]
    assert values(timeline(spark, rows)) == [-20]


def test_amendments_are_flagged(spark):
    got = timeline(spark, [fact(1, "2022-01-01"), fact(9, "2022-02-01", form="10-K/A")])
    assert [r.is_amendment for r in got] == [False, True]


def _random_rows(seed, keys=6, n=400, instants=40):
    rng = random.Random(seed)
    days = [f"2020-{1 + i % 12:02d}-{1 + i // 12:02d} {i % 3:02d}:00:00" for i in range(instants)]
    rows = []
    for _ in range(n):
        at, cik = rng.choice(days), rng.choice([1, 1, 1, 2, 3])
        rows.append(fact(rng.choice([None, 1, 1, 2, 3, -3]), at, cik=cik,
                         adsh=f"{cik}-{at}-{rng.randint(0, 1)}",
                         tag=f"T{rng.randint(0, keys)}"))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [None, 1, 7, 30])
def test_both_plans_agree_with_a_hand_scan(spark, seed, limit):
    """A limit forces slices; company 1 holds most rows, as a hot key would."""
    rows = _random_rows(seed)
    options = {} if limit is None else {"limit": limit}
    got = intervals(spark, rows, today=True, **options).collect()
    expected = by_hand(rows)
    assert as_by_hand(got) == expected
    final = {e[0]: e[1] for e in expected if e[3] == OPEN}
    assert all(r.current_value == final[
        (r.cik, r.canonical_tag, r.ddate.isoformat(), r.qtrs, r.uom)] for r in got)


@pytest.mark.parametrize("limit", [3, 50_000])
def test_second_build_agrees(spark, limit):
    rows = _random_rows(9)
    again = invariants.rebuilt(in_slices(frame(spark, rows), limit))
    result = invariants.equivalence(intervals(spark, rows), again).first()
    assert result.keys_built == result.keys_rebuilt == result.keys_in_both > 0
    assert (result.keys_differing, result.keys_only_built, result.keys_only_rebuilt) == (0, 0, 0)


def test_equivalence_sees_a_difference(spark):
    rows = _random_rows(9)
    pit = intervals(spark, rows)
    broken = pit.withColumn("value", F.when(F.col("revision_seq") == 2, 77).otherwise(F.col("value"))
                            .cast("decimal(28,4)"))
    assert invariants.equivalence(pit, broken).first().keys_differing > 0
    gone = pit.where("canonical_tag <> 'T0'")
    assert invariants.equivalence(pit, gone).first().keys_only_built > 0


@pytest.mark.parametrize("limit", [2, 1000])
def test_checks_count_broken_rows(spark, limit):
    rows = [fact(v, f"2022-0{i + 1}-01") for i, v in enumerate((1, 2, 3, 4))]
    facts = frame(spark, rows)
    pit = intervals(spark, rows)
    late = F.expr("CASE WHEN revision_seq = 2 THEN known_to_ts + INTERVAL 5 DAY "
                  "WHEN revision_seq = 3 THEN known_from_ts ELSE known_to_ts END")
    bad = pit.withColumn("known_to_ts", late)
    followed = invariants.with_following(bad, filings_of(facts), limit)
    assert followed.where("next_from < known_to_ts").count() == 1
    assert followed.where("next_from <> known_to_ts").count() == 2
    assert invariants.no_zero_width(bad).first().violations == 1
    assert invariants.seq_contiguous(pit.where("revision_seq <> 2")).first().violations == 1
    assert invariants.one_open(pit.where("NOT is_current")).first().violations == 1
    moved = filings_of(facts).withColumn("accepted_ts", F.expr("accepted_ts + INTERVAL 1 DAY"))
    assert invariants.source_match(pit, moved).first().violations == 4


def test_slices_are_bounded_and_keep_an_instant_together(spark):
    rows = [fact(i, f"2020-01-{1 + i % 28:02d} {i // 28:02d}:00:00", adsh=str(i))
            for i in range(280)]
    filings = filings_of(frame(spark, rows))
    assert tl.plan_slices(filings, ["cik"], "accepted_ts", 280).count() == 0
    slices = tl.plan_slices(filings, ["cik"], "accepted_ts", 50)
    cut = tl.in_slices(filings, slices, ["cik"], "accepted_ts")
    sizes = [r["count"] for r in cut.groupBy(tl.SLICE).count().collect()]
    assert sum(sizes) == 280 and max(sizes) <= 50 + 10 and len(sizes) >= 5


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_plans(spark, small):
    """With and without broadcasts; the second shuffles facts and filings, as a cluster would."""
    from verification.queries import knowledge_intervals
    plan = _plan(knowledge_intervals(spark, small))
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(knowledge_intervals(spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan


def test_grid_joins_nothing(spark, small):
    from verification.queries import asof_grid, bias_window
    for query in (asof_grid, bias_window):
        assert "NestedLoop" not in _plan(query(spark, small))


def test_plans_are_made_without_a_job(spark, small, monkeypatch):
    """No count decides a plan: nothing runs before the query's own action."""
    from knownwhen.sources import driver_tables
    from verification import queries
    read = {n: driver_tables.table(spark, small, n) for n in ("orders", "lineitem")}
    monkeypatch.setattr(driver_tables, "table", lambda spark, folder, name: read[name])
    tracker = spark.sparkContext.statusTracker()
    for name in ("knowledge_intervals", "change_points", "scd2_build", "inv_i3_no_gap", "asof_grid",
                 "snapshot_rates", "concept_coverage"):
        spark.sparkContext.setJobGroup(f"plan {name}", name)
        queries.QUERIES[name](spark, small)
        assert list(tracker.getJobIdsForGroup(f"plan {name}")) == []
    spark.sparkContext.setJobGroup("tests", "tests")


@pytest.mark.parametrize("limit", [5, 50])
def test_full_days_are_cut_too(spark, limit):
    rows = [fact(i % 7, f"2020-01-{1 + i // 100:02d} {i % 24:02d}:{i % 60:02d}:00", adsh=str(i))
            for i in range(300)]
    got = intervals(spark, rows, limit=limit).collect()
    assert as_by_hand(got) == by_hand(rows)
    filings = filings_of(frame(spark, rows))
    slices = tl.plan_slices(filings, ["cik"], "accepted_ts", limit)
    cut = tl.in_slices(filings, slices, ["cik"], "accepted_ts")
    sizes = [r["count"] for r in cut.groupBy(tl.SLICE).count().collect()]
    assert max(sizes) <= 3 * limit and len(sizes) >= 300 // (3 * limit)


def test_as_of_reaches_the_scan(spark, small):
    from knownwhen.sources.shared import settle
    from verification.queries import pit
    stored = settle(pit(spark, small), "pit")
    read = asof.as_of(stored, "1998-06-30").select("cik", "value")
    plan = spark._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "formatted")
    assert "LessThanOrEqual(known_from_ts" in plan and "GreaterThan(known_to_ts" in plan
    assert "ReadSchema: struct<cik:bigint,value:decimal(28,4),known_from_ts" in plan
    assert "Window" not in plan
