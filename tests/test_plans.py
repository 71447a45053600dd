import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.functions.revisions import relative_change
from knownwhen.functions.values import rounded
from knownwhen.operators import ranking, upsert
from knownwhen.operators.asof import Quarters, as_of_grid
from knownwhen.plans import (
    concepts, control, dimensions, factors, gold, invariants, monitor, silver, snapshots)
from knownwhen.sources import driver_tables as dt
from knownwhen.sources.shared import settle
from verification.queries import _raw, knowledge_intervals
from tests.helpers import fact, frame, filings_of, intervals


def test_calendar_ends_on_true_month_ends(spark):
    days = [r.rebalance_dt for r in factors.study_calendar().dates(spark).orderBy(
        "rebalance_dt").collect()]
    assert len(days) == 56 and days[0] == date(2012, 3, 31) and days[-1] == date(2025, 12, 31)
    assert {(d.month, d.day) for d in days} == {(3, 31), (6, 30), (9, 30), (12, 31)}


def roa_rows():
    return [
        # Company 1: income restated after the first date, assets constant.
        fact(10, "2021-02-01", cik=1, tag="NET_INCOME", ddate="2020-12-31", adsh="1a"),
        fact(30, "2022-02-01", cik=1, tag="NET_INCOME", ddate="2020-12-31", adsh="1b"),
        fact(100, "2021-02-01", cik=1, tag="Assets", ddate="2020-12-31", qtrs=0, adsh="1a"),
        # Company 2: filed later on the rebalance day itself, so not yet visible that day.
        fact(5, "2021-03-31 10:00:00", cik=2, tag="NET_INCOME", ddate="2020-12-31", adsh="2a"),
        fact(50, "2021-03-31 10:00:00", cik=2, tag="Assets", ddate="2020-12-31", qtrs=0, adsh="2a"),
        # Company 3: assets are not positive.
        fact(5, "2021-02-01", cik=3, tag="NET_INCOME", ddate="2020-12-31", adsh="3a"),
        fact(0, "2021-02-01", cik=3, tag="Assets", ddate="2020-12-31", qtrs=0, adsh="3a"),
        # Company 4: a newer period wins, an old one is out of reach.
        fact(1, "2018-02-01", cik=4, tag="NET_INCOME", ddate="2017-12-31", adsh="4a"),
        fact(7, "2021-02-01", cik=4, tag="NET_INCOME", ddate="2019-12-31", adsh="4b"),
        fact(8, "2021-02-01", cik=4, tag="NET_INCOME", ddate="2020-12-31", adsh="4b"),
        fact(80, "2021-02-01", cik=4, tag="Assets", ddate="2020-12-31", qtrs=0, adsh="4b"),
    ]


def test_comparison_sees_only_what_was_known(spark):
    pit = intervals(spark, roa_rows(), today=True)
    calendar = Quarters.between("2021-03-31", "2021-06-30")
    got = {(r.rebalance_dt.month, r.cik): r for r in factors.roa_comparison(
        pit, calendar, factors.Factor()).collect()}
    assert set(got) == {(3, 1), (6, 1), (6, 2), (3, 4), (6, 4)}
    one = got[3, 1]
    assert (one.pit_ni, one.naive_ni) == (Decimal(10), Decimal(30))
    assert (one.pit_roa, one.naive_roa, one.ni_revised, one.assets_revised) == (.1, .3, True, False)
    assert got[3, 4].pit_ni == Decimal(8) and got[3, 4].ni_ddate == date(2020, 12, 31)


def test_bias_summary(spark):
    rows = [(date(2020, 3, 31), i, i == 0, i % 4 == 0, False, 1 if i in (1, 2) else 2,
             1 if i in (0, 1) else 2) for i in range(20)]
    ranked = spark.createDataFrame(
        rows, "rebalance_dt date, cik long, decile_moved boolean, ni_revised boolean, "
              "assets_revised boolean, pit_decile int, naive_decile int")
    got = factors.bias_by_quarter(ranked).first()
    assert tuple(got)[1:] == (20, 5.0, 25.0, 50.0)
    assert factors.settled_quarters(factors.bias_by_quarter(ranked), "2020-03-31").count() == 0


@pytest.mark.parametrize("n", [3, 10, 25, 101])
def test_spread_ranking_equals_the_window_function(spark, n):
    """One date holds most rows, and many ratios are equal."""
    rows = spark.range(n * 3).select(
        F.when(F.col("id") < n * 2, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 3)).alias("d"),
        (F.col("id") % 4).alias("x"), F.col("id").alias("cik"))
    order = [F.col("x").desc(), F.col("cik").asc()]
    whole = rows.withColumn("tile", F.ntile(10).over(Window.partitionBy("d").orderBy(*order)))
    spread = ranking.ntile(rows, ["d"], order, 10, "tile").select(*whole.columns)
    assert whole.exceptAll(spread).isEmpty() and spread.count() == n * 3


def registrant(cik, at, name, sic="1", fye="1231"):
    return (cik, at, name, sic, fye)


def versions(spark, rows, **options):
    filings = spark.createDataFrame(
        rows, "cik long, accepted_ts string, name string, sic string, fye string"
    ).withColumn("accepted_ts", F.col("accepted_ts").cast("timestamp_ntz"))
    return [(r.cik, r.name, r.fye, r.version_seq, r.is_current) for r in
            dimensions.company_scd2(filings, **options).orderBy("cik", "version_seq").collect()]


@pytest.mark.parametrize("limit", [1, 2, 1000])
def test_company_versions(spark, limit):
    rows = [registrant(1, "2020-01-01", "Old"), registrant(1, "2020-02-01", "Old"),
            registrant(1, "2020-03-01", "New"), registrant(1, "2020-03-01", "Zed"),
            registrant(1, "2020-04-01", "New", fye=None), registrant(1, "2020-05-01", "New", fye=""),
            registrant(1, "2020-06-01", "Old"), registrant(None, "2020-01-01", "x"),
            registrant(2, "2020-01-01", "Two")]
    assert versions(spark, rows, limit=limit) == [
        (1, "Old", "1231", 1, False), (1, "New", "1231", 2, False), (1, "New", None, 3, False),
        (1, "New", "", 4, False), (1, "Old", "1231", 5, True), (2, "Two", "1231", 1, True)]


def test_statement_words_are_tried_in_order(spark):
    tags = {"AssetsCurrent": "BS", "netcashprovidedByX": "CF", "EarningsPerShareBasic": "EPS",
            "ProceedsFromIssuanceOfCommonStock": "BS", "Revenues": "IS"}
    df = spark.createDataFrame([(t,) for t in tags], "tag string")
    assert {r.tag: r.s for r in df.select(
        "tag", concepts.statement_of("tag").alias("s")).collect()} == tags


def test_concept_map_and_dimension(spark):
    found = spark.createDataFrame([("Revenues", 9), ("Goodwill", 9)], "tag string, filings long")
    built = concepts.build_map(concepts.curated(spark), found)
    assert built.count() == 14
    assert built.where("src_tag = 'Goodwill'").first().statement == "BS"
    dim = {r.canonical_tag: r for r in concepts.dim_concept(built).collect()}
    revenue = dim["REVENUE"]
    assert revenue.n_source_tags == 4 and revenue.source_tags == sorted(revenue.source_tags)
    assert (revenue.min_confidence, revenue.weakest_confidence) == ("HIGH", "MEDIUM")
    assert concepts.lineage(built).first().canonical_tag == "REVENUE"


def test_candidates_need_enough_filings(spark):
    rows = [(f"t{i % 2}" if i else "rare", f"f{i}", None, " ", "USD", "us-gaap/1", "1")
            for i in range(40)] + [("t9", "f9", "seg", None, "USD", "us-gaap/1", "1")]
    df = spark.createDataFrame(rows, "tag string, adsh string, segments string, coreg string, "
                                     "uom string, version string, value string")
    assert {r.tag for r in concepts.candidates(df).collect()} == {"t0", "t1"}


# ---------------------------------------------------------------- control table

def quarters(spark, *names):
    return spark.createDataFrame([(n, f"u/{n}") for n in names], "quarter string, zip_url string")


def test_control_table_life(spark):
    first = control.offer(quarters(spark, "2024q1", "2024q2"), "2025-01-01 00:00:00")
    running = control.start(first, quarters(spark, "2024q1", "2030q1"))
    done = spark.createDataFrame(
        [("2024q1", 10, 4, {"sub.txt": 3})],
        "quarter string, bytes_downloaded long, files_extracted int, row_counts map<string,long>"
    ).withColumn("completed_at", F.lit("2025-01-02 00:00:00"))
    finished = control.finish(running, done)
    failed = control.fail(finished, spark.createDataFrame(
        [("2024q2", "can't " + "x" * 2000)], "quarter string, error string"))
    again = control.merge_discovered(failed, control.offer(
        quarters(spark, "2024q1", "2024q2", "2024q3"), "2026-01-01 00:00:00"))
    rows = {r.quarter: r for r in again.collect()}
    assert {q: r.status for q, r in rows.items()} == {
        "2024q1": "DONE", "2024q2": "FAILED", "2024q3": "PENDING"}
    assert rows["2024q1"].attempts == 1 and rows["2024q1"].row_counts == {"sub.txt": 3}
    assert rows["2024q1"].discovered_at == datetime(2025, 1, 1)
    assert len(rows["2024q2"].last_error) == 900 and "'" not in rows["2024q2"].last_error
    assert [r.quarter for r in control.pending(again).collect()] == ["2024q2", "2024q3"]
    restarted = control.start(again, quarters(spark, "2024q1", "2024q2"))
    assert {r.quarter: (r.status, r.attempts) for r in restarted.collect()} == {
        "2024q1": ("DONE", 1), "2024q2": ("RUNNING", 1), "2024q3": ("PENDING", 0)}


# ---------------------------------------------------------------- snapshots

def diffs(spark, pairs):
    rows = [fact(p[index], f"{year}-02-01", cik=i, adsh=f"{i:04d}-{year}-1")
            for i, p in enumerate(pairs) for index, year in ((0, 2022), (1, 2024))]
    return snapshots.diff(frame(spark, rows), ("2022-01-01", "2023-01-01"),
                          ("2024-01-01", "2025-01-01"))


PAIRS = [(100, 100), (100, 101.5), (0, 5), (100, -100), (1000, 1_000_000), (5, 0), (200, 203)]


def test_snapshot_reports(spark):
    d = diffs(spark, PAIRS)
    tallies = {r.artefact: r.n for r in snapshots.artefacts(d).collect()}
    assert tallies["identical"] == 2 and tallies["scale_1e3"] == 1 and tallies["sign_flip"] == 3
    bins = {r.bin: r.n for r in snapshots.histogram(d).collect()}
    assert bins == {"(1, 5]": 2, "(25, 100]": 1, "(100, 1000]": 1, "(1000, 1e+12]": 1}
    rate = snapshots.rates(d, "canonical_tag").first()
    assert (rate.n, rate.chg_pct) == (7, 71.4)
    assert snapshots.year_mix(d).first().n == 7
    wanted = snapshots.Verifiable(pct_from=1, pct_to=5, base_above=50)
    assert [r.cik for r in snapshots.candidates(d, wanted).collect()] == [6, 1]
    labels = {(r.bucket, r.cik) for r in snapshots.buckets(d, 50, 150, "x").collect()}
    assert labels == {("large_pct_nonrevenue", 3), ("large_pct_nonrevenue", 4),
                      ("small_material", 6), ("sign_flip", 3), ("sign_flip", 5)}
    assert snapshots.largest_revisions(d, 1).first().cik == 4


def test_snapshot_keeps_the_latest(spark):
    rows = frame(spark, [fact(1, "2022-01-01", adsh="a"), fact(2, "2022-01-01", adsh="b"),
                         fact(3, "2021-01-01", adsh="c")])
    assert [int(r.value) for r in snapshots.resolve(rows).collect()] == [2]
    inside = snapshots.within(("2022-01-01", "2022-03-01"))
    assert {r.adsh for r in rows.where(inside).collect()} == {"a", "b"}


@pytest.mark.parametrize("changes,kept", [
    ({}, True), ({"segments": "Seg=A"}, False), ({"coreg": "Sub"}, False), ({"segments": " "}, True),
    ({"version": "0001-24"}, False), ({"uom": "EUR"}, False), ({"value": None}, False),
    ({"tag": "Other"}, False), ({"ddate": "9999"}, False)])
def test_snapshot_compares_only_totals_in_standard_tags(spark, changes, kept):
    row = {"adsh": "a", "tag": "Revenues", "version": "us-gaap/2023", "ddate": "20231231",
           "qtrs": "4", "uom": "USD", "segments": None, "coreg": None, "value": "5"} | changes
    facts = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    mapping = spark.createDataFrame([("Revenues", "REVENUE")], "src_tag string, canonical_tag string")
    assert snapshots.comparable(facts, mapping, ["REVENUE"]).count() == int(kept)
    row.pop("segments")
    facts = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    with pytest.raises(AnalysisException, match="segments"):
        snapshots.comparable(facts, mapping, ["REVENUE"])


def test_grid_of_intervals_at_quarter_edges(spark):
    pit = intervals(spark, [fact(1, "2021-03-31"), fact(2, "2021-06-30 00:00:01"),
                            fact(3, "2021-09-30 00:00:00"), fact(9, "2030-01-01", cik=2)])
    grid = as_of_grid(pit, Quarters.between("2020-12-31", "2021-12-31"))
    got = sorted((r.rebalance_dt.month, int(r.value)) for r in grid.collect())
    assert got == [(3, 1), (6, 1), (9, 3), (12, 3)]


def test_updates_and_offers_never_multiply_rows(spark):
    known = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int")
    updates = spark.createDataFrame([("a", 5), ("a", 7), ("a", None), ("c", 9)], "k string, m int")
    got = upsert.apply_updates(known, updates, ["k"], {"n": "new.m"})
    assert sorted(map(tuple, got.collect())) == [("a", 7), ("b", 1)]
    offers = spark.createDataFrame([("c", 2), ("c", 3), ("a", 9)], "k string, n int")
    got = upsert.insert_missing(known, offers, ["k"])
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 1), ("c", 3)]


def test_filing_path(spark):
    df = spark.createDataFrame([(7, "0001-22-3")], "cik long, adsh string")
    assert snapshots.filing_path(df, "b/", "adsh").first().path == "b/7/0001223/"


@pytest.mark.parametrize("limit", [2_000_000, 5])
def test_raw_to_gold(spark, small, limit):
    """Faulty raw rows end to end; every invariant holds with and without slices."""
    subs = silver.submissions(_raw(dt.raw_submissions(spark, small)))
    facts = silver.facts(_raw(dt.raw_facts(spark, small)), dt.raw_concept_map(spark))
    pit = settle(gold.pit_from_silver(facts, subs, limit=limit), "pit")
    assert pit.columns == gold.PIT_COLUMNS
    report = invariants.report(pit, subs).collect()
    assert all(r.passed and r.checked > 500 for r in report)
    named = {r.tag for r in pit.select(F.col("canonical_tag").alias("tag")).distinct().collect()}
    assert named == {"NET_INCOME", "ASSETS", "REVENUE"}
    assert pit.where("is_amendment").count() > 0


def test_explorer_shows_one_company_in_timeline_order(spark):
    pit = intervals(spark, roa_rows())
    got = monitor.fact_explorer(pit, "NET_INCOME", 4, cik=1).collect()
    assert [(r.cik, int(r.value), r.pct) for r in got] == [(1, 10, None), (1, 30, 200.0)]
    assert monitor.fact_explorer(pit, "NET_INCOME", 4).count() == 7


def test_rounding_ties_follow_the_decimal_value(spark):
    rows = [(40.0, 30.01), (8.0, 9.0), (1.0, 1e40)]
    df = spark.createDataFrame(rows, "b double, a double")
    got = [r.pct for r in df.select(
        rounded(relative_change("b", "a") * 100, 2).alias("pct")).collect()]
    assert got[:2] == [24.98, 12.5] and got[2] > 1e41


def test_intervals_read_facts_once(spark, small):
    """Without broadcasts: seven exchanges for facts and intervals, two for the concept map, and
    those of the small filings table."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        plan = knowledge_intervals(spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in held:
            spark.conf.unset(name)
    scans = re.findall(r"FileScan parquet \[(\w+?)_", plan)
    assert scans.count("l") == 1 and scans.count("o") == 2  # filings, and their slices
    exchanges = re.findall(r"(?<!Reused)Exchange \w+partitioning\((\w+)", plan)
    assert len([e for e in exchanges]) <= 16 and "ReusedExchange" in plan
