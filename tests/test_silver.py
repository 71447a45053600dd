import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from knownwhen.operators import quality
from knownwhen.plans import silver
from knownwhen.sources import delimited, files, links, tables
from knownwhen.sources import driver_tables as dt
from knownwhen.sources.schemas import raw_columns
from knownwhen.streaming import feeds

MAPPING = [("Assets", "ASSETS", "BS"), ("Revenues", "REVENUE", "IS")]


def raw(spark, kind, *rows):
    names = raw_columns(kind)
    full = [tuple(r.get(c) for c in names) for r in rows]
    df = spark.createDataFrame(full, ", ".join(f"{c} string" for c in names))
    return df.withColumns({"quarter": F.lit("2024q1"), "_ingested_at": F.current_timestamp(),
                           "_source_file": F.lit("f")})


def num(**changes):
    return {"adsh": "a", "tag": "Assets", "version": "us-gaap/2023", "ddate": "20231231",
            "qtrs": "0", "uom": "USD", "value": "12.5", **changes}


def sub(**changes):
    return {"adsh": "a", "cik": "5", "form": "10-K", "period": "20231231", "filed": "20240201",
            "accepted": "2024-02-01 16:30:00", "prevrpt": "0", "fy": "2023", **changes}


def cmap(spark):
    return spark.createDataFrame(MAPPING, "src_tag string, canonical_tag string, statement string")


@pytest.mark.parametrize("changes,outcome", [
    ({}, "kept"), ({"qtrs": "1"}, "kept"), ({"segments": "  ", "coreg": ""}, "kept"),
    ({"ddate": "2023xx31"}, "ddate_unparseable"), ({"ddate": None}, "ddate_unparseable"),
    ({"value": "abc"}, "value_uncastable"), ({"ddate": "19791231"}, "ddate_implausible"),
    ({"ddate": "19791231", "value": "abc"}, "value_uncastable"),
    ({"segments": "Seg=A"}, "segment"), ({"coreg": "Sub"}, "segment"),
    ({"uom": "EUR"}, "non_usd"), ({"uom": None}, "non_usd"),
    ({"version": "0000-24-1"}, "custom_tag"), ({"version": None}, "custom_tag"),
    ({"qtrs": "2"}, "qtrs"), ({"qtrs": "x"}, "qtrs"), ({"qtrs": "4.0"}, "qtrs"),
    ({"value": None}, "null_value"), ({"tag": "Goodwill"}, "unmapped")])
def test_every_fact_has_one_outcome(spark, changes, outcome):
    rows = raw(spark, "num", num(**changes))
    got = silver.fact_outcomes(rows, cmap(spark)).first().outcome
    assert got == outcome
    assert silver.facts(rows, cmap(spark)).count() == int(outcome == "kept")
    assert silver.facts_quarantine(rows).count() == int(outcome in silver.FACT_BREAKS)


@pytest.mark.parametrize("changes,outcome", [
    ({}, "kept"), ({"form": "10-KT/A"}, "kept"), ({"form": "8-K"}, "form"),
    ({"accepted": "bad"}, "accepted_unparseable"), ({"period": "19xx0101"}, "period_unparseable"),
    ({"cik": "x"}, "cik_null"), ({"period": "20301231"}, "accepted_before_period"),
    ({"accepted": None, "cik": None}, "accepted_unparseable")])
def test_every_submission_has_one_outcome(spark, changes, outcome):
    rows = raw(spark, "sub", sub(**changes))
    assert silver.submission_outcomes(rows).first().outcome == outcome
    assert silver.submissions(rows).count() == int(outcome == "kept")
    assert silver.submissions_quarantine(rows).count() == int(outcome in silver.SUBMISSION_BREAKS)


def test_submission_is_typed(spark):
    got = silver.submissions(raw(spark, "sub", sub(form="10-K/A", prevrpt="1"))).first()
    assert got.is_amendment and got.prevrpt_flag and (got.cik, got.fy) == (5, 2023)
    assert str(got.accepted_ts) == "2024-02-01 16:30:00" and str(got.filed_dt) == "2024-02-01"
    assert len(got) == 19


def test_first_causes_add_up_as_published(spark, medium):
    """The counts the fault rules give at sf0.01."""
    facts = silver.exclusions(silver.fact_outcomes(
        dt.raw_facts(spark, medium), dt.raw_concept_map(spark)))
    assert {r.outcome: r.rows for r in facts.collect()} == {
        "ddate_unparseable": 67, "value_uncastable": 1274, "ddate_implausible": 1424,
        "segment": 9153, "non_usd": 2561, "custom_tag": 1501, "qtrs": 1486, "null_value": 756,
        "unmapped": 7100, "kept": 34678}
    subs = silver.exclusions(silver.submission_outcomes(dt.raw_submissions(spark, medium)))
    assert {r.outcome: r.rows for r in subs.collect()} == {
        "accepted_unparseable": 66, "period_unparseable": 67, "cik_null": 71,
        "accepted_before_period": 66, "form": 2921, "kept": 11809}


def reconciled(raw_rows, mapping, kept=None):
    outcomes = silver.exclusions(silver.fact_outcomes(raw_rows, mapping))
    return silver.reconciliation(
        "num", raw_rows, silver.facts(raw_rows, mapping) if kept is None else kept,
        silver.facts_quarantine(raw_rows), outcomes, silver.FACT_BREAKS).first()


def test_layers_reconcile_only_if_every_row_is_there_once(spark):
    mapping = spark.createDataFrame([("Assets", "ASSETS", "BS")],
                                    "src_tag string, canonical_tag string, statement string")
    rows = raw(spark, "num", num(), num(ddate="x"), num(uom="EUR"), num(tag="Other"))
    got = reconciled(rows, mapping)
    assert got.reconciles and got[1:5] == (4, 1, 1, 2)
    lost = reconciled(rows, mapping, silver.facts(rows, mapping).limit(0))
    assert not lost.reconciles and lost.silver == 0
    two = mapping.union(spark.createDataFrame([("Assets", "CASH", "BS")], mapping.schema))
    assert not reconciled(rows, two).reconciles


def test_breaches_are_counted_once_on_a_clustered_table(spark):
    root = tempfile.mkdtemp(prefix="knownwhen-watched-")
    rows = spark.range(1000).select(
        (F.col("id") % 50).alias("cik"), F.lit("2020-12-31").cast("date").alias("ddate"),
        F.col("id").cast("timestamp").alias("revised_at_ts"), "id")
    seen = tables.publish_watched(rows, root, "fact_revision", {"small": F.col("id") < 900})
    assert seen == {"rows": 1000, "small": 100}
    assert tables.read_published(spark, root, "fact_revision").count() == 1000


def test_a_broken_contract_stops_the_whole_run(spark, small):
    from knownwhen.plans import publishing
    from verification import queries
    root, layout = queries._files(spark, small, "sub", "num", "tag", "pre")
    rules = publishing.contracts() | {
        "sub": publishing.Contract(fail={"no_tens": ~F.col("form").startswith("10-Q")})}
    out = tempfile.mkdtemp(prefix="knownwhen-run-")
    with pytest.raises(Exception, match="contract broken: no_tens"):
        publishing.publish_all(spark, root, out, dt.raw_concept_map(spark).withColumns({
            "mapping_method": F.lit("SELF"), "confidence": F.lit("HIGH")}),
            queries.FACTOR, layout, rules)


def test_warnings_count_and_keep_rows(spark):
    rows = raw(spark, "sub", sub(adsh="0000000001-24-000001"), sub(adsh="odd"))
    watched, seen = quality.watch(rows, silver.submission_rules() | {
        "accepted_ts_not_null": F.lit(True), "period_dt_not_null": F.lit(True),
        "cik_not_null": F.lit(True), "accepted_after_period": F.lit(True)})
    assert watched.count() == 2
    assert seen.get["adsh_well_formed"] == 1 and seen.get["rows"] == 2


def test_a_broken_contract_stops_the_job(spark):
    rows = raw(spark, "num", num(), num(value=None))
    rules = {"value_not_null": F.col("value").isNotNull()}
    with pytest.raises(PySparkException, match="contract broken: value_not_null"):
        quality.enforce(rows, rules).select("adsh").count()
    assert quality.enforce(rows.where("value IS NOT NULL"), rules).count() == 1


# ---------------------------------------------------------------- files

HEADER = "\t".join(raw_columns("num"))


def line(*values):
    return "\t".join(values)


GOOD = line("a1", "Assets", "us-gaap/2023", "20231231", "0", "USD", "", "", "12.5", 'say "hi')


def write(folder, quarter, lines, name="num.txt", end="\n"):
    os.makedirs(f"{folder}/quarter={quarter}", exist_ok=True)
    with open(f"{folder}/quarter={quarter}/{name}", "w") as out:
        out.write("\n".join([HEADER, *lines]) + end)


@pytest.fixture
def drop():
    folder = tempfile.mkdtemp(prefix="knownwhen-drop-")
    write(folder, "2024q1", [GOOD, GOOD + "\textra", line("a2", "Assets", "us-gaap/2023")])
    write(folder, "2009q1", [])
    return folder


def test_reader_keeps_text_and_rescues_torn_lines(spark, drop):
    rows = delimited.read_raw(spark, drop, "num").orderBy("adsh", "_rescued_data").collect()
    assert len(rows) == 3
    sound = [r for r in rows if r["_rescued_data"] is None]
    assert len(sound) == 1 and sound[0].footnote == 'say "hi' and sound[0].value == "12.5"
    assert {r.quarter for r in rows} == {"2024q1"}
    assert all(r["_source_file"].endswith("quarter=2024q1/num.txt") for r in rows)
    # The same lines are rescued when few columns are read.
    few = delimited.read_raw(spark, drop, "num").select("adsh", "_rescued_data")
    assert sum(r["_rescued_data"] is not None for r in few.collect()) == 2


def test_manifest_and_headers(spark, drop):
    counts = {r.quarter: r.rows for r in files.row_counts(spark, f"{drop}/quarter=*/num.txt").collect()}
    assert counts == {"2024q1": 3, "2009q1": 0}
    manifest = {r.quarter: r.row_counts for r in files.manifest(
        spark, {"num": f"{drop}/quarter=*/num.txt"}).collect()}
    assert manifest == {"2024q1": {"num.txt": 3}, "2009q1": {"num.txt": 0}}
    heads = files.headers(spark, f"{drop}/quarter=*/num.txt").collect()
    assert all(r["columns"] == raw_columns("num") for r in heads) and len(heads) == 2


def test_column_profile(spark):
    rows = raw(spark, "num", num(), num(value=None, segments="s")).select("value", "segments", "tag")
    got = {r.column: r.populated for r in files.column_profile(rows).collect()}
    assert got == {"value": 0.5, "segments": 0.5, "tag": 1.0}


def test_stream_takes_each_file_once_and_equals_batch(spark, drop):
    feed = feeds.Feed(tempfile.mkdtemp(prefix="knownwhen-feed-"), "num_raw")
    feeds.ingest(spark, drop, "num", feed)
    feeds.ingest(spark, drop, "num", feed)
    shown = ["adsh", "tag", "value", "quarter", "_rescued_data"]
    batch = delimited.read_raw(spark, drop, "num").select(*shown)
    assert feed.rows(spark).select(*shown).exceptAll(batch).isEmpty()
    assert feed.rows(spark).count() == 3
    write(drop, "2024q2", [GOOD])
    feeds.ingest(spark, drop, "num", feed)
    assert feed.rows(spark).count() == 4


def test_routed_stream_equals_batch_and_refresh_starts_over(spark, drop):
    write(drop, "2024q2", [GOOD.replace("12.5", "abc"), GOOD.replace("USD", "EUR"), GOOD])
    root = tempfile.mkdtemp(prefix="knownwhen-feed-")
    bronze, routed = feeds.Feed(root, "num_raw"), feeds.Feed(root, "num")
    feeds.ingest(spark, drop, "num", bronze)
    steps = feeds.fact_steps(cmap(spark))
    for feed in (routed, routed, routed.refreshed()):
        feeds.run_routed(feeds.follow(spark, bronze), steps, feed)
        kept = feeds.routed_rows(spark, feed, "num")
        raw_rows = delimited.read_raw(spark, drop, "num")
        expected = silver.facts(raw_rows, cmap(spark))
        assert kept.count() == expected.count() == 3
        assert kept.drop("_ingested_at").exceptAll(expected.drop("_ingested_at")).isEmpty()
        assert feeds.routed_rows(spark, feed, "num_quarantine").count() == \
            silver.facts_quarantine(raw_rows).count() == 2
    assert routed.refreshed().sink != routed.sink


PAGE = ('<a href="/files/2024q1.zip">a</a> <a href="https://x.org/f/2023q4.zip">b</a>'
        '<a href="/files/2024q1.zip">again</a> <a href="/files/readme.zip">c</a> <a href="/p">d</a>')


def test_links_are_absolute_distinct_sorted_and_required(spark):
    pages = spark.createDataFrame([(PAGE,), (PAGE,)], "html string")
    got = [(r.quarter, r.zip_url) for r in links.require_some(
        links.discover(pages, "https://www.example.org")).collect()]
    assert got == [("2024q1", "https://www.example.org/files/2024q1.zip"),
                   ("2023q4", "https://x.org/f/2023q4.zip")]
    empty = spark.createDataFrame([("<p>moved</p>",)], "html string")
    with pytest.raises(LookupError):
        links.require_some(links.discover(empty, ""))


def test_publish_overwrites_and_clusters(spark):
    root = tempfile.mkdtemp(prefix="knownwhen-publish-")
    rows = spark.range(1000).select(
        (F.col("id") % 50).alias("cik"), F.lit("2020-12-31").cast("date").alias("ddate"),
        F.col("id").cast("timestamp").alias("revised_at_ts"))
    for _ in range(2):
        tables.publish(rows, root, "fact_revision")
    assert tables.read_published(spark, root, "fact_revision").count() == 1000
    assert tables.describe(spark).where("layer = 'gold'").count() == 8


def test_a_table_is_created_once_and_keeps_its_comments(spark):
    from knownwhen.sources.schemas import CONTROL
    root = tempfile.mkdtemp(prefix="knownwhen-create-")
    assert tables.create_if_absent(spark, root, "ingest_control", CONTROL)
    assert not tables.create_if_absent(spark, root, "ingest_control", CONTROL)
    read = tables.read_published(spark, root, "ingest_control")
    assert read.count() == 0 and read.schema["quarter"].metadata["comment"] == "such as 2024q1"
