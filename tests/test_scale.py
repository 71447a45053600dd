"""What keeps plans from growing faster than their input: shuffles, repeated work, memory."""

import random
import re

from pyspark.sql import functions as F

from knownwhen.operators import timeline as tl
from knownwhen.plans import gold, incremental
from knownwhen.plans.gold import FACT_LINE, KEY
from tests.helpers import as_by_hand, by_hand, fact, frame, in_slices, timeline
from verification import queries


def plan_of(df, spark, **settings):
    """The physical plan without broadcasts and before it is adapted."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            **settings}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        return df()._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in held:
            spark.conf.unset(name)


def exchanges(plan):
    return len(re.findall(r"(?<!Reused)Exchange \w+partitioning\(", plan))


def test_facts_with_filings_are_dealt_out_once(spark, small):
    plan = plan_of(lambda: queries.fact_revision(spark, small), spark)
    assert exchanges(plan) <= 15 and plan.count("ReusedExchange") == 2
    assert "max(struct(" not in plan  # no fold between the join and the windows


def test_values_are_converted_once_for_the_class(spark, small):
    plan = plan_of(lambda: queries.fact_revision(spark, small), spark)
    filters = [x for x in plan.splitlines() if "Filter" in x and "as double)" in x and "_next" not in x]
    assert max(x.count("as double)") for x in filters if "_prior" in x) <= 2


def test_last_of_instants_equals_the_fold(spark):
    draw = random.Random(5)
    told = [fact(draw.randint(1, 3), f"2021-01-{draw.randint(1, 4):02d}", adsh=f"f{draw.randint(0, 9)}",
                 cik=draw.randint(1, 3)) for _ in range(200)]
    rows = in_slices(frame(spark, told), 2)
    # An unknown instant is one too, also if nothing follows it.
    rows = rows.withColumn("accepted_ts", F.when(F.col("adsh") != "f7", F.col("accepted_ts")))
    rows = rows.where("cik < 3 or adsh = 'f7'")
    part = [*KEY, tl.SLICE]
    folded = tl.fold_instants(rows, FACT_LINE, part)
    sorted_ = tl.last_of_instants(rows, FACT_LINE, part).select(folded.columns)
    assert folded.count() == sorted_.count() > 10 and folded.exceptAll(sorted_).isEmpty()


def test_sliced_and_whole_lines_in_one_table(spark):
    """One company is cut, another isn't; both read the same rows once dealt out."""
    draw = random.Random(9)
    told = [fact(draw.randint(1, 2), f"2021-{draw.randint(1, 9):02d}-{draw.randint(1, 28):02d}",
                 adsh=f"{n}", cik=1 if n % 9 else 2) for n in range(180)]
    assert as_by_hand(timeline(spark, told, limit=40)) == by_hand(told)
    rows = in_slices(frame(spark, told), 40)
    assert {r[0] for r in rows.select("cik").where(F.col(tl.SLICE).isNull()).distinct().collect()} == {2}
    now = {(r.cik, r.current_value) for r in gold.fundamental_pit(rows, today=True).collect()}
    last = {k[0]: v for k, v, _, end, _, _ in by_hand(told) if end.year == 9999}
    assert now == set(last.items())


def test_stored_tables_and_batch_go_through_one_exchange(spark, tmp_path, monkeypatch):
    store = incremental.IntervalStore(spark, str(tmp_path), parts=4)
    draw = random.Random(3)
    told = [fact(draw.randint(1, 3), f"2021-0{draw.randint(1, 9)}-01", adsh=f"{n}",
                 cik=draw.randint(1, 5)) for n in range(60)]
    store.take(frame(spark, told[:40]))
    plans, plain = [], incremental.spliced

    def noted(*args):
        found = plain(*args)
        plans.append(plan_of(lambda: found[0].unionByName(
            found[1].withColumn(incremental.PART, F.lit(0))), spark))
        return found

    monkeypatch.setattr(incremental, "spliced", noted)
    store.take(frame(spark, told[40:]))
    assert as_by_hand(store.intervals().collect()) == by_hand(told)
    # What is copied and the lines that go on read the same exchange of intervals and reports.
    assert len(re.findall(r"[-+] Exchange rangepartitioning\(", plans[0])) == 1
    assert "ReusedExchange" in plans[0]


def test_raw_rows_of_four_kinds_of_files_are_joined_once(spark, small, monkeypatch):
    plain, held = queries.settle, []
    monkeypatch.setattr(queries, "settle", lambda df, label: held.append(label) or plain(df, label))
    queries.bronze_header_route(spark, small)
    assert held == ["raw-num"]


def test_groups_of_wide_rows_are_dealt_to_small_tasks(spark, small):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for run in (queries.dedup_per_filing, queries.concept_coverage):
        spark.conf.unset(name)
        run(spark, small)
        assert spark.conf.get(name) == "16m"
    spark.conf.set(name, "2m")  # what a session asks for stays
    queries.dedup_per_instant(spark, small)
    assert spark.conf.get(name) == "2m"
    spark.conf.unset(name)


def test_late_facts_of_keys_with_a_null_are_added_to_what_is_held(spark, tmp_path):
    store = incremental.IntervalStore(spark, str(tmp_path), parts=2)
    store.take(frame(spark, [fact(1, "2021-01-01", cik=None), fact(1, "2021-01-01", cik=2)]))
    store.take(frame(spark, [fact(2, "2021-02-01", cik=None), fact(2, "2021-02-01", cik=2)]))
    got = sorted((str(r.cik), int(r.value), r.revision_seq, r.is_current)
                 for r in store.intervals().collect())
    assert got == [("2", 1, 1, False), ("2", 2, 2, True), ("None", 1, 1, True), ("None", 2, 1, True)]


def test_what_is_stored_is_spliced_where_it_lies(spark, tmp_path, monkeypatch):
    store = incremental.IntervalStore(spark, str(tmp_path), parts=2)
    told = [fact(n % 3, f"2021-0{1 + n % 7}-01", adsh=f"{n}", cik=n % 4) for n in range(40)]
    store.take(frame(spark, told[::2]))
    plans, plain = [], incremental.spliced

    def noted(*args):
        with monkeypatch.context() as patch:  # no key is long, so no line is dealt out by slices
            patch.setattr(incremental, "_sliced", lambda line, *_: line.withColumn(
                tl.SLICE, F.lit(None).cast("bigint")))
            plans.extend(plan_of(lambda df=df: df, spark) for df in plain(*args))
        return plain(*args)

    monkeypatch.setattr(incremental, "spliced", noted)
    store.take(frame(spark, told[1::2]))
    assert as_by_hand(store.intervals().collect()) == by_hand(told)
    assert len(plans) == 2 and not any("Exchange " in p for p in plans)
    # Files are named to Spark only while a batch is taken, and their rows look as they did.
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("knownwhen_")]
    assert not any(c.metadata for c in store.intervals().schema)


def test_more_reports_are_expected_in_more_buckets(spark, tmp_path):
    store = incremental.IntervalStore(
        spark, str(tmp_path), parts=1, expected=10 * incremental.BUCKET_REPORTS)
    store.take(frame(spark, [fact(1, "2021-01-01")]))
    assert store.log.latest()[1]["buckets"] == 10


def test_stores_without_buckets_are_taken_on(spark, tmp_path):
    store = incremental.IntervalStore(spark, str(tmp_path), parts=2)
    told = [fact(n % 3, f"2021-0{1 + n % 7}-01", adsh=f"{n}", cik=n % 4) for n in range(40)]
    store.take(frame(spark, told[::2]))
    version, state = store.log.latest()
    for kind in ("reports", "intervals"):
        folder = next(iter(state[kind].values()))[0].split("/")[0]
        spark.read.parquet(f"{tmp_path}/{folder}").write.partitionBy("part").parquet(
            f"{tmp_path}/{kind}-plain")
        state[kind] = {p: [f"{kind}-plain/part={p}"] for p in state[kind]}
    store.log.commit(version, {k: v for k, v in state.items() if k != "buckets"})
    store.take(frame(spark, told[1::2]))
    assert as_by_hand(store.intervals().collect()) == by_hand(told)
