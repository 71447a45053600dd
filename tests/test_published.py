"""Versions, crash-safe publication, and what SQL users find in the catalog."""

import pytest
from pyspark.sql import functions as F

from knownwhen.plans import control
from knownwhen.sources import catalog, tables
from knownwhen.sources.schemas import CONTROL
from knownwhen.sources.versions import ConcurrentChange, Log
from tests.helpers import fact, intervals


def quarters(spark, *names, status="PENDING"):
    rows = spark.createDataFrame([(n, status, 0) for n in names],
                                 "quarter string, status string, attempts int")
    return control.as_control(rows)


def statuses(spark, root):
    rows = tables.read_published(spark, root, "ingest_control").collect()
    return {r["quarter"]: r["status"] for r in rows}


def test_log_counts_up_and_refuses_a_taken_number(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    assert log.latest() == (0, {}) and log.versions() == []
    assert log.commit(0, {"folder": "a"}) == 1 and log.commit(1, {"folder": "b"}) == 2
    with pytest.raises(ConcurrentChange):
        log.commit(1, {"folder": "c"})
    with pytest.raises(ConcurrentChange):
        log.commit(0, {"folder": "c"})
    assert log.latest() == (2, {"folder": "b"}) and log.state(1) == {"folder": "a"}
    assert [p.name for p in (tmp_path / "_log").iterdir() if p.name.startswith(".") and
            not p.name.endswith(".crc")] == []


def test_a_write_that_dies_half_way_leaves_the_old_state(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(quarters(spark, "2024q1", "2024q2"), root, "ingest_control")
    broken = quarters(spark, "2024q1", "2024q2").repartition(2, "quarter").withColumn(
        "attempts", F.when(F.col("quarter") == "2024q2", F.raise_error(F.lit("lost")))
        .otherwise(1).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(broken, root, "ingest_control")
    assert statuses(spark, root) == {"2024q1": "PENDING", "2024q2": "PENDING"}
    assert tables.version_of(spark, root, "ingest_control") == 1


def test_a_crash_between_rows_and_log_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    tables.publish(quarters(spark, "2024q1"), root, "ingest_control")

    def dies(self, based_on, state):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(Log, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            tables.publish(quarters(spark, "2024q1", status="DONE"), root, "ingest_control")
    assert statuses(spark, root) == {"2024q1": "PENDING"}
    log = tables.log_of(spark, root, "ingest_control")
    assert len(log.orphans()) == 1
    tables.publish(quarters(spark, "2024q1", status="DONE"), root, "ingest_control")
    assert statuses(spark, root) == {"2024q1": "DONE"} and len(log.orphans()) == 1


def test_two_writers_from_one_version_cannot_both_win(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(quarters(spark, "2024q1"), root, "ingest_control")
    tables.publish(quarters(spark, "2024q1", status="RUNNING"), root, "ingest_control", based_on=1)
    with pytest.raises(ConcurrentChange):
        tables.publish(quarters(spark, "2024q1", status="FAILED"), root, "ingest_control",
                       based_on=1)
    assert statuses(spark, root) == {"2024q1": "RUNNING"}


def test_an_update_that_is_overtaken_is_made_again(spark, tmp_path):
    root, tried = str(tmp_path), []
    tables.publish(quarters(spark, "2024q1"), root, "ingest_control")

    def change(held):
        tried.append(held.count())
        if len(tried) == 1:  # somebody else discovers a quarter meanwhile
            tables.publish(held.unionByName(quarters(spark, "2024q2")), root, "ingest_control")
        return control.start(held, held.select("quarter"))

    assert tables.update(spark, root, "ingest_control", change) == 3
    assert tried == [1, 2] and set(statuses(spark, root).values()) == {"RUNNING"}
    with pytest.raises(ConcurrentChange):
        tables.update(spark, root, "ingest_control", lambda held: (
            tables.publish(held, root, "ingest_control"), held)[1], attempts=2)


def test_readers_keep_their_version_and_old_ones_can_go(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(quarters(spark, "a"), root, "ingest_control")
    before = tables.read_published(spark, root, "ingest_control")
    tables.publish(before.unionByName(quarters(spark, "b")), root, "ingest_control")
    assert before.count() == 1
    assert tables.read_published(spark, root, "ingest_control", version=1).count() == 1
    log = tables.log_of(spark, root, "ingest_control")
    assert log.orphans() == []
    log.forget(keep=1)
    assert log.versions() == [2] and len(log.orphans()) == 1
    with pytest.raises(LookupError):
        tables.read_published(spark, root, "fact_revision")
    assert not tables.create_if_absent(spark, root, "ingest_control", CONTROL)


@pytest.fixture
def gold_root(spark, tmp_path):
    root = str(tmp_path)
    told = [fact(10, "2021-02-01", "a"), fact(30, "2022-02-01", "b"),
            fact(7, "2021-02-01", "a", cik=2), fact(7, "2022-05-01", "c", cik=2)]
    tables.publish(intervals(spark, told), root, "fact_fundamental_pit")
    tables.create_if_absent(spark, root, "ingest_control", CONTROL)
    return root


def test_the_catalog_describes_tables(spark, gold_root):
    assert catalog.register(spark, gold_root, database="kw_described") == [
        "fact_fundamental_pit", "ingest_control"]
    told = {r["col_name"]: r["data_type"] for r in
            spark.sql("DESCRIBE EXTENDED kw_described.fact_fundamental_pit").collect()}
    assert told["Comment"] == "Knowledge intervals per fact" and "gold" in told["Table Properties"]
    comments = {r["col_name"]: r["comment"] for r in
                spark.sql("DESCRIBE kw_described.ingest_control").collect()}
    assert comments["quarter"] == "such as 2024q1"
    assert catalog.create_views(spark, "kw_described") == ["current_fundamental", "pending_quarter"]
    assert spark.sql("SELECT * FROM kw_described.current_fundamental").count() == 2


def test_entries_follow_publications_also_of_other_columns(spark, gold_root):
    catalog.register(spark, gold_root, database="kw_moving")
    catalog.create_views(spark, "kw_moving")
    catalog.create_functions(spark, "kw_moving")
    more = intervals(spark, [fact(10, "2021-02-01", "a")])
    tables.publish(more, gold_root, "fact_fundamental_pit")
    catalog.register(spark, gold_root, ["fact_fundamental_pit"], "kw_moving")
    assert spark.table("kw_moving.fact_fundamental_pit").count() == 1
    assert spark.sql("SELECT * FROM fundamental_as_of(TIMESTAMP '2021-03-01 00:00:00')").count() == 1
    tables.publish(more.withColumn("extra", F.lit(1)), gold_root, "fact_fundamental_pit")
    catalog.register(spark, gold_root, ["fact_fundamental_pit"], "kw_moving")
    assert spark.table("kw_moving.fact_fundamental_pit").first()["extra"] == 1
    assert dict((n, v) for n, _, _, v in catalog.described(spark, "kw_moving")) == {
        "fact_fundamental_pit": 3, "ingest_control": 1}


def test_the_function_is_half_open_and_its_filters_reach_the_scan(spark, gold_root):
    catalog.register(spark, gold_root, database="kw_function")
    assert catalog.create_functions(spark, "kw_function") == ["fundamental_as_of"]

    def at(instant):
        rows = spark.sql(f"SELECT cik, value FROM fundamental_as_of(TIMESTAMP '{instant}')")
        return sorted((r["cik"], int(r["value"])) for r in rows.collect())

    assert at("2021-01-31 23:59:59") == []
    assert at("2021-02-01 00:00:00") == [(1, 10), (2, 7)]
    assert at("2022-01-31 23:59:59") == [(1, 10), (2, 7)]
    assert at("2022-02-01 00:00:00") == [(1, 30), (2, 7)]
    one = spark.sql("SELECT value FROM fundamental_as_of(TIMESTAMP '2022-02-01 00:00:00') "
                    "WHERE cik = 2")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    for part in ("known_from_ts", "known_to_ts", "EqualTo(cik,2)"):
        assert part in pushed
    read = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "source_form" not in read
