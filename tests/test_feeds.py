"""Headers that decide how files are read, and hops that survive being cut off."""

import json

import pytest
from pyspark.sql import functions as F

from knownwhen.plans import silver
from knownwhen.sources import headers
from knownwhen.sources.schemas import RESCUED, raw_columns
from knownwhen.sources.versions import Log
from knownwhen.streaming import feeds

FACT = {"adsh": "0000000001-24-000001", "tag": "Revenues", "version": "us-gaap/2024",
        "ddate": "20231231", "qtrs": "4", "uom": "USD", "value": "12.5"}
MAP = "src_tag string, canonical_tag string, statement string"


def put(root, quarter, columns, *rows, bom=""):
    folder = root / f"quarter={quarter}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = ["\t".join(columns), *["\t".join(r.get(c, "") for c in columns) if isinstance(r, dict)
                                   else r for r in rows]]
    (folder / "num.txt").write_text(bom + "\n".join(lines) + "\n")


@pytest.fixture
def mixed(tmp_path):
    known = raw_columns("num")
    put(tmp_path, "2024q1", known, FACT, {**FACT, "value": "1"})
    put(tmp_path, "2024q2", ["tag", "adsh", *known[2:-1]], FACT)
    put(tmp_path, "2024q3", [*known, "note", "more"], {**FACT, "note": "n"}, FACT, "torn\tline")
    put(tmp_path, "2024q4", [c for c in known if c != "value"], FACT, FACT)
    put(tmp_path, "2023q4", [*known, "tag"], FACT)
    put(tmp_path, "2023q3", known, FACT, bom="﻿")
    put(tmp_path, "2023q2", known)
    return tmp_path


def glob(root):
    return f"{root}/quarter=*/num.txt"


def test_routes(spark, mixed):
    got = {r["quarter"]: (r["route"], r["reason"]) for r in
           headers.routes(spark, glob(mixed), "num").collect()}
    assert got == {
        "2024q1": ("as_declared", None), "2024q2": ("by_name", None),
        "2024q3": ("by_name", None), "2024q4": ("quarantine", "missing_column"),
        "2023q4": ("quarantine", "repeated_column"), "2023q3": ("as_declared", None),
        "2023q2": ("as_declared", None)}


def test_rows_are_mapped_by_name_and_the_rest_is_kept_aside(spark, mixed):
    rows = headers.read_by_header(spark, glob(mixed), "num").collect()
    by = {}
    for r in rows:
        by.setdefault(r["quarter"], []).append(r)
    assert {q: len(found) for q, found in by.items()} == {
        "2024q1": 2, "2024q2": 1, "2024q3": 3, "2023q3": 1}
    for q in ("2024q2", "2023q3"):
        assert by[q][0]["adsh"] == FACT["adsh"] and by[q][0]["tag"] == "Revenues"
        assert by[q][0]["value"] == "12.5" and by[q][0][RESCUED] is None
    rescued = sorted(str(r[RESCUED]) for r in by["2024q3"])
    assert rescued[0] == "None" and rescued[1] == "torn\tline"
    assert json.loads(rescued[2]) == {"note": "n"}
    left = {r["quarter"]: (r["reason"], r["rows"]) for r in
            headers.not_read(spark, glob(mixed), "num").collect()}
    assert left == {"2024q4": ("missing_column", 2), "2023q4": ("repeated_column", 1)}


def test_too_many_headers_and_no_files_that_fit(spark, tmp_path, monkeypatch):
    put(tmp_path, "2024q4", ["tag"], {"tag": "x"})
    assert headers.read_by_header(spark, glob(tmp_path), "num").count() == 0
    put(tmp_path, "2024q1", raw_columns("num"), FACT)
    put(tmp_path, "2024q2", raw_columns("num")[:-1], FACT)
    monkeypatch.setattr(headers, "MAX_HEADERS", 1)
    with pytest.raises(ValueError):
        headers.read_by_header(spark, glob(tmp_path), "num")


def fed(spark, raw, root):
    bronze = feeds.Feed(f"{root}/b", "num_raw")
    feeds.ingest_by_header(spark, str(raw), "num", bronze, most=2)
    return bronze


def test_admission_is_bounded_and_files_come_once(spark, mixed, tmp_path_factory):
    root = tmp_path_factory.mktemp("feed")
    bronze = fed(spark, mixed, root)
    assert Log(spark, bronze.sink).versions() == [1, 2, 3, 4]  # seven files, two a batch
    put(mixed, "2022q1", raw_columns("num"), FACT)
    fed(spark, mixed, root)
    assert Log(spark, bronze.sink).versions()[-1] == 5
    assert feeds.routed_rows(spark, bronze, "num_raw").count() == 8
    assert feeds.routed_rows(spark, bronze, "num_files").agg(F.sum("rows")).first()[0] == 3


@pytest.mark.parametrize("where", ["after the rows", "after the log"])
def test_a_batch_that_is_cut_off_reaches_the_next_hop_once(
        spark, mixed, tmp_path_factory, monkeypatch, where):
    root = tmp_path_factory.mktemp("feed")
    commit, entered = Log.commit, []

    def dies(self, based_on, state):
        if where == "after the log":
            commit(self, based_on, state)
        entered.append(based_on)
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(Log, "commit", dies)
        with pytest.raises(Exception, match="executor lost"):
            fed(spark, mixed, root)
    assert entered == [0]
    mapping = spark.createDataFrame([("Revenues", "REVENUE", "IS")], MAP)
    routed = feeds.Feed(f"{root}/s", "num")

    def onward(bronze):
        feeds.run_routed(feeds.new_batches(spark, bronze, most=1), feeds.fact_steps(mapping),
                         routed, load=feeds.batches_of(bronze, "num_raw"))

    if where == "after the log":  # the next hop may run before the repetition
        onward(feeds.Feed(f"{root}/b", "num_raw"))
    bronze = fed(spark, mixed, root)
    onward(bronze)
    onward(bronze)
    shown = ["adsh", "src_tag", "value", "quarter"]
    want = silver.facts(headers.read_by_header(spark, glob(mixed), "num"), mapping)
    got = feeds.routed_rows(spark, routed, "num")
    assert sorted(map(tuple, got.select(*shown).collect())) == \
        sorted(map(tuple, want.select(*shown).collect()))
    assert got.count() == 6
