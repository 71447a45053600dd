"""Quality by run against plain sums, and statements by the votes of filings."""

import random

import pytest
from pyspark.sql import functions as F

from knownwhen.plans import concepts, presentation
from knownwhen.plans import quality_history as history


def chi(n, b, m, c):
    both, rows = b + c, n + m
    spread = n * m * both * (rows - both)
    return (b * m - c * n) ** 2 * rows / spread if spread else 0.0


def runs(spark, counts):
    return spark.createDataFrame(
        [(run, rule, n, b) for (rule, run), (n, b) in counts.items()], history.LEDGER)


def test_runs_are_counted_by_rule(spark):
    rows = spark.createDataFrame(
        [("a", 1, None), ("a", None, 2), ("b", 3, 3), (None, 4, 4)], "run string, x int, y int")
    found = history.run_counts(rows, {"x": F.col("x") > 0, "y": F.col("y") > 2}, "run")
    assert {tuple(r) for r in found.collect()} == {
        ("a", "x", 2, 1), ("a", "y", 2, 2), ("b", "x", 1, 0), ("b", "y", 1, 0),
        ("", "x", 1, 0), ("", "y", 1, 0)}
    assert history.run_counts(rows.limit(0), {"x": F.col("x") > 0}, "run").count() == 0


def test_a_jump_is_flagged_and_a_steady_rate_is_not(spark):
    counts = {("steady", f"r{i}"): (1000 + i, 50 + i % 3) for i in range(8)}
    counts |= {("jump", f"r{i}"): (1000, 50 if i != 5 else 120) for i in range(8)}
    counts |= {("never", f"r{i}"): (1000, 0) for i in range(3)}
    counts |= {("huge", f"r{i}"): (10**13, 10**11 + i * 10**9) for i in range(3)}
    found = history.jumps(runs(spark, counts)).collect()
    assert {(r["rule"], r["run"]) for r in found if r["jumped"]} == {("jump", "r5")}
    assert all(r["earlier_rate"] is None and r["chi_square"] is None
               for r in found if r["run"] == "r0")


@pytest.mark.parametrize("seed", [3, 4])
def test_change_points_are_the_best_splits(spark, seed):
    draw = random.Random(seed)
    counts = {(rule, f"r{i:02}"): (n := draw.randint(0, 500), draw.randint(0, n // 3))
              for rule in "abc" for i in range(12)}
    counts |= {("d", f"r{i:02}"): (900, 40 if i < 7 else 58) for i in range(12)}
    counts["single", "r00"] = (10, 1)
    found = {r["rule"]: r for r in history.change_points(runs(spark, counts)).collect()}
    assert set(found) == set("abcd")
    for rule, row in found.items():
        line = [counts[rule, f"r{i:02}"] for i in range(12)]
        best = max(range(1, 12), key=lambda k: (chi(
            *map(sum, zip(*line[k:])), *map(sum, zip(*line[:k]))), -k))
        assert row["run"] == f"r{best:02}"
    assert found["d"]["run"] == "r07" and found["d"]["changed"]


def test_the_ledger_keeps_what_it_has(spark, tmp_path):
    root = str(tmp_path)
    first = runs(spark, {("x", "r1"): (10, 1), ("x", "r2"): (10, 2)})
    again = runs(spark, {("x", "r2"): (10, 9), ("x", "r3"): (10, 3)})
    assert history.record(first, root) < history.record(again, root)
    assert {(r["run"], r["breaches"]) for r in history.ledger(spark, root).collect()} == {
        ("r1", 1), ("r2", 2), ("r3", 3)}


def test_statements_by_votes(spark):
    lines = spark.createDataFrame(
        [("f1", "T", "BS"), ("f1", "T", "BS"), ("f2", "T", "CF"), ("f3", "T", "CF"),
         ("f1", "Assets", " is "), ("f2", "Assets", "BS"), ("f1", "U", None), ("f1", "V", " "),
         (None, "W", "EQ"), ("f1", None, "BS")], "adsh string, tag string, stmt string")
    facts = spark.createDataFrame(
        [("f1", "T")] * 3 + [("f2", "T"), ("f9", "T")], "adsh string, tag string")
    voted = presentation.statement_vote(presentation.statement_votes(lines, facts))
    assert {tuple(r) for r in voted.collect()} == {
        ("T", "BS", 3, 0.6, "IS", False), ("Assets", "BS", 1, 0.5, "BS", True),
        ("W", "EQ", 1, 1.0, "IS", False)}
    known = concepts.build_map(
        concepts.curated(spark), spark.createDataFrame(
            [("T", 9), ("Assets", 9), ("Other", 9)], "tag string, filings long"))
    after = {r["src_tag"]: r["statement"] for r in presentation.placed(known, voted).collect()}
    before = {r["src_tag"]: r["statement"] for r in known.collect()}
    assert {t for t in after if after[t] != before[t]} == {"T"} and after["T"] == "BS"
    assert presentation.statement_vote(
        presentation.statement_votes(lines.limit(0), facts)).count() == 0
