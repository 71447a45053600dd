"""Table digests and distinct counts from bitmaps against plain comparisons."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from knownwhen.operators import digests
from knownwhen.plans import distinct
from knownwhen.sources.versions import Log

ROW = "k string, n int, value decimal(28,4)"


def table(spark, rows):
    return spark.createDataFrame(rows, ROW)


def random_rows(seed, n=300):
    draw = random.Random(seed)
    return [(draw.choice(["a", "b", "c", None]), draw.choice([1, 2, 3, None]),
             draw.choice([None, Decimal(draw.randint(0, 3))])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_differences_are_those_of_multisets(spark, seed):
    rows, draw = random_rows(seed), random.Random(seed)
    other = [r for r in rows if draw.random() > 0.02] + [("a", 9, None), ("a", 9, None)]
    draw.shuffle(other)
    left, right = Counter(rows), Counter(other)
    want = sorted(((*r, left[r], right[r]) for r in {*left, *right} if left[r] != right[r]), key=repr)
    got = digests.differences(table(spark, rows), table(spark, other), ["k"], parts=8)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_equal_tables_in_any_order_have_equal_digests(spark):
    rows = random_rows(3)
    a = digests.digest(table(spark, rows), ["k"], 8)
    b = digests.digest(table(spark, rows[::-1]).repartition(5), ["k"], 8)
    assert digests.differing_parts(a, b).isEmpty()
    assert digests.differences(table(spark, rows), table(spark, rows), ["k", "n"]).isEmpty()
    assert digests.differences(table(spark, []), table(spark, []), ["k"]).isEmpty()
    assert digests.differences(table(spark, rows[:2]), table(spark, []), ["k"]).count() == 2


def test_a_value_in_another_column_and_a_repeated_row_differ(spark):
    a = spark.createDataFrame([("x", None, 1), ("y", "y", 1)], "p string, q string, n int")
    b = spark.createDataFrame([(None, "x", 1), ("y", "y", 1), ("y", "y", 1)],
                              "p string, q string, n int")
    got = {tuple(r) for r in digests.differences(a, b, ["n"], parts=4).collect()}
    assert got == {("x", None, 1, 1, 0), (None, "x", 1, 0, 1), ("y", "y", 1, 1, 2)}
    with pytest.raises(ValueError):
        digests.differences(a, b.withColumn("n", F.col("n").cast("long")), ["n"])


def test_only_differing_parts_are_compared_by_row(spark):
    rows = [(str(i), i, Decimal(i)) for i in range(2000)]
    changed = [(k, n, v + 1) if n == 77 else (k, n, v) for k, n, v in rows]
    parts = digests.differing_parts(digests.digest(table(spark, rows), ["k"]),
                                    digests.digest(table(spark, changed), ["k"])).collect()
    assert len(parts) == 1 and parts[0]["rows_a"] < 20


# ------------------------------------------------------------------ distinct counts

def deliveries(seed):
    draw = random.Random(seed)
    return {f"q{q}": [(draw.choice(["T1", "T2", None]), f"filing {draw.randint(0, 200)}")
                      for _ in range(400)] for q in range(3)}


def want(taken):
    rows = [r for found in taken.values() for r in found]
    groups = {g for g, _ in rows}
    return ({g: len({i for h, i in rows if h == g}) for g in groups}, len({i for _, i in rows}))


def counts(store):
    return ({r["grouped"]: r["items"] for r in store.counts().collect()},
            store.total().first()["items"])


def pairs(spark, rows):
    return spark.createDataFrame(rows, "tag string, adsh string")


def test_merged_bitmaps_equal_distinct_counts(spark, tmp_path):
    store, taken = distinct.DistinctStore(spark, str(tmp_path)), deliveries(1)
    assert store.counts().isEmpty()
    for name, rows in taken.items():
        store.take(name, pairs(spark, rows), "tag", "adsh")
    assert counts(store) == want(taken)
    # A delivery that comes again, corrected, replaces the one before.
    taken["q1"] = taken["q1"][:50] + [("T9", "new filing"), ("T9", None)]
    store.take("q1", pairs(spark, taken["q1"]), "tag", "adsh")
    taken["q1"].pop()
    assert counts(store) == want(taken)
    store.take("q7", pairs(spark, []), "tag", "adsh")
    assert counts(store) == want(taken)


def test_numbers_are_dense_and_a_run_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    store, taken = distinct.DistinctStore(spark, str(tmp_path)), deliveries(2)
    store.take("q0", pairs(spark, taken["q0"]), "tag", "adsh")
    before = counts(store)
    with monkeypatch.context() as patch:
        def dies(self, based_on, state):
            raise KeyboardInterrupt
        patch.setattr(Log, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            store.take("q1", pairs(spark, taken["q1"]), "tag", "adsh")
    assert counts(store) == before
    store.take("q1", pairs(spark, taken["q1"]), "tag", "adsh")
    state = store.log.latest()[1]
    numbers = [r["number"] for r in store._read(state["numbers"]).collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1)) and state["last"] == len(numbers)


def test_numbers_beyond_one_run_of_bits(spark):
    items = spark.range(70_000).select(F.col("id").cast("string").alias("item"))
    got = distinct.numbered(items, 100).agg(
        F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(got) == (101, 70_100, 70_000)
