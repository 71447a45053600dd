"""Companies that are one under several numbers, and the closure behind that."""

import random
from datetime import datetime

import pytest

from knownwhen.operators import closure
from knownwhen.plans import lineage

FILINGS = ("cik long, accepted_ts timestamp_ntz, name string, ein string, former string, "
           "changed date")


def by_hand(pairs):
    root = {}

    def find(n):
        root.setdefault(n, n)
        return n if root[n] == n else find(root[n])

    for a, b in pairs:
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {n: find(n) for n in list(root)}


def closed(spark, pairs):
    got = closure.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len({r.node for r in got}) == len(got)
    return {r.node: r.component for r in got}


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_equals_a_scan(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)]
    pairs += pairs[:5] + [(7, 7), (500, 500), (None, 3), (901, None)]
    assert closed(spark, pairs) == by_hand(pairs)


def test_closure_of_nothing_a_hub_and_a_path_in_bad_order(spark, monkeypatch):
    assert closed(spark, []) == {}
    hub = [(1000, n) for n in range(300)]
    rounds = []
    settle = closure.settle
    monkeypatch.setattr(closure, "settle", lambda df, label: rounds.append(label) or settle(df, label))
    assert set(closed(spark, hub).values()) == {0}
    rounds.clear()
    order = [1, *range(400, 1, -1)]
    assert set(closed(spark, list(zip(order, order[1:]))).values()) == {1}
    assert len(rounds) <= 15


def filings(spark, rows):
    made = [(c, datetime.fromisoformat(at), *rest) for c, at, *rest in rows]
    return spark.createDataFrame(made, FILINGS)


def test_numbers_are_tied_by_tax_number_and_former_name(spark):
    df = filings(spark, [
        (5, "2020-01-01", "Alpha Inc", "11", None, None),
        (9, "2021-01-01", "Beta Inc", " 11 ", None, None),
        (12, "2022-01-01", "Gamma", "", "beta  inc", None),      # case and spaces fold
        (20, "2022-01-01", "Delta", "", None, None),             # a blank tax number ties nobody
        (21, "2022-01-01", "Delta", " ", None, None),            # nor does a name borne today
        (30, "2022-01-01", "Eta", None, "Nobody", None),
        (None, "2022-01-01", "Eta", "11", "Alpha Inc", None)])
    got = {r.cik: r.entity for r in lineage.entities(df).collect()}
    assert got == {5: 5, 9: 5, 12: 5, 20: 20, 21: 21, 30: 30}


def test_an_entity_has_one_line_of_names(spark):
    day = datetime(2021, 6, 1).date()
    df = filings(spark, [
        (5, "2020-01-01", "Alpha", "1", None, None), (5, "2020-06-01", "Alpha", "1", None, None),
        (9, "2022-01-01", "Beta", None, "ALPHA", day), (9, "2022-01-01", "Beta", None, "ALPHA", day)])
    got = lineage.entity_names(df).orderBy("valid_from_ts").collect()
    assert [(r.entity, r.name, r.cik, r.valid_from_ts, r.version_seq, r.is_current) for r in got] == [
        (5, "Alpha", 5, datetime(2020, 1, 1), 1, False), (5, "Beta", 9, datetime(2021, 6, 1), 2, True)]
    assert got[0].valid_to_ts == got[1].valid_from_ts
    assert lineage.entity_names(df.limit(0)).count() == 0
