import random

import numpy as np

from knownwhen.llm import neardup as nd
from tests.llm.conftest import DOC_SCHEMA, prose, rows_of


def sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Components over doc_id by comparing every pair of rows."""
    rows = [(i, sets(t)) for i, t in rows]
    top = {i: i for i, _ in rows if i is not None}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if i is not None and j is not None and a and b and (
                    100 * len(a & b) >= 75 * len(a | b)):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i)
                   for i, s in rows), key=repr)


def check(spark, rows):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC_SCHEMA)
    assert rows_of(nd.near_duplicates(df)) == brute(rows)


def test_awkward_rows(spark, awkward, crowded):
    want = brute([(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert rows_of(nd.near_duplicates(awkward)) == want
    assert rows_of(nd.near_duplicates(crowded)) == want


def test_no_rows(nothing):
    assert rows_of(nd.near_duplicates(nothing)) == []


def test_chains_shared_passages_and_groups(spark):
    draw = random.Random(3)
    rows, passage = [], prose(100, 60)
    for g in range(6):  # chains: each text differs a little more from the first
        words = prose(g, 80).split()
        for k in range(12):
            rows.append((len(rows), " ".join(words)))
            words[k * 6] = f"new{g}{k}"
    for g in range(60):  # a passage that makes up much of every text
        rows.append((len(rows), passage + " " + prose(200 + g, draw.randint(5, 40))))
    for g in range(200):  # one large group of near copies
        words = passage.split()
        words[draw.randrange(60)] = f"w{g}"
        rows.append((len(rows), " ".join(words)))
    draw.shuffle(rows)
    check(spark, rows)


def test_rows_that_share_an_id_are_one_document(spark):
    rows = [(5, prose(1, 40)), (5, prose(2, 40)), (7, prose(2, 40)), (3, prose(1, 40)),
            (9, prose(9, 40)), (9, prose(8, 40)), (8, prose(8, 40))]
    check(spark, rows)


def test_hashes_do_not_depend_on_slices():
    text = prose(4, 3000)
    whole = nd.shingles(text)
    from knownwhen.llm import text as tx
    size, tx.SLICE = tx.SLICE, 1000
    try:
        assert len(list(tx.pieces(text.encode(), 1000))) > 10
        assert b"".join(tx.pieces(text.encode(), 1000)) == text.encode()
    finally:
        tx.SLICE = size
    assert len(whole) == len(sets(text))


def test_pruning_keeps_what_may_be_a_link():
    steps = nd.least_matches()
    assert [n for n, _ in steps] == [32, 64, 96, 128]
    a = np.zeros((3, 128), np.uint32)
    b = a.copy()
    b[1, ::4] = 1   # 75 percent of the hashes agree
    b[2, ::2] = 1   # half of them
    assert list(nd.surviving(a, b, steps)) == [0, 1]


def test_components_of_long_paths_take_few_rounds(spark, monkeypatch):
    rounds = []
    settle = nd.settle
    monkeypatch.setattr(nd, "settle", lambda df, label, **k: rounds.append(label) or settle(df, label, **k))
    n = 1000
    orders = {"one then down": [0, *range(n - 1, 0, -1)], "shuffled": random.Random(5).sample(range(n), n)}
    for order in orders.values():
        rounds.clear()
        edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
        found = nd.components(edges, "path").collect()
        assert sorted((r["node"], r["component"]) for r in found) == [(i, 0) for i in range(n)]
        assert rounds.count("path") - 1 <= 15


def test_components_equal_a_search(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    top = list(range(400))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in pairs:
        top[max(find(a), find(b))] = min(find(a), find(b))
    found = nd.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted((r["node"], r["component"]) for r in found) == sorted(
        (i, find(i)) for i in {x for pair in pairs for x in pair})
