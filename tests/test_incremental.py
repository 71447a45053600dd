"""Splicing late and new facts into stored intervals against building everything anew."""

import random

import pytest
from pyspark.sql import functions as F

from knownwhen.plans import incremental
from knownwhen.sources.versions import ConcurrentChange, Log
from tests.helpers import as_by_hand, by_hand, fact, frame, intervals


def told(seed, n, companies=6, days=28):
    draw = random.Random(seed)
    return [fact(draw.randint(1, 3), f"2021-{draw.randint(1, 4):02d}-{draw.randint(1, days):02d}",
                 adsh=f"f{draw.randint(0, 60)}", cik=draw.randint(1, companies),
                 tag=draw.choice(["A", "B"])) for _ in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,limit", [(1, 2_000_000), (3, 3)])
def test_three_random_batches_equal_a_full_build(spark, tmp_path, seed, limit):
    every = told(seed, 240)
    draw = random.Random(seed)
    store = incremental.IntervalStore(spark, str(tmp_path), parts=4, limit=limit)
    deal = [draw.randrange(4) for _ in every]
    for batch in range(4):
        store.take(frame(spark, [r for r, b in zip(every, deal) if b == batch]))
        if batch == 2:
            so_far = [r for r, b in zip(every, deal) if b <= batch]
            assert as_by_hand(store.intervals().collect()) == by_hand(so_far)
    full = intervals(spark, every)
    assert rows(store.intervals()) == rows(full.select(*store.intervals().columns))
    # The same batch once more changes nothing, and neither does folding the reports.
    store.take(frame(spark, [r for r, b in zip(every, deal) if b == 2]))
    store.compact(folders=1)
    assert as_by_hand(store.intervals().collect()) == by_hand(every)
    store.take(frame(spark, told(seed + 50, 30)))
    assert as_by_hand(store.intervals().collect()) == by_hand(every + told(seed + 50, 30))


def test_late_reports_turn_repeats_into_changes(spark, tmp_path):
    store = incremental.IntervalStore(spark, str(tmp_path))
    first = [fact(5, "2021-01-01"), fact(5, "2021-03-01"), fact(7, "2021-05-01")]
    late = [fact(6, "2021-02-01"), fact(5, "2021-05-01", adsh="zz"), fact(None, "2021-04-01")]
    store.take(frame(spark, first))
    store.take(frame(spark, late))
    got = [(r["value"], r["revision_seq"], r["prev_value"]) for r in
           store.intervals().orderBy("known_from_ts").collect()]
    assert [tuple(map(lambda x: x if x is None else int(x), r)) for r in got] == [
        (5, 1, None), (6, 2, 5), (5, 3, 6)]


def test_untouched_parts_are_neither_read_nor_written(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store = incremental.IntervalStore(spark, root, parts=16)
    store.take(frame(spark, told(7, 300, companies=40)))
    before = store.log.latest()[1]
    read, plain = [], incremental.IntervalStore._read

    def noted(self, folders, parts=None):
        found = plain(self, folders, parts)
        read.extend(found.inputFiles() if found is not None else [])
        return found

    monkeypatch.setattr(incremental.IntervalStore, "_read", noted)
    store.take(frame(spark, [fact(9, "2021-03-03", cik=3, tag="A")]))
    after = store.log.latest()[1]
    changed = [p for p in after["intervals"] if after["intervals"][p] != before["intervals"].get(p)]
    assert len(changed) == 1 and len(after["intervals"]) > 8
    assert read and all(f"part={changed[0]}/" in f for f in read)


def test_empty_batches_and_unknown_values_change_nothing(spark, tmp_path):
    store = incremental.IntervalStore(spark, str(tmp_path))
    assert store.intervals() is None and store.take(frame(spark, [])) == 0
    store.take(frame(spark, [fact(1, "2021-01-01")]))
    assert store.take(frame(spark, [fact(None, "2021-02-01")])) == 1


def test_a_run_that_dies_or_is_overtaken_leaves_the_state_before(spark, tmp_path, monkeypatch):
    store = incremental.IntervalStore(spark, str(tmp_path))
    store.take(frame(spark, [fact(1, "2021-01-01")]))
    late, commit = frame(spark, [fact(2, "2021-02-01")]), Log.commit
    with monkeypatch.context() as patch:
        def dies(self, based_on, state):
            raise KeyboardInterrupt
        patch.setattr(Log, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            store.take(late)
    assert store.intervals().count() == 1

    def overtaken(self, based_on, state):
        monkeypatch.setattr(Log, "commit", commit)
        store.take(frame(spark, [fact(3, "2021-03-01")]))
        return commit(self, based_on, state)

    monkeypatch.setattr(Log, "commit", overtaken)
    with pytest.raises(ConcurrentChange):
        store.take(late)
    assert store.intervals().agg(F.max("value")).first()[0] == 3
    store.take(late)
    assert store.intervals().count() == 3
