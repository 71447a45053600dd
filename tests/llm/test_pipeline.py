from collections import Counter

import corpus_pipeline
from knownwhen.llm import decontam, neardup
from tests.conftest import SMALL
from tests.llm.conftest import DOC_SCHEMA, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = corpus_pipeline.languages(spark, docs, SMALL)
    assert first.columns == COLUMNS
    assert first.count() >= docs.filter("n_chars > 20").count() * 0.99
    second = corpus_pipeline.near_copies(spark, first, SMALL)
    near = neardup.near_duplicates(first)
    assert second.columns == COLUMNS and second.count() == near.filter("kept").count()
    third = corpus_pipeline.benchmark_free(spark, second, SMALL)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    hit = {r["doc_id"] for r in decontam.decontaminated(second, bench).collect()
           if r["contaminated"]}
    assert {r["doc_id"] for r in third.collect()} == {
        r["doc_id"] for r in second.collect()} - hit
    fourth = corpus_pipeline.mixed(spark, third, SMALL)
    copies = Counter(r["doc_id"] for r in fourth.collect())
    assert fourth.columns == COLUMNS and max(copies.values()) <= 2
    assert set(copies) <= {r["doc_id"] for r in third.collect()}
    last = corpus_pipeline.tokens(spark, fourth, SMALL)
    assert last.count() == fourth.count()


def test_stages_on_awkward_and_empty_tables(spark, awkward):
    for docs in (awkward, spark.createDataFrame([], DOC_SCHEMA)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == COLUMNS
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 100 and rows.filter("n_tokens < 1").count() == 0


def shingled(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups_of(rows):
    """Rows by near copies of their texts, every pair compared; equal rows are one."""
    rows = sorted(set(rows), key=repr)
    group = list(range(len(rows)))
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            x, y = shingled(a[1]), shingled(b[1])
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                group = [group[i] if g == group[j] else g for g in group]
    return [[r for r, g in zip(rows, group) if g == k] for k in set(group)]


def test_near_copies_are_decided_by_the_own_text_of_a_row(spark):
    base, other = prose(11, 60), prose(12, 60)
    near = base + " tail"
    rows = [(1, base), (1, other), (1, prose(13, 40)), (2, near), (3, other), (None, base),
            (None, base), (None, prose(14, 30)), (None, prose(14, 30)), (None, prose(15, 20)),
            (None, prose(15, 20) + " x"), (4, prose(16, 50)), (4, prose(16, 50)), (5, ""), (6, "")]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows] + [(4, prose(16, 50), "de", "b", 2)],
                                 DOC_SCHEMA)
    want = sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups_of(rows)), key=repr)
    for parts in (1, 5):
        got = corpus_pipeline.near_copies(spark, docs.repartition(parts), SMALL).collect()
        found = sorted(((r["doc_id"], r["text"]) for r in got), key=repr)
        assert [r[0] for r in found] == [r[0] for r in want]
        assert [g for r in found for g in groups_of(rows) if r in g] == [
            g for r in want for g in groups_of(rows) if r in g]
        assert [r["lang"] for r in got if r["doc_id"] == 4] == ["de"]
