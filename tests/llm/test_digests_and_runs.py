"""Exact dedup, the source audit and periodic runs against brute force, on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from knownwhen.llm import digest_index, divergence, queries, runs
from tests.llm.conftest import DOC_SCHEMA, prose, rows_of

# ------------------------------------------------------------------ exact dedup


def same_texts(rows):
    """(doc_id, keep_id, group_size, sha256) per row, and how many of a group stay."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), hashlib.sha256(key.encode()).hexdigest())
                for i, _ in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("portions", [1, 2, 5])
def test_exact_duplicates(spark, awkward, crowded, nothing, portions):
    more = spark.createDataFrame(
        [(900 + i, t, None, None, None) for i, t in enumerate(
            ["a b", "ab", " a\tb ", "a\x0bb\x0c\r\n", "a b", "A b", "", None, "\x1fab", "a b "])],
        DOC_SCHEMA)
    docs = awkward.unionByName(more)
    got = digest_index.exact_duplicates(docs, portions=portions).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got),
                  key=repr) == same_texts([tuple(r) for r in docs.collect()])
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and set(kept) == {r["text_sha256"] for r in got}
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    one = digest_index.exact_duplicates(crowded, portions=portions).drop("kept")
    assert rows_of(one) == rows_of(digest_index.exact_duplicates(awkward).drop("kept"))
    assert rows_of(digest_index.exact_duplicates(nothing, portions=portions)) == []


def test_index_outlives_its_session_entry_and_takes_a_portion_once(spark):
    def portion(texts):
        return digest_index.digested(spark.createDataFrame(
            [(i, t, None, None, None) for i, t in texts], DOC_SCHEMA))

    index = digest_index.DigestIndex.new(spark, 10)
    first = portion([(1, "x"), (2, "y"), (3, "x ")])
    assert index.take(first, 0).count() == 2
    spark.sql(f"DROP TABLE {index.name}")  # the entry goes, the files stay
    again = digest_index.DigestIndex(spark, index.path, index.buckets).opened()
    second = portion([(4, "y"), (5, "z"), (6, " x ")])
    new = again.take(second, 1)
    assert [r["best"]["doc_id"] for r in new.collect()] == [5]
    before = rows_of(again.entries())
    assert [r["best"]["doc_id"] for r in again.take(second, 1).collect()] == [5]
    assert rows_of(again.entries()) == before
    best = {bytes(r["digest"]).hex()[:4]: (r["copies"], r["best"]["doc_id"])
            for r in again.groups().collect()}
    assert sorted(best.values()) == [(1, 5), (2, 2), (3, 6)]


def test_the_index_is_not_shuffled(spark):
    index = digest_index.DigestIndex.new(spark, 10)
    rows = spark.createDataFrame([(i, f"t{i}", None, None, None) for i in range(50)], DOC_SCHEMA)
    index.take(digest_index.digested(rows), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        folded = index.entries().select(F.sha2("digest", 256).cast("binary").alias("digest"))
        plan = folded.join(index.entries(), "digest", "left_anti")._jdf.queryExecution()
        text = plan.executedPlan().toString()
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1
        groups = index.groups()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in groups
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_digest_is_found_by_broadcast(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}", None, None, None) for i in range(2000)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = digest_index.exact_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got),
                  key=repr) == same_texts(rows)


# ------------------------------------------------------------------ source audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit(rows, top=200, least=3):
    uses, having, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = TERM.findall(low)
        uses[lang, source].update(found)
        having[lang].update(set(found))
    out = []
    for lang in {g for g, _ in groups}:
        kept = sorted(t for t, n in having[lang].items() if n >= least)
        sources = sorted(s for g, s in groups if g == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(uses[lang, s]) for s in sources}
        every = sum((uses[lang, s] for s in sources), Counter())
        q = shares(every)
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o)
                    for o in sources if o != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept
                    if uses[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1)
                        for i, (value, item) in enumerate(found[:most])]
    return sorted(out, key=repr)


def test_audit_of_awkward_rows(spark, awkward, crowded, nothing):
    rows = [tuple(r) for r in awkward.collect()]
    assert rows_of(divergence.audited(awkward)) == audit(rows)
    assert rows_of(divergence.audited(crowded)) == audit(rows)
    assert rows_of(divergence.audited(nothing)) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_of_random_corpora(spark, seed):
    draw = random.Random(seed)
    rows = [(i, " ".join(draw.choice(["Ab", "cé", "dd", "x", "漢", "zz9z", "q_q"][:draw.randint(1, 7)])
                         for _ in range(draw.randint(0, 9))),
             draw.choice(["a", "b", None]), draw.choice(["s1", "s2", "s10", "", None, "é"]), 0)
            for i in range(150)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    assert rows_of(divergence.audited(docs, top=3)) == audit(rows, top=3)


@pytest.mark.parametrize("seed", range(5))
def test_tree_equals_pairs_of_rows(seed):
    draw = random.Random(seed)
    zero = {s: draw.randint(1, 50) for s in range(6)}
    rows = sorted({(draw.randint(0, 1), tuple((s, draw.randint(1, 3)) for s in range(6)
                                              if draw.random() < 0.6)) for _ in range(80)})
    times = [draw.randint(1, 9) for _ in rows]
    want = Counter()
    for (lang, path), n in zip(rows, times):
        for (a, p), (b, q) in itertools.permutations(path, 2):
            def f(x, y):
                return (x - y) ** 2 // y
            want[lang, a, b] += n * (f(p, q) - f(p, zero[b]) - f(zero[a], q) + f(zero[a], zero[b]))
    flat = [(s, p, zero[s]) for _, path in rows for s, p in path]
    columns = np.array(flat, np.int64).reshape(-1, 3).T
    begin = np.cumsum([0, *[len(path) for _, path in rows]])
    key, total = divergence.tree_corrections(
        np.array([lang for lang, _ in rows]), begin, *columns, np.array(times))
    got = {tuple(map(int, k)): int(v) for k, v in zip(key, total)}
    assert got == dict(want)


def test_shares_of_counts_beyond_64_bits(spark):
    big = 4 * 10 ** 11
    row = spark.createDataFrame([(big, 3 * big, 10 ** 8)], "n long, total long, kept long").select(
        divergence.share(F.col("n"), F.col("total"), F.col("kept"))).first()
    assert row[0] == 1 + 10 ** 9 * (big + 1) // (3 * big + 10 ** 8)


# ------------------------------------------------------------------ periodic runs

def slow_runs(words, least=6, turns=4):
    found, n = set(), len(words)
    for q in range(1, n // turns + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - begin >= max(least, turns * q) and not any(
                    s <= begin and s + length >= i + q for s, length, _ in found):
                found.add((begin, i + q - begin, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def run_digests(doc_id, text, rewrite):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = slow_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("letters", ["a", "ab", "abc"])
def test_runs_of_all_short_and_of_random_words(letters):
    draw = random.Random(letters)
    words = ["".join(w) for n in range(0, 12) for w in itertools.product(letters[:2], repeat=n)]
    for _ in range(150):
        root = [draw.choice(letters) for _ in range(draw.randint(1, 20))]
        words.append("".join(draw.choices(letters, k=draw.randint(0, 9)) + root * draw.randint(
            1, 9) + root[:draw.randint(0, 9)] + draw.choices(letters, k=draw.randint(0, 9))))
    for word in words:
        codes = np.frombuffer(word.encode(), np.uint8).astype(np.int64)
        assert [tuple(r) for r in runs.factor_runs(codes).tolist()] == slow_runs(word), word


def test_runs_of_fibonacci_and_thue_morse_words():
    a, b, t = "a", "ab", "a"
    for _ in range(11):
        a, b = b, b + a
    for _ in range(9):
        t += t.translate(str.maketrans("ab", "ba"))
    for word in (b, t, t + t, b * 4):
        codes = np.frombuffer(word.encode(), np.uint8).astype(np.int64)
        assert [tuple(r) for r in runs.factor_runs(codes, 4, 3).tolist()] == slow_runs(word, 4, 3)


def test_periodic_runs_of_awkward_rows(spark, awkward, crowded, nothing):
    more = ["ha " * 7 + "he", "x y " * 12 + "z", "one two three " * 9, "a a a a a", "b " * 6,
            ("la " * 6 + "di ") * 8, "no break " * 8, "w " * 70_000, prose(5, 900) + " q" * 30]
    docs = awkward.unionByName(spark.createDataFrame(
        [(2000 + i, t, None, None, None) for i, t in enumerate(more)], DOC_SCHEMA))
    rows = [tuple(r) for r in docs.collect() if not (r["text"] or "").startswith("w w")]
    got = runs.digests(runs.periodic_runs(docs, order=queries._planted))
    found = [tuple(r) for r in got.collect() if r["doc_id"] != 2007]
    assert sorted(found, key=repr) == sorted(
        (run_digests(i, t, True) for i, t, *_ in rows), key=repr)
    long = got.filter("doc_id = 2007").first()
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 0, 70_000, 1)
    assert rows_of(runs.periodic_runs(awkward)) == rows_of(runs.periodic_runs(crowded))
    assert rows_of(runs.periodic_runs(nothing)) == []
    texts = {r["doc_id"]: r["text"] for r in runs.periodic_runs(docs).collect()}
    assert texts[2000] == "ha he" and texts[2005] == "la di" and texts[2003] == "a a a a a"
