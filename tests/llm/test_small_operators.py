"""Operators on documents against brute force, on awkward rows."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from knownwhen.llm import decontam, langid, mixing, pii, sharding, tokenfile
from tests.llm.conftest import DOC_SCHEMA, prose, rows_of

PATH = public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------ personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    digits = [int(c) for c in s if c in "0123456789"]
    return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            n = sum(c in "0123456789" for c in m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= n <= 19 and luhn(m[0])
                    or kind == "phone" and 9 <= n <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_on_awkward_rows(awkward, crowded, nothing):
    got = pii.personal_data(awkward)
    for row, doc in zip(sorted(got.collect(), key=repr), sorted(got.collect(), key=repr)):
        assert row == doc
    texts = {(r["doc_id"], r["text"]) for r in awkward.collect()}
    want = sorted((i, hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest())
                  for i, t in texts if i is not None)
    found = {(r["doc_id"], r["base_sha256"]) for r in got.collect() if r["doc_id"] is not None}
    assert sorted(found) == want
    assert rows_of(got) == rows_of(pii.personal_data(crowded))
    assert rows_of(pii.personal_data(nothing)) == []


@pytest.mark.parametrize("letters", ["0123456789.@+- ()ab", "1.", "4 -", "+1 ()", "a@.b"])
def test_base_spans_of_all_short_and_random_strings(letters):
    anchors, draw = pii.automaton(), random.Random(letters)
    texts = ["".join(t) for n in range(4) for t in itertools.product(letters[:8], repeat=n)]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(4, 50)))
              for _ in range(4000)]
    for text in texts:
        found = pii.spans(text, anchors)
        assert pii.listed(found, pii.BASE).split(",") == (base_spans(text) or [""]), text


def test_added_spans():
    text = ("see https://example.org/a?b=c). token = \"abcdef0123456789\", IBAN: "
            "DE89 3704 0044 0532 0130 00 and account no 12345678.")
    found = pii.spans(text, pii.automaton())
    shown = {k: [text[a:b] for a, b in v] for k, v in found.items() if v}
    assert shown["url"] == ["https://example.org/a?b=c"]
    assert shown["secret"] == ["abcdef0123456789"]
    assert shown["iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert shown["account"][-1] == "12345678"


def test_cue_words_in_any_case_and_long_numbers():
    anchors = pii.automaton()
    for cue in ("API Key: ", "Api_Key=", "ToKeN = ", "PASSWORD:"):
        found = pii.spans(f"x {cue}abcdefgh12 y", anchors)
        assert [b - a for a, b in found["secret"]] == [10], cue
    number = "7" * 40
    found = pii.spans(f"account {number}.", anchors)
    assert found["account"] == [(8, 48)]
    assert pii.spans("İ token=abcdefgh12", anchors)["secret"] == [(8, 18)]


@pytest.mark.parametrize("unit", ["http://", "token=", "password:'", "account 1 ", "a@b.", "+1 2"])
def test_crafted_texts_of_a_megabyte_take_seconds(unit):
    text, anchors = unit * ((1 << 20) // len(unit)), pii.automaton()
    begin = time.process_time()
    pii.spans(text, anchors)
    assert time.process_time() - begin < 20  # hours when every cue reads on to the end


# ------------------------------------------------------------------ mixing

def test_mix_of_awkward_rows(awkward, crowded, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    sizes = Counter()
    for r in awkward.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert {r["source_size"] for r in rows} == set(sizes.values())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert rows_of(mixing.mix(awkward)) == rows_of(mixing.mix(crowded))
    assert rows_of(mixing.mix(nothing)) == []


def test_targets_fill_up_to_their_caps(spark):
    sizes = spark.createDataFrame(
        [("b", 10), ("a", 1000), ("d", 300), ("c", 4000), (None, 7), ("e", 0)],
        "source string, size long")
    got = {r["source"]: r for r in mixing.targets(sizes).collect()}
    order = sorted((s for s in got if s is not None)) + [None]
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    want, total = {}, 1.5 * 5317
    free = set(order)
    while True:  # as the contract puts it
        rest = total - sum(want.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 2 * got[s]["source_size"]]
        if not over:
            break
        for s in over:
            want[s] = 2 * got[s]["source_size"]
            free.discard(s)
    want |= share
    for s in order:
        assert math.isclose(got[s]["target"], want[s], abs_tol=1e-6)


def test_schedule_follows_the_shares_at_every_length(spark):
    sizes = spark.createDataFrame([("a", 900), ("b", 3000), ("c", 40000)], "source string, size long")
    goals = mixing.targets(sizes)
    whole = {r["source"]: r["high"] - r["low"] for r in goals.collect()}
    slots = mixing.schedule(spark, goals, 5000).orderBy("slot").collect()
    assert [r["slot"] for r in slots] == list(range(5000))
    seen = Counter()
    for n, r in enumerate(slots, 1):
        assert r["rank"] == seen[r["source"]]
        seen[r["source"]] += 1
        assert all(abs(seen[s] - n * share) < 6 for s, share in whole.items())


# ------------------------------------------------------------------ token blocks

def direct_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_token_file_of_awkward_rows(awkward, crowded, nothing):
    rows = sorted(((r["doc_id"], r["text"]) for r in awkward.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for (i, _), ids in zip(rows, direct_ids([t for _, t in rows])):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    want.sort(key=repr)
    for df in (awkward, crowded):
        assert rows_of(tokenfile.documents(tokenfile.written(df, PATH))) == want
    small = tokenfile.written(awkward, PATH, block=50)  # most documents span blocks
    assert rows_of(tokenfile.documents(small)) == want
    assert rows_of(tokenfile.documents(tokenfile.written(nothing, PATH))) == []


def test_word_memory_gives_the_ids_of_whole_texts():
    texts = ["Don't STOP\n\n\nme  now", "a b c", "é ́x", "x\x1cy \x85 z",
             "<|endoftext|> a<|startoftext|>b", "ΑΣ ΑΣ.", "İstanbul", "́", " lead trail ",
             "日本語 テキスト", "1234 a1b2", "tab\tnew\rline"]
    texts += ["it's we're I'll they've I'm you'd O'Neil 'tis 's" + "'s x'rex a'l a'll 'll",
              "a" * 3000, "'", "'" * 2, "'s", "x '", "ÀÉß Straße ×÷ ªº µ²½ 1/2", "a\xa0b\x85c"]
    draw = random.Random(8)
    letters = [chr(c) for c in range(1, 256)] + list("'" * 4 + "sstrevmld   .,$ΣςİſﬁÅ漢")
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    whole = tokenfile.PART
    for part in (whole, 64):
        tokenfile.PART = part
        try:
            got = tokenfile.WordIds(PATH, 500).of(texts)
        finally:
            tokenfile.PART = whole
        assert [list(map(int, g)) + [1] for g in got] == direct_ids(texts)


@pytest.mark.parametrize("ids", [[5], [0, 2 ** 32 - 1], [7] * 100, list(range(5000)),
                                 [1] * 990 + [40000] * 10, [2 ** 31, 2 ** 31 + 3, 2 ** 31 + 1]])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    b = tokenfile.packed(ids)
    back = tokenfile.unpacked(len(ids), b["base"], b["width"], b["packed"], b["exc_at"],
                              b["exc_value"])
    assert list(back) == list(ids)
    if list(ids[:2]) == [1, 1]:
        assert b["width"] == 1 and len(b["exc_at"]) == 40


# ------------------------------------------------------------------ language

def test_language_of_awkward_rows(spark, awkward, crowded, nothing):
    rows = langid.languages(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        text = {d["doc_id"]: d["text"] for d in awkward.collect()}[r["doc_id"]] \
            if r["doc_id"] is not None else None
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
            letters = any(c.isalpha() for c in text or "")
            assert (r["lang_pred"] == "und") == (not letters)
        else:
            assert r["held_out"]
        assert 0 <= r["score"] <= 1
    assert rows_of(langid.languages(awkward)) == rows_of(langid.languages(crowded))
    assert rows_of(langid.languages(nothing)) == []


def test_held_out_accuracy(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    said = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter(
        "held_out and lang is not null").collect()
    right = [r["lang"] == r["lang_pred"] for r in said]
    assert len(right) > 100 and sum(right) / len(right) > 0.98


def spoken(spark, languages, rows):
    """Languages of two letters each: (doc_id, text, lang)."""
    made = []
    for k in range(languages):
        a, b = chr(0x4E00 + 2 * k), chr(0x4E01 + 2 * k)
        made += [(1000 * k + i, f"{a * (i % 5 + 1)} {b * 3} {a}{b}{a}", f"l{k:03}")
                 for i in range(rows + 20 * (k < 50))]
    return spark.createDataFrame(made, "doc_id long, text string, lang string")


def test_more_languages_than_the_sample_has_room_for_at_full_size(spark):
    docs = spoken(spark, 60, 6)
    model = langid.train(docs)
    assert len(model.languages) == 60
    said = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["lang"] == r["lang_pred"] for r in said)


@pytest.mark.parametrize("limit", [1, 200])
def test_the_sample_shrinks_and_no_language_goes(spark, monkeypatch, limit):
    monkeypatch.setattr(langid, "SAMPLE_LIMIT", limit)
    docs = spoken(spark, 20, 80)
    rows = langid._sample(docs, langid._frequencies(docs, 12)[2], 400, 12)
    of = Counter(lang for lang, _, _ in rows)
    assert len(of) == 20 and min(of.values()) >= langid.LEAST_ROWS
    assert len(rows) < 2 * max(limit, 20 * langid.LEAST_ROWS)
    same = spark.createDataFrame([(1, "ab", "x")] * 500 + [(2, None, "y"), (3, "12", "z")],
                                 "doc_id long, text string, lang string")
    rows = langid._sample(same, langid._frequencies(same, 12)[2], 4, 12)
    assert {lang for lang, _, _ in rows} == {"x"} and len(rows) in (1, 500)


def test_counts_do_not_depend_on_pieces():
    letters = langid._letters()
    text = prose(5, 300) + " Ünï 漢字 \U0001f600"
    whole = langid.ngram_counts(text, letters)
    piece, langid.PIECE = langid.PIECE, 37
    try:
        assert (langid.ngram_counts(text, letters) == whole).all()
    finally:
        langid.PIECE = piece


# ------------------------------------------------------------------ decontamination

def windows_hit(docs, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    wins = {}
    for name, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k:k + 10]), set()).add("" if name is None else str(name))
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for part, who in wins.items():
            for k in range(len(w) - len(part) + 1):
                if tuple(w[k:k + len(part)]) == part:
                    hit.update(range(k, k + len(part)))
                    names |= who
        out.append((i, len(w), len(hit), len(names),
                    hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [2_000_000, 40])
def test_decontamination_of_awkward_rows(spark, awkward, crowded, nothing, limit):
    texts = [r["text"] for r in awkward.collect() if r["text"]]
    items = [(1, " ".join(texts[0].split()[5:25])), (12, " ".join(texts[0].split()[20:50])),
             (2, "One-two"), (3, None), (4, ""), (5, "nowhere to be found"), (2, "one two"),
             (None, "漢字"), (7, texts[2].lower())]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, node int")
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    for df in (awkward, crowded):
        assert rows_of(decontam.decontaminated(df, bench, limit=limit)) == windows_hit(docs, items)
    assert rows_of(decontam.decontaminated(nothing, bench)) == []
    none = rows_of(decontam.decontaminated(awkward, bench.limit(0)))
    assert none == windows_hit(docs, [])


def test_phrases_and_proximity_in_an_index_of_all_words(spark):
    docs = spark.createDataFrame([(1, "a b c a b d"), (2, "b c x x x a"), (3, "c a")],
                                 "doc_id long, text string")
    row = decontam.segments(docs.coalesce(1)).first()
    seg = decontam.Postings(row["terms"], row["term_counts"], row["positions"], row["doc_words"])
    assert [int(x) for x in seg.phrase([b"a", b"b"])] == [0, 3]
    assert len(seg.phrase([b"d", b"b"])) == 0  # not across documents
    near = seg.near([b"a", b"c"], 2)
    assert {row["doc_ids"][int(d)] for d in seg.document(near)} == {1, 3}


def nearby(docs, items, distance):
    """Places of an item's first word that have all its words within a distance, by a scan."""
    out = []
    for i, text in docs:
        w, places, names = (text or "").split(), set(), set()
        for name, item in items:
            first, *others = item.split()
            for k in range(len(w)):
                about = w[max(0, k - distance):k + distance + 1]
                if w[k] == first and set(others) <= set(about):
                    places.add(k)
                    names.add(str(name))
        out.append((i, len(w), sorted(places), sorted(names)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [2_000_000, 5])
def test_proximity_equals_a_scan(spark, limit):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(0, 30)))) for i in range(60)]
    docs += [(None, None), (3, "a b"), (3, "a b")]
    items = [(1, "a b"), (2, "c d e"), (3, "h h a"), (4, "z a"), (5, "f")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for distance in (1, 4):
        got = decontam.matches(df, bench, limit=limit, distance=distance)
        assert rows_of(got) == nearby(docs, items, distance)


def test_words_that_share_a_bit_of_the_map_change_nothing(spark, monkeypatch):
    docs = [(i, prose(i, 80)) for i in range(20)]
    items = [(9, " ".join(docs[4][1].split()[10:30]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.word_map([], 4) == bytes(2)
    full = decontam.word_map
    monkeypatch.setattr(decontam, "word_map", lambda texts: full(texts, 3))
    assert rows_of(decontam.decontaminated(df, bench)) == windows_hit(docs, items)


def test_only_phrases_without_a_missing_word_are_visited():
    block = decontam._Phrases([((b"a", b"b"), ["1"]), ((b"c",), ["2"]), ((b"b", b"z"), ["3"])])
    assert list(block.possible([b"a", b"b", b"q"], [3, 1, 2])) == [0]
    assert list(block.possible([], [])) == []
    assert list(decontam._Phrases([]).possible([b"a"], [1])) == []


# ------------------------------------------------------------------ sharding

def test_shards_of_awkward_rows(awkward, crowded, nothing):
    rows = sharding.sharded(awkward).collect()
    assert len(rows) == awkward.count()
    of = Counter(r["shard"] for r in rows)
    for s in of:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(of[s]))
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1,
                    zlib.crc32((r["text"] or "").encode())) for r in awkward.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert rows_of(sharding.sharded(awkward)) == rows_of(sharding.sharded(crowded))
    assert rows_of(sharding.sharded(nothing)) == []


def test_shards_are_even_and_copies_stay_together(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    rows = sharding.sharded(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    sums = Counter()
    where = {}
    for r in rows:
        sums[r["shard"]] += r["size"]
        where.setdefault(r["text"], set()).add(r["shard"])
    mean = sum(sums.values()) / 16
    assert len(sums) == 16 and all(abs(x - mean) < 0.02 * mean for x in sums.values())
    assert all(len(x) == 1 for x in where.values())


def test_a_group_larger_than_a_shard_is_split(spark):
    rows = [(i, "same text here" if i % 3 else prose(i, 6), None, None, None) for i in range(900)]
    got = sharding.sharded(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    mean = sum(sums.values()) / 16
    assert len(sums) == 16 and all(abs(x - mean) < 0.15 * mean for x in sums.values())


# ------------------------------------------------------------------ exact token ids

def test_words_that_share_a_polynomial_hash_keep_their_own_ids():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(PATH), []
    for letters in (1024, 4096):
        word = "a"
        while len(word) < letters:
            word += word.translate(str.maketrans("ab", "ba"))
        words += [word, word.translate(str.maketrans("ab", "ba"))]
    words += ["abcdefg", "abcdefgh", "abcdefg\x00", "abc\x00", "abc\x00\x00", "\x00", "\x00\x00"]
    texts = [" ".join(words), " ".join(reversed(words)), *words]
    got = tokenfile.WordIds(PATH, 500).of(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text[:40]


def test_a_tokenizer_with_another_rule_is_refused(tmp_path):
    with open(PATH) as f:
        other = f.read().replace("'s|'t|", "'s|")
    (tmp_path / "other.json").write_text(other)
    with pytest.raises(ValueError):
        tokenfile.WordIds(str(tmp_path / "other.json"), 10)


# ------------------------------------------------------------------ groups that fit a shard

def test_a_group_that_fits_a_shard_stays_together(spark):
    rows = [(i, "same text" if i < 1000 else f"text {i % 10}{i:05d}", None, None, None)
            for i in range(16_000)]
    got = sharding.sharded(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    assert len({r["shard"] for r in got if r["doc_id"] < 1000}) == 1
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) <= 1.02 * min(sizes.values())
