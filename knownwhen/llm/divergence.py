"""How far the sources of a language differ in their words: an audit with a frequent-pattern tree.

For every (language, source) each kept term has a smoothed share ``p`` in billionths, and two
shares differ by ``f(p, q) = floor((p - q)^2 / q)``. Sources are compared with each other over
all kept terms, and terms with their language.

A source without a term has its zero share ``z`` there, and most terms are missing from most
sources. So the sum over all V terms for a pair (A, B) is taken as

    V f(zA, zB)  +  sum over A's terms of f(pA, zB) - f(zA, zB)
                 +  sum over B's terms of f(zA, pB) - f(zA, zB)
                 +  sum over common terms of f(pA, pB) - f(pA, zB) - f(zA, pB) + f(zA, zB).

The last line is the tree's. Each term is a row of its sources with counts, in source order;
rows that are equal are one with a multiplicity. Rows are sorted, so that equal beginnings
lie next to each other, and every slice of sorted rows is inserted into a tree whose nodes are
(source, share) and carry multiplicities. A node and each of its ancestors are one pair of
sources with one pair of shares: their correction is computed once and multiplied with the
node's terms, however many rows pass through it. Corrections are sums over rows, so a path that continues in the
next slice or task just has a node in both. Middle lines come from histograms of shares.

Exactness: shares are at most 1e9 + 1 and sum to at most 1e9 + V, so every sum of ``f`` stays
below (1e9 + V)^2, which fits 64 bits for a V of up to 1e9; products that may not fit are
taken as decimals.

Terms are counted per task before they are shuffled. A (language, source) that holds most rows
is split by salts in joins and rankings. The row of a term has one entry per source that uses
it; the result itself has one row per pair of sources of a language.

Defined results: null text, language or source count as ''. A language without kept terms has
0 for every pair and no term rows. A language of one source has no pairs. Repeated rows count
as documents of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx
from knownwhen.sources.shared import settle

#: A term is kept where at least this many documents of its language have it.
LEAST_DOCUMENTS = 3
#: Shares are counted in parts of this.
WHOLE = 1_000_000_000
#: Terms reported per source.
TOP = 200
#: Parts that a (language, source) is cut into in joins and rankings.
SALTS = 64
#: Counted terms that a task holds before it hands them on.
HELD = 200_000
#: Rows of a tree.
TREE_ROWS = 1 << 14

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
                 for c in range(256))


# ---------------------------------------------------------------- counting

def _terms(text: str) -> Counter[bytes]:
    """Runs of letters A-Z, a-z and of characters beyond ASCII, A-Z lower-cased."""
    found: Counter[bytes] = Counter()
    for piece in tx.pieces(text.encode("utf-8", "surrogatepass").translate(_LETTERS)):
        found.update(piece.split())
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> pa.RecordBatch:
        langs, sources, terms, uses, docs = [], [], [], [], []
        for (lang, source), (used, having) in groups.items():
            langs += [lang] * len(used)
            sources += [source] * len(used)
            terms += [t.decode("utf-8", "surrogatepass") for t in used]
            uses += used.values()
            docs += map(having.__getitem__, used)
        groups.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()),
             pa.array(terms, pa.string()), pa.array(uses, pa.int64()),
             pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for rows in tx.slices(batches):
        for lang, source, text in zip(rows["lang"], rows["source"], rows["text"]):
            if not text:
                continue
            used, having = groups.setdefault((lang, source), (Counter(), Counter()))
            found = _terms(text)
            used.update(found)
            having.update(found.keys())
        if sum(len(used) for used, _ in groups.values()) > HELD:
            yield handed()
    yield handed()


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that have the term."""
    fr.bounded_batches(docs.sparkSession)
    parts = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---------------------------------------------------------------- shares

def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(WHOLE * (count + 1) / (total + kept)); null where nothing is kept."""
    top = F.lit(WHOLE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    bottom = F.nullif(total + kept, F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", top, bottom) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _sizes(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, total, kept, all, zero): what a source's shares are made of."""
    langs = terms.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("total").alias("all"))
    totals = terms.select("lang", F.explode("per").alias("e")).groupBy(
        "lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("total"))
    none = F.lit(0).cast("long")
    sizes = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").select(
        "lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "kept", "all")])
    return sizes.withColumn("zero", share(none, F.col("total"), F.col("kept")))


def _salted(sizes: DataFrame) -> DataFrame:
    return sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _entries(terms: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, term, p, zero, q): shares of the terms that a source has."""
    each = terms.select("lang", "term", F.col("total").alias("uses"), F.explode("per").alias("e"))
    each = each.select("lang", "term", "uses", "e.*").withColumn("salt", _salt("term"))
    return each.join(_salted(sizes), ["lang", "source", "salt"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        "zero", share(F.col("uses"), F.col("all"), F.col("kept")).alias("q"))


# ---------------------------------------------------------------- terms

def term_values(entries: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source uses more than its language."""
    over = entries.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"),
        _salt("term").alias("salt"))
    order = [F.col("value").desc(), F.col("item")]
    for part in (["lang", "source", "salt"], ["lang", "source"]):
        nth = F.row_number().over(W.partitionBy(*part).orderBy(*order))
        over = over.withColumn("rank", nth).filter(F.col("rank") <= top)
    return over.drop("salt")


# ---------------------------------------------------------------- the tree

def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def tree_corrections(lang: np.ndarray, begin: np.ndarray, source: np.ndarray, p: np.ndarray,
                     zero: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corrections of common terms: keys (lang, a, b) as rows, and their sums.

    Row i is the path ``begin[i]:begin[i + 1]`` through (source, p, zero), ``times`` times.
    Paths are sorted; what two neighbours share from the start are nodes that both pass.
    """
    long = np.diff(begin)
    deepest = int(long.max(initial=0))
    # How deep a row stays on the path of the row before.
    shared = np.zeros(len(long), np.int64)
    on = np.concatenate(([False], lang[1:] == lang[:-1]))
    for depth in range(deepest):
        on[1:] &= (long[1:] > depth) & (long[:-1] > depth)
        row = np.flatnonzero(on)
        here, before = begin[row] + depth, begin[row - 1] + depth
        on[row] = (source[here] == source[before]) & (p[here] == p[before])
        shared[on] += 1
    keys, sums = [np.empty((0, 3), np.int64)], [np.empty(0, np.int64)]
    for depth in range(1, deepest):
        # The nodes of this depth: their first rows, and the terms that pass through them.
        first = np.flatnonzero(shared <= depth)
        passing = np.add.reduceat(times, first)
        deep = long[first] > depth
        first, passing = first[deep], passing[deep]
        step = max(1, (1 << 20) // depth)
        for lot in range(0, len(first), step):
            row, n = first[lot:lot + step], passing[lot:lot + step, None]
            node = (begin[row] + depth)[:, None]
            above = begin[row][:, None] + np.arange(depth)
            for a, b in ((above, node), (node, above)):
                value = n * (_differ(p[a], p[b]) - _differ(p[a], zero[b])
                             - _differ(zero[a], p[b]) + _differ(zero[a], zero[b]))
                key = np.stack(np.broadcast_arrays(lang[row][:, None], source[a], source[b]), -1)
                key, total = _summed(key.reshape(-1, 3), value.reshape(-1))
                keys.append(key)
                sums.append(total)
    return _summed(np.concatenate(keys), np.concatenate(sums))


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    many = [int(x) + 1 for x in key.max(axis=0, initial=0)]
    codes = (key[:, 0] * many[1] + key[:, 1]) * many[2] + key[:, 2]
    known, first, of = np.unique(codes, return_index=True, return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, of, value)
    return key[first], total


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _lots(batches):
        path = table["path"].combine_chunks()
        begin = path.offsets.to_numpy().astype(np.int64)
        item = path.values.slice(0)
        lang, langs = _coded(table["lang"].combine_chunks())
        source, sources = _coded(item.field("source"))
        key, total = tree_corrections(
            lang, begin, source, item.field("p").to_numpy(), item.field("zero").to_numpy(),
            table["times"].to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array([langs[k] for k in key[:, 0]], pa.string()),
             *[pa.array([sources[k] for k in key[:, i]], pa.string()) for i in (1, 2)],
             pa.array(total)], names=["lang", "source", "item", "value"])


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Neighbouring batches together, about ``TREE_ROWS`` rows or 64 MB."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TREE_ROWS or sum(b.nbytes for b in held) > 1 << 26:
            yield pa.Table.from_batches(held)
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _common(entries: DataFrame) -> DataFrame:
    """(lang, source, item, value): the corrections for terms that two sources share."""
    rows = entries.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("source", "p", "zero"))).alias("path"))
    rows = rows.filter(F.size("path") > 1).groupBy("lang", "path").agg(
        F.count(F.lit(1)).alias("times"))
    rows = settle(rows, "audit-paths")
    return rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").mapInArrow(
        _trees, "lang string, source string, item string, value long")


# ---------------------------------------------------------------- pairs

def _alone(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """The corrections for the terms of one source, the other's share being its zero share."""
    shares = entries.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("times"))
    others = _salted(sizes.select("lang", F.col("source").alias("item"), F.col("zero").alias("z")))
    p, zero, z, times = (F.col(c) for c in ("p", "zero", "z", "times"))
    both = shares.withColumn("salt", _salt("source", "p")).join(others, ["lang", "salt"]).filter(
        "source <> item").groupBy("lang", "source", "item").agg(
        F.sum(times * (apart(p, z) - apart(zero, z))).alias("there"),
        F.sum(times * (apart(z, p) - apart(z, zero))).alias("back"))
    return both.select("lang", "source", "item", F.col("there").alias("value")).unionByName(
        both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                    F.col("back").alias("value")))


def pair_values(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank) for every two sources of a language."""
    others = _salted(sizes.select("lang", F.col("source").alias("item"), F.col("zero").alias("z")))
    base = sizes.withColumn("salt", _salt("source")).join(others, ["lang", "salt"]).filter(
        "source <> item").select("lang", "source", "item", F.coalesce(
            F.col("kept") * apart(F.col("zero"), F.col("z")), F.lit(0)).alias("value"))
    every = base.unionByName(_alone(entries, sizes)).unionByName(_common(entries))
    pairs = every.groupBy("lang", "source", "item").agg(
        F.sum(F.col("value").cast("decimal(20,0)")).cast("long").alias("value"))
    nth = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return pairs.withColumn("rank", F.row_number().over(nth))


def audited(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far a source is from the other sources of
    its language (part ``pair``) and the terms it uses more than the language (part ``term``)."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    terms = counted(docs).groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "n")).alias("per"))
    terms = settle(terms.filter(F.col("docs") >= least).drop("docs"), "audit-terms")
    sizes = settle(_sizes(docs.select("lang", "source").distinct(), terms), "audit-sizes")
    entries = settle(_entries(terms, sizes), "audit-entries")
    shown = ["lang", "source", "part", "item", "value", "rank"]
    return pair_values(entries, sizes).withColumn("part", F.lit("pair")).select(*shown).unionByName(
        term_values(entries, top).withColumn("part", F.lit("term")).select(*shown))
