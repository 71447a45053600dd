"""Benchmark decontamination with a positional inverted index over the training texts.

The index is a table of *segments*. One row covers some consecutive documents of
a partition and holds, for every indexed word, the sorted positions at which it
stands, counted through the segment. Documents are one position apart, so no
phrase can run from one document into the next. Building needs no shuffle: a
segment is as large as one task's slice of the input allows (``SEGMENT_WORDS``),
and one very long document is a segment of its own.

A phrase is found by taking the position lists of its words, shifted by their
offsets, from the rarest word of the segment on, and intersecting them; the first
empty intersection ends it. A table of each phrase's words and the segment's counts
says first which phrases have no word that is missing there, so only these are
visited. With a ``distance`` a match is a place of the first word that has every other
word within so many words of it in the same document, in any order.

Searches take a stated query set (benchmark items) against all segments, in
blocks of at most ``QUERY_WORDS`` words, so that what is sent to the executors
has a fixed bound; the hits of a block are written before the next one is read. The
index is limited to words that set a bit of a fixed map of ``2 ** FILTER_BITS`` bits:
all words of the query set and, by chance, few others, however many it has.

Words are maximal runs of ASCII letters (A-Z lower-cased), digits and non-ASCII
characters. Defined results: null and empty texts have no words and are never
hit; items without words match nothing; a null item_id counts as the item
"" (empty); rows that repeat an item_id count as one item; a repeated document
row gives a row each time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx
from knownwhen.sources.shared import new_folder, remove, scratch, settle

WINDOW = 10
SEGMENT_WORDS = 1_000_000
SEGMENT_DOCS = 20_000
#: Words of the query set that are searched at a time.
QUERY_WORDS = 2_000_000
#: Bits of a word's hash that the map of the query set's words goes by.
FILTER_BITS = 24

_SEGMENT = ("doc_ids array<long>, doc_words array<int>, terms array<binary>, "
            "term_counts array<int>, positions binary")
_HITS = "segment long, no int, hits array<int>, items array<string>"

#: Bytes of words keep their (lower-cased) value, all others become a space.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))


def words(text: str | None) -> list[bytes]:
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


# ------------------------------------------------------------------ index

def _segment(ids: list, lengths: list[int], codes: list[np.ndarray],
             terms: list[bytes]) -> pa.RecordBatch:
    """One index row. ``codes`` has a term's number per word of a document, -1: not indexed."""
    joined = np.full(sum(lengths) + len(lengths), -1, np.int32)
    at = 0
    for part in codes:
        joined[at:at + len(part)] = part
        at += len(part) + 1
    places = np.flatnonzero(joined >= 0)
    found = joined[places]
    order = np.argsort(found, kind="stable")
    used, counts = np.unique(found, return_counts=True)
    return pa.RecordBatch.from_arrays([
        pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
        pa.array([[terms[t] for t in used]], pa.list_(pa.binary())),
        pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
        pa.array([places[order].astype(np.int32).tobytes()], pa.binary())],
        names=["doc_ids", "doc_words", "terms", "term_counts", "positions"])


def word_map(texts: Iterable[str | None], bits: int = FILTER_BITS) -> bytes:
    """A map with the bit of every word of ``texts`` set."""
    seen = np.zeros(1 << bits, bool)
    for text in texts:
        for word in set(words(text)):
            seen[crc32(word) & (1 << bits) - 1] = True
    return np.packbits(seen, bitorder="little").tobytes()


class _Numbers(dict):
    """Words of a segment by number in order of appearance, -1 for those not in the map."""

    def __init__(self, only: bytes | None):
        super().__init__()
        self.only, self.terms = only, []

    def __missing__(self, word: bytes) -> int:
        number = -1
        if self.only is None or self._mapped(crc32(word) & len(self.only) * 8 - 1):
            number = len(self.terms)
            self.terms.append(word)
        self[word] = number
        return number

    def _mapped(self, bit: int) -> int:
        return self.only[bit >> 3] >> (bit & 7) & 1


def segments(docs: DataFrame, only: bytes | None = None,
             segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of (doc_id, text). ``only``: a :func:`word_map`; None: all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, lengths, codes, total = _Numbers(only), [], [], [], 0
        for rows in tx.slices(batches):
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                found = words(text)
                if ids and (total + len(found) > segment_words or len(ids) >= SEGMENT_DOCS):
                    yield _segment(ids, lengths, codes, numbers.terms)
                    numbers, ids, lengths, codes, total = _Numbers(only), [], [], [], 0
                codes.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                ids.append(doc_id)
                lengths.append(len(found))
                total += len(found)
        if ids:
            yield _segment(ids, lengths, codes, numbers.terms)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, _SEGMENT)


class Postings:
    """One segment, read: position lists by word and the documents' ranges."""

    def __init__(self, terms: list[bytes], counts: list[int], positions: bytes,
                 doc_words: list[int]):
        self.places = np.frombuffer(positions, np.int32)
        ends = np.cumsum(counts)
        self.range = {t: (int(e) - c, int(e)) for t, c, e in zip(terms, counts, ends)}
        self.length = np.asarray(doc_words, np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length + 1)[:-1]]).astype(np.int64)
        self.size = int((self.length + 1).sum())

    def of(self, word: bytes) -> np.ndarray:
        begin, end = self.range.get(word, (0, 0))
        return self.places[begin:end]

    def phrase(self, parts: list[bytes]) -> np.ndarray:
        """Start positions of the exact phrase."""
        order = []
        for offset, word in enumerate(parts):
            span = self.range.get(word)
            if span is None:
                return np.empty(0, np.int32)
            order.append((span[1] - span[0], offset, span))
        order.sort()
        _, offset, (begin, end) = order[0]
        starts = self.places[begin:end] - offset
        for _, offset, (begin, end) in order[1:]:
            if not len(starts):
                break
            places = self.places[begin:end]
            wanted = starts + offset
            at = np.searchsorted(places, wanted)
            at[at == len(places)] = 0
            starts = starts[places[at] == wanted]
        return starts

    def near(self, parts: list[bytes], distance: int) -> np.ndarray:
        """Places of the first word that have every other word within ``distance`` words in
        the same document."""
        places = self.of(parts[0])
        doc = self.document(places)
        low = np.maximum(places - distance, self.begin[doc])
        high = np.minimum(places + distance, self.begin[doc] + self.length[doc] - 1)
        for others in sorted((self.of(w) for w in set(parts[1:]) - {parts[0]}), key=len):
            keep = (np.searchsorted(others, low)
                    < np.searchsorted(others, high, side="right"))
            places, low, high = places[keep], low[keep], high[keep]
        return places

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, positions, side="right") - 1


def windows(text: str | None, size: int = WINDOW) -> list[list[bytes]]:
    """Runs of ``size`` consecutive words; a shorter text is one window."""
    found = words(text)
    if not found:
        return []
    return [found[i:i + size] for i in range(max(1, len(found) - size + 1))]


# ------------------------------------------------------------------ search

#: Words of phrases that are looked at in one step.
_STEP = 1 << 20


class _Phrases:
    """A block of phrases as a table of word numbers, a row a phrase."""

    def __init__(self, phrases: list[tuple[tuple[bytes, ...], list[str]]]):
        self.phrases = phrases
        self.number: dict[bytes, int] = {}
        for parts, _ in phrases:
            for word in parts:
                self.number.setdefault(word, len(self.number))
        width = max((len(parts) for parts, _ in phrases), default=1)
        self.table = np.full((len(phrases), width), len(self.number), np.int32)
        for row, (parts, _) in zip(self.table, phrases):
            row[:len(parts)] = [self.number[w] for w in parts]

    def possible(self, terms: list[bytes], counts: list[int]) -> Iterator[int]:
        """Phrases whose rarest word is there."""
        there = np.zeros(len(self.number) + 1, bool)
        there[-1] = True  # what fills up the rows of short phrases
        for word, count in zip(terms, counts):
            if word in self.number:
                there[self.number[word]] = count > 0
        step = max(1, _STEP // self.table.shape[1])
        for at in range(0, len(self.table), step):
            yield from (at + np.flatnonzero(there[self.table[at:at + step]].all(axis=1))).tolist()


def _searched(index: DataFrame, phrases: list[tuple[tuple[bytes, ...], list[str]]],
              distance: int | None) -> DataFrame:
    """(segment, no, hits, items) of the documents that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Phrases(phrases)
        for rows in tx.slices(batches, 1):
            for segment, lengths, terms, counts, places in zip(
                    rows["segment"], rows["doc_words"], rows["terms"], rows["term_counts"],
                    rows["positions"]):
                seg = Postings(terms, counts, places, lengths)
                edges = np.zeros(seg.size + 1, np.int32)
                items: dict[int, set[str]] = {}
                for n in block.possible(terms, counts):
                    parts, names = phrases[n]
                    exact = distance is None
                    starts = seg.phrase(list(parts)) if exact else seg.near(list(parts), distance)
                    if not len(starts):
                        continue
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, starts + (len(parts) if exact else 1), -1)
                    for doc in np.unique(seg.document(starts)):
                        items.setdefault(int(doc), set()).update(names)
                hit = np.flatnonzero(np.cumsum(edges) > 0)
                doc = seg.document(hit)
                inside = (hit - seg.begin[doc]).astype(np.int32)
                found = sorted(items)
                begins, ends = np.searchsorted(doc, found), np.searchsorted(doc, found, "right")
                for at in range(0, len(found), 4096):
                    some = slice(at, at + 4096)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([segment] * len(found[some]), pa.int64()),
                        pa.array(found[some], pa.int32()),
                        pa.array([inside[b:e] for b, e in zip(begins[some], ends[some])],
                                 pa.list_(pa.int32())),
                        pa.array([sorted(items[i]) for i in found[some]], pa.list_(pa.string()))],
                        names=["segment", "no", "hits", "items"])

    return index.select("segment", "doc_words", "terms", "term_counts", "positions").mapInArrow(
        run, _HITS)


def query_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 size: int = WINDOW, limit: int = QUERY_WORDS
                 ) -> Iterator[list[tuple[tuple[bytes, ...], list[str]]]]:
    """The distinct windows of the items with the items they come from, block by block."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        F.col(text_col).alias("text"))
    block: dict[tuple[bytes, ...], set[str]] = {}
    held = 0
    for row in rows.toLocalIterator():
        for part in windows(row["text"], size):
            block.setdefault(tuple(part), set()).add(row["item"])
            held += len(part)
            if held >= limit:
                yield [(k, sorted(v)) for k, v in block.items()]
                block, held = {}, 0
    if block:
        yield [(k, sorted(v)) for k, v in block.items()]


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", size: int = WINDOW,
            limit: int = QUERY_WORDS, distance: int | None = None) -> DataFrame:
    """Per document: n_words, hits (positions of its hit words), items (ids as sorted strings).

    With a ``distance`` the words of a window need only be near its first word, and the
    positions are those of first words.
    """
    spark = docs.sparkSession
    fr.bounded_batches(spark)
    docs = fr.documents(docs, id_col, text_col)
    only = word_map(r["text"] for r in items.select(
        F.col(item_text).alias("text")).toLocalIterator())
    with scratch(spark):
        index = segments(docs, only).withColumn("segment", F.monotonically_increasing_id())
        index = settle(index, "postings")
        folder = new_folder(spark, "block-hits")
        try:
            found = _all_hits(index, query_blocks(items, item_col, item_text, size, limit),
                              distance, folder)
            return fr.stored(found, "hits", outlive=True)
        finally:
            remove(spark, folder)


def _all_hits(index: DataFrame, blocks: Iterable[list], distance: int | None,
              folder: str) -> DataFrame:
    """A row per document of the index with its hits of all blocks, one block at a time."""
    spark = index.sparkSession
    spark.createDataFrame([], _HITS).write.parquet(folder)
    for block in blocks:
        _searched(index, block, distance).write.mode("append").parquet(folder)
    hits = spark.read.schema(_HITS).parquet(folder).groupBy("segment", "no").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    each = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias(
        "no", "d")).select("segment", "no", "d.doc_ids", "d.doc_words")
    return each.join(hits, ["segment", "no"], "left").select(
        F.col("doc_ids").alias("doc_id"), F.col("doc_words").cast("long").alias("n_words"),
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminated(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    found = matches(docs, items, **columns)
    names = F.array_sort(F.array_distinct("items"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))
