"""Periodic runs of words, found with a dictionary of basic factors.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are identical)
that no neighbouring word extends, at least ``max(LEAST, TURNS * q)`` words long, with at least
three turns.

The dictionary names every factor whose length is a power of two: equal factors have equal
names, and a factor of length ``2 s`` is named by the names of its halves. For a run of
period ``q`` take the power ``s`` with ``s / 2 < q <= s``. The root is primitive, so the
next occurrence of a factor of length ``s`` inside the run is exactly ``q`` words on: within
a window of twice its length the successors form one arithmetic progression of difference
``q``, which proposes the period. Consecutive positions with this difference, extended by
one factor and one period, are the run, and no other stretch and no other length proposes it
(a shorter period would have put an earlier occurrence there). So candidates need no
filter but their length, and none is lost.

A factor that occurs once is never part of a longer one that occurs twice, so only names
that occur again are carried to the next length; after a few words little prose is left.
Documents are named together, many at a time, with words of their own each, so nothing
matches across them. The work of a document of n words is O(n log n) at worst; it is read in
one task, whose memory is a few integers a word. Nothing is shuffled.

Defined results: a null or empty text has no words, no runs and an empty text. Rows are
independent: repeated rows, ties and null ids each give their own row, and other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx

#: A run has at least this many words and this many turns of its period.
LEAST, TURNS = 6, 4
#: Words that are named together (one longer text is taken alone).
TOGETHER = 1 << 17

Order = Callable[[int | None, int], np.ndarray | None]


def factor_runs(words: np.ndarray, least: int = LEAST, turns: int = TURNS) -> np.ndarray:
    """All runs of a sequence of word numbers: rows (start, length, period), by start and period."""
    if turns < 3:
        raise ValueError("a run of fewer than three turns need not hold a factor and its successor")
    found = [np.empty((0, 3), np.int64)]
    at, name, size = np.arange(len(words)), np.asarray(words, np.int64), 1
    while len(at):
        order = np.argsort(name, kind="stable")  # by factor, then by place
        place, named = at[order], name[order]
        again = named[1:] == named[:-1]
        gap = np.zeros(len(words) + 1, np.int64)
        gap[place[:-1][again]] = np.diff(place)[again]
        found.append(_progressions(gap, size, least, turns))
        # Factors that occur again get dense names, and pairs of them name the next length.
        first = np.concatenate(([True], ~again))
        repeated = np.concatenate((again, [False])) | ~first
        dense = np.full(len(words) + size, -1, np.int64)
        dense[place[repeated]] = (np.cumsum(first) - 1)[repeated]
        at = np.sort(place[repeated])
        at = at[(dense[at + size] >= 0)]
        name = dense[at] * len(words) + dense[at + size]
        size *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _progressions(gap: np.ndarray, size: int, least: int, turns: int) -> np.ndarray:
    """Stretches of places whose factor of length ``size`` occurs again the same distance on."""
    at = np.flatnonzero((gap <= size) & (2 * gap > size))
    if not len(at):
        return np.empty((0, 3), np.int64)
    period = gap[at]
    new = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(period) != 0)))
    begin = np.flatnonzero(new)
    last = np.concatenate((begin[1:], [len(at)])) - 1
    start, period = at[begin], period[begin]
    length = at[last] - start + period + size
    keep = length >= np.maximum(least, turns * period)
    return np.stack((start[keep], length[keep], period[keep]), 1)


def repeats(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def numbered(text: str | None) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers, and what they stand for."""
    known: dict[bytes, int] = {}
    parts = []
    for piece in tx.pieces((text or "").encode("utf-8", "surrogatepass")):
        words = piece.split()
        for word in words:
            known.setdefault(word, len(known))
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
    return np.concatenate(parts), list(known)


def _together(rows: dict[str, list], order: Order | None):
    """(row, words, vocabulary) of the rows of a slice, in lots of about ``TOGETHER`` words."""
    lot, total = [], 0
    for doc_id, text in zip(rows["doc_id"], rows["text"]):
        words, known = numbered(text)
        read = order(doc_id, len(words)) if order else None
        lot.append((doc_id, words if read is None else words[read], known))
        total += len(words)
        if total > TOGETHER:
            yield lot
            lot, total = [], 0
    if lot:
        yield lot


def _found(lot: list) -> pa.RecordBatch:
    begin = np.cumsum([0, *[len(words) for _, words, _ in lot]])
    base = np.cumsum([0, *[len(known) for _, _, known in lot]])
    every = np.concatenate([words + b for (_, words, _), b in zip(lot, base)])
    runs = factor_runs(every)
    cut = np.searchsorted(runs[:, 0], begin)
    runs[:, 0] -= np.repeat(begin[:-1], np.diff(cut))
    texts = []
    for (_, words, known), a, b in zip(lot, cut, cut[1:]):
        kept = words[~repeats(runs[a:b], len(words))] if b > a else words
        texts.append(b" ".join(map(known.__getitem__, kept.tolist())).decode(
            "utf-8", "surrogatepass"))
    one = pa.StructArray.from_arrays(
        [pa.array(runs[:, i]) for i in range(3)], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays([
        pa.array([doc_id for doc_id, _, _ in lot], pa.int64()), pa.array(np.diff(begin)),
        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), one), pa.array(texts, pa.string())],
        names=["doc_id", "n_words", "runs", "text"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  order: Order | None = None) -> DataFrame:
    """(doc_id, n_words, runs, text) per row of ``docs``.

    ``runs`` is an array of (start, length, period) by start, then period; ``text`` has the
    words that no run repeats, joined by one space. ``order`` may say, from the id and the
    number of words, in which order the words are read (places may occur several times).
    """
    fr.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tx.slices(batches):
            yield from map(_found, _together(rows, order))

    docs = fr.documents(docs, id_col, text_col)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, "
             "runs array<struct<start: long, length: long, period: long>>, text string")


def digests(found: DataFrame) -> DataFrame:
    """What :func:`periodic_runs` found as counts, the longest run and two checksums."""
    def sha(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    # Greatest length; of equal ones the smallest start, then period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[f].cast("string") for f in ("start", "length", "period")]), F.lit("\n")))
    out = found.withColumn("_top", longest)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_top.s")).alias("start"),
        F.col("_top.length").alias("length"), (-F.col("_top.q")).alias("period"),
        F.floor(1000 * F.col("_top.length") / -F.col("_top.q")).cast("long").alias(
            "exponent_milli"),
        sha(F.array_join(lines, "")).alias("runs_sha256"), sha(F.col("text")).alias(
            "collapsed_sha256"))
