"""Exact top-k by inner product with a three-phase uniform threshold.

The components of a vector are dealt to ``NODES`` nodes; a score is the sum of the
nodes' local scores. For a block of queries (bounded, sent to all tasks):

1. *Gather.* Every task lists the ``k`` best candidates of each node by local score
   and gives their full scores. The k-th best full score gathered for a query is a
   safe cutoff: the true k-th best is no lower.
2. *Collect.* The cutoff is broadcast. Where no local score of a candidate reaches
   cutoff / NODES, its score can't reach the cutoff, so only candidates with a local
   score from there on are collected.
3. *Resolve.* What is collected is bounded from above with the nodes' best local
   scores, dropped if that stays below the cutoff, and otherwise scored exactly.
   A task passes on its ``k`` best per query; the best of all tasks are the result.

Scores are sums of products of whole numbers, exact in any order as long as they fit a
long. Ties go to the smaller id. Queries run against all rows in blocks; the blocks are the
only loop, and a block's result is written before the next one is read, so the driver holds
the queries of one block, however many there are.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows without an id, take no part. Only vectors of equal length are
compared. A query is not compared with rows of its own id. Repeated candidate rows
each take a rank; a repeated query id is answered once, for its smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knownwhen.sources.shared import new_folder

K = 10
NODES = 2
SCALE = 1024
#: Queries that are sent out at a time.
QUERY_BLOCK = 2048
#: Candidates that a task scores at a time.
ROWS = 2048

_FOUND = "query long, vec_id long, score long"
_RANKED = "query_id long, rank int, vec_id long, score long"


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """(vec_id, v): whole-number vectors of the rows that take part."""
    v = F.col(vector_col)
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & sound)
    return rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK
                 ) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    ids, vectors = [], []
    once = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    for row in once.toLocalIterator():
        ids.append(row["vec_id"])
        vectors.append(np.array(row["v"], np.int64))
        if len(ids) == size:
            yield np.array(ids, np.int64), vectors
            ids, vectors = [], []
    if ids:
        yield np.array(ids, np.int64), vectors


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T: by floating point where that can't round, else by integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(k: int, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


class _Tally:
    """The k best (id, score) of each query in one task."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.ids = [np.empty(0, np.int64)] * queries
        self.scores = [np.empty(0, np.int64)] * queries

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.append(self.ids[q], ids), np.append(self.scores[q], scores)
        keep = _best(self.k, scores, ids)
        self.ids[q], self.scores[q] = ids[keep], scores[keep]

    def batches(self, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        counts = [len(x) for x in self.ids]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names, counts)), pa.array(np.concatenate(self.ids)),
             pa.array(np.concatenate(self.scores))], names=["query", "vec_id", "score"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of candidates of one length each."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            ids = part.column(0).to_numpy()
            lengths = part.column(1).value_lengths().to_numpy()
            flat = part.column(1).flatten().to_numpy()
            starts = np.cumsum(lengths) - lengths
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                yield ids[rows], flat[starts[rows][:, None] + np.arange(n)[None, :]]


def _parts(length: int, nodes: int) -> list[slice]:
    edges = [length * j // nodes for j in range(nodes + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _by_length(vectors: list[np.ndarray]) -> dict[int, np.ndarray]:
    lengths = np.array([len(v) for v in vectors])
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


def gathered(candidates: DataFrame, names: np.ndarray, vectors: list[np.ndarray], k: int,
             nodes: int) -> DataFrame:
    """Phase 1: full scores of the k best of every node's local list, task by task."""
    groups = _by_length(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(len(names), k)
        for ids, x in _chunks(batches):
            if x.shape[1] not in groups:
                continue
            of = groups[x.shape[1]]
            q = np.stack([vectors[i] for i in of])
            local = [_products(q[:, s], x[:, s]) for s in _parts(x.shape[1], nodes)]
            full = sum(local)
            for row, i in enumerate(of):
                other = np.flatnonzero(ids != names[i])
                seen = np.unique(np.concatenate(
                    [other[_best(k, part[row, other], ids[other])] for part in local]))
                tally.add(i, ids[seen], full[row, seen])
        yield from tally.batches(names)

    return candidates.mapInArrow(run, _FOUND)


def resolved(candidates: DataFrame, names: np.ndarray, vectors: list[np.ndarray],
             cutoffs: dict[int, int], k: int, nodes: int) -> DataFrame:
    """Phases 2 and 3: exact scores of all candidates that may reach their query's cutoff."""
    groups = _by_length(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(len(names), k)
        for ids, x in _chunks(batches):
            if x.shape[1] not in groups:
                continue
            of = groups[x.shape[1]]
            q = np.stack([vectors[i] for i in of])
            slices = _parts(x.shape[1], nodes)
            local = [_products(q[:, s], x[:, s]) for s in slices]
            low = np.array([cutoffs.get(int(names[i]), -(1 << 61)) for i in of])
            enough = -(-low // len(slices))  # the uniform threshold, rounded up
            near = np.zeros(local[0].shape, bool)
            for part in local:
                near |= part >= enough[:, None]
            tops = [part.max(axis=1) for part in local]
            for row, i in enumerate(of):
                at = np.flatnonzero(near[row] & (ids != names[i]))
                for j, part in enumerate(local):  # best case: every other node at its best
                    rest = sum(int(t[row]) for n, t in enumerate(tops) if n != j)
                    at = at[part[row, at] + rest >= low[row]]
                score = sum(part[row, at] for part in local)
                keep = score >= low[row]
                tally.add(i, ids[at[keep]], score[keep])
        yield from tally.batches(names)

    return candidates.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id",
          vector_col: str = "embedding", k: int = K, nodes: int = NODES,
          block_size: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows, written and read back.
    ``is_query``: a condition on the vectors' columns."""
    spark = vectors.sparkSession
    rows = scaled(vectors, id_col, vector_col)
    folder = new_folder(spark, "top-k")
    spark.createDataFrame([], _RANKED).write.parquet(folder)
    queries = scaled(vectors.filter(is_query), id_col, vector_col)
    for names, block in query_blocks(queries, block_size):
        first = _ranked(gathered(rows, names, block, k, nodes), k)
        # A row a query; queries with fewer than k candidates have no cutoff.
        cutoffs = {r["query"]: r["score"] for r in first.filter(F.col("rank") == k).collect()}
        best = _ranked(resolved(rows, names, block, cutoffs, k, nodes), k)
        best.select(F.col("query").alias("query_id"), "rank", "vec_id", "score").write.mode(
            "append").parquet(folder)
    return spark.read.schema(_RANKED).parquet(folder)
