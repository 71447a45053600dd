"""Near-duplicates: MinHash bands, sequential Bayesian pruning, exact confirmation.

A document's set holds its distinct shingles of five lower-cased white-space
words (a shorter text is one shingle). Two documents are linked when
``100 * |intersection| >= 75 * |union|``; linked documents form components.

1. One signature per document; documents with equal sets are one *node*, so
   copies cost one row each and are never paired.
2. Nodes that share a band of the signature are candidates. At first the members
   of a bucket of a few bands are paired with its smallest node only, which joins
   large groups of near copies in a number of pairs that grows with their size,
   not with its square. Then, in the buckets of all bands that hold several
   components, one node of each component is paired with one of the largest.
3. A pair's signatures are compared in batches. It is dropped once the posterior
   probability that its similarity reaches the threshold is below
   ``miss``; survivors are confirmed on the full sets.
4. Buckets that still hold several components are compared inside cells of at most
   ``BLOCK`` by ``BLOCK`` nodes: those outside the bucket's largest component with
   all, never within one component. Pairs never leave their cell; its nodes are
   given their sets once and confirmed there. No bucket is capped. The comparisons
   left grow with the square of a bucket only where its nodes are not linked.

Defined results: null and empty texts and texts without words have an empty set
and are linked with nothing. Rows with equal doc_id count as one document. A
null doc_id gives a null component, is kept and is linked with nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx
from knownwhen.sources.shared import scratch, settle

WORDS = 5
PERCENT = 75
HASHES = 128
BAND_ROWS = 4
BATCH = 32
#: Chance, by the posterior, that a dropped pair was a link.
MISS = 1e-7
#: Members of a bucket that one task compares with as many others.
BLOCK = 512
#: Bands of the first round.
FIRST_BANDS = 4
#: Words of 64 bits of the filter that finds the documents of candidate pairs.
FILTER_WORDS = 1 << 18

_PRIME = 0x9E3779B97F4A7C15
_FEATURES = ("doc_id long, n_shingles long, fp_hi long, fp_lo long, sig binary, "
             "bands array<long>")


# ------------------------------------------------------------------ sets and signatures

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    if not text:
        return np.empty(0, np.uint64)
    w = tx.word_hashes(text)
    if not len(w):
        return w
    width = min(words, len(w))
    total = np.full(len(w) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * np.uint64(_PRIME) + w[k:len(w) - width + 1 + k]
    return np.unique(_mixed(total))


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20260101).integers(0, 1 << 63, (2, n), dtype=np.int64)
    draw = draw.astype(np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signatures(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """One row of minima per non-empty set."""
    multiply, add = _coefficients(hashes)
    out = np.empty((len(sets), hashes), np.uint32)
    if not sets:
        return out
    values = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    work = np.empty_like(values)
    for j in range(hashes):
        np.multiply(values, multiply[j], out=work)
        np.add(work, add[j], out=work)
        np.right_shift(work, np.uint64(32), out=work)
        out[:, j] = np.minimum.reduceat(work, starts)
    return out


def band_keys(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """A 64-bit key per band; equal keys of one band stand for equal rows."""
    bands = sig.shape[1] // rows
    parts = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(_PRIME)
    for k in range(rows):
        key = _mixed(key * np.uint64(_PRIME) + parts[:, :, k])
    return key.view(np.int64)


def features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, 128-bit fingerprint of the set, signature, band keys) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tx.slices(batches):
            sets = [shingles(t, words) for t in rows["text"]]
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = signatures([sets[i] for i in full])
            keys = band_keys(sig)
            prints = np.zeros((len(sets), 2), np.int64)
            sigs: list = [None] * len(sets)
            bands: list = [None] * len(sets)
            for k, i in enumerate(full):
                digest = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                prints[i] = np.frombuffer(digest, np.int64)
                sigs[i], bands[i] = sig[k].tobytes(), keys[k]
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["doc_id"], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(sigs, pa.binary()),
                pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "fp_hi", "fp_lo", "sig", "bands"])

    return docs.mapInArrow(run, _FEATURES)


# ------------------------------------------------------------------ verification

def least_matches(percent: int = PERCENT, hashes: int = HASHES, batch: int = BATCH,
                  miss: float = MISS) -> list[tuple[int, int]]:
    """After so many hashes, the fewest matches that keep a pair.

    With a uniform prior the posterior after m of n matches is
    Beta(m + 1, n - m + 1); its mass at or above t is the binomial sum below.
    """
    t, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        mass = 0.0
        for m in range(n + 1):
            mass += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if mass >= miss:
                out.append((n, m))
                break
    return out


def surviving(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]],
              i: np.ndarray | None = None, j: np.ndarray | None = None) -> np.ndarray:
    """Positions of the pairs, rows i of a and j of b, that no batch of the signature drops."""
    i = np.arange(len(a)) if i is None else i
    j = np.arange(len(b)) if j is None else j
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    begin = 0
    for n, least in steps:
        same = (a[i[alive], begin:n] == b[j[alive], begin:n]).sum(axis=1, dtype=np.int32)
        matches = matches + same
        keep = matches >= least
        alive, matches, begin = alive[keep], matches[keep], n
    return alive


def _signature_rows(column: pa.Array, hashes: int = HASHES) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, hashes)


def pruned(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT,
           miss: float = MISS) -> DataFrame:
    """The pairs (a, b) whose signatures leave a chance of a link."""
    steps = least_matches(percent, miss=miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keep = surviving(_signature_rows(part.column(2)),
                                 _signature_rows(part.column(3)), steps)
                yield part.select(["a", "b"]).take(pa.array(keep))

    side = nodes.select("node", "n_shingles", "sig")
    left = side.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"),
                       F.col("sig").alias("sig_a"))
    right = side.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"),
                        F.col("sig").alias("sig_b"))
    close = (F.least("n_a", "n_b") * 100) >= (F.greatest("n_a", "n_b") * percent)
    both = pairs.join(left, "a").join(right, "b").filter(close)
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def sets_of(nodes: DataFrame, docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, members): the full sets of the given nodes, built again from the texts.

    Texts are found by a bitmap of fixed size, broadcast, instead of a shuffle. A few others
    pass it by chance; nothing asks for them.
    """
    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(64 * FILTER_WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tx.slices(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["doc_id"], pa.int64()),
                pa.array([shingles(t, words).tobytes() for t in rows["text"]], pa.binary())],
                names=["node", "members"])

    bits = nodes.select(place("node").alias("place")).groupBy(
        F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("bits"))
    found = docs.withColumn("place", place("doc_id")).withColumn(
        "word", F.shiftright("place", 6)).join(F.broadcast(bits), "word").filter(
        F.expr("(shiftright(bits, int(place & 63)) & 1L) = 1L"))
    return fr.stored(found.select("doc_id", "text").mapInArrow(run, "node long, members binary"),
                     "near-sets")


def _linked(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the other sets are linked with the first."""
    sizes = np.array([len(x) for x in others])
    joined = np.concatenate(others)
    at = np.searchsorted(one, joined)
    at[at == len(one)] = 0
    both = np.add.reduceat((one[at] == joined).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= percent * (len(one) + sizes - both)


def confirmed(pairs: DataFrame, docs: DataFrame, words: int = WORDS, percent: int = PERCENT
              ) -> DataFrame:
    """The pairs (a, b) that are links by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tx.slices(batches):
            keep = [bool(_linked(np.frombuffer(x, np.uint64), [np.frombuffer(y, np.uint64)],
                                 percent)[0]) for x, y in zip(rows["set_a"], rows["set_b"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(rows[n], keep) if k], pa.int64()) for n in ("a", "b")],
                names=["a", "b"])

    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), docs, words)
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("set_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("members").alias("set_b")), "b"))
    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _stars(bands: DataFrame) -> DataFrame:
    """Each node with the smallest node of each of its buckets."""
    firsts = bands.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last"))
    firsts = firsts.filter("a < last").select("key", "a")
    return bands.join(firsts, "key").filter("node > a").select(
        "a", F.col("node").alias("b")).distinct()


def _placed(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, component) for every band of every node."""
    rows = nodes.select("node", "bands").join(labels, "node", "left")
    return rows.select(F.posexplode("bands").alias("band", "key"), "node",
                       F.coalesce("component", "node").alias("component"))


def _parts(placed: DataFrame) -> DataFrame:
    """For each component of a bucket: how many nodes it has there, and one of them."""
    return placed.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("rep"))


def _mixed_buckets(parts: DataFrame) -> DataFrame:
    """Buckets with several components: their nodes, and the largest component."""
    return parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("components"), F.sum("n").alias("n"),
        F.max(F.struct("n", "component", "rep")).alias("top")).filter("components > 1")


def _between_components(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """In every bucket, one node of the largest component with one of each other."""
    parts = _parts(_placed(nodes, labels))
    tops = _mixed_buckets(parts).select("key", F.col("top.rep").alias("top"))
    both = parts.select("key", "rep").join(tops, "key").filter("rep <> top")
    return both.select(F.least("rep", "top").alias("a"), F.greatest("rep", "top").alias("b")
                       ).distinct()


def _cells(nodes: DataFrame, labels: DataFrame, block: int = BLOCK) -> DataFrame:
    """(cell, node, component, role, band, n_shingles, sig): what has to be compared together.

    A small bucket is one cell. In larger ones every part of the nodes outside the largest
    component meets every part of all nodes. Roles: 1 one of all, 2 one of the others, 3 both.
    """
    placed = _placed(nodes, labels)
    mixed = _mixed_buckets(_parts(placed)).select(
        "key", F.col("top.component").alias("major"),
        F.ceil(F.col("n") / block).cast("int").alias("all_parts"),
        F.ceil((F.col("n") - F.col("top.n")) / block).cast("int").alias("other_parts"))
    rows = placed.join(mixed, "key")
    spot = F.xxhash64("node")
    other = F.pmod(spot, F.col("other_parts")).cast("int")
    any_part = F.pmod(spot, F.col("all_parts")).cast("int")

    def cell(i, j, role: int):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(role).alias("role"))

    zero = F.lit(0)
    as_any = F.transform(F.sequence(zero, F.col("other_parts") - 1),
                         lambda i: cell(i, any_part, 1))
    as_other = F.transform(F.sequence(zero, F.col("all_parts") - 1), lambda j: cell(other, j, 2))
    cells = F.when(F.col("all_parts") == 1, F.array(cell(zero, zero, 3))).when(
        F.col("component") == F.col("major"), as_any).otherwise(F.concat(as_any, as_other))
    rows = rows.select("key", "band", "node", "component", F.explode(cells).alias("cell"))
    rows = rows.select(F.xxhash64("key", "cell.i", "cell.j").alias("cell"), "node", "component",
                       F.col("cell.role").alias("role"), "band")
    return rows.join(nodes.select("node", "n_shingles", "sig"), "node")


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by cell, as tables of whole cells."""
    held: pa.Table | None = None  # the cell that may go on in the next batch
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        cell = rows["cell"].to_numpy()
        differs = np.flatnonzero(cell != cell[-1])
        last = int(differs[-1]) + 1 if len(differs) else 0
        if last:
            yield rows.slice(0, last)
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield held


def _ranges(cell: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(cell)) + 1
    return zip([0, *cuts], [*cuts, len(cell)])


def _links_in_cells(cells: DataFrame, docs: DataFrame, words: int = WORDS,
                    percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """Links (a, b) between different components inside the cells.

    Pairs never leave their cell: what goes on are its nodes, once each, with the partners
    whose signatures leave a chance of a link; they meet again with their full sets.
    """
    steps = least_matches(percent, miss=miss)
    candidates = "cell long, node long, partners array<long>"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_cell(batches):
            node, comp = rows["node"].to_numpy(), rows["component"].to_numpy()
            size, role = rows["n_shingles"].to_numpy(), rows["role"].to_numpy()
            sig, cell, band = _signature_rows(rows["sig"]), rows["cell"].to_numpy(), rows["band"]
            out_cell, out_node, out_partners = [], [], []
            for begin, end in _ranges(cell):
                others = np.flatnonzero(role[begin:end] & 2) + begin
                every = np.flatnonzero(role[begin:end] & 1) + begin
                i, j = np.repeat(others, len(every)), np.tile(every, len(others))
                want = (comp[i] != comp[j]) & ((role[i] != 3) | (node[i] < node[j]))
                want &= (np.minimum(size[i], size[j]) * 100
                         >= np.maximum(size[i], size[j]) * percent)
                i, j = i[want], j[want]
                keep = surviving(sig, sig, steps, i, j)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                # A pair is looked at in the first band that it shares only.
                same = (sig[i] == sig[j]).reshape(len(i), -1, BAND_ROWS).all(axis=2)
                first = same.argmax(axis=1) == band[begin].as_py()
                i, j = i[first], j[first]
                for k in np.unique(np.concatenate([i, j])):
                    out_cell.append(cell[begin])
                    out_node.append(node[k])
                    out_partners.append(node[j[i == k]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_cell, pa.int64()), pa.array(out_node, pa.int64()),
                 pa.array(out_partners, pa.list_(pa.int64()))], names=["cell", "node", "partners"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_cell(batches):
            cell, node = rows["cell"].to_numpy(), rows["node"].to_numpy()
            found_a, found_b = [], []
            for begin, end in _ranges(cell):
                part = rows.slice(begin, end - begin)
                full: dict[int, list[np.ndarray]] = {}  # rows that share an id have several sets
                for n, data in zip(node[begin:end].tolist(), part["members"].to_pylist()):
                    full.setdefault(n, []).append(np.frombuffer(data, np.uint64))
                done = set()
                for n, partners in zip(node[begin:end].tolist(), part["partners"].to_pylist()):
                    if not partners or n in done:
                        continue
                    done.add(n)
                    names = [m for m in partners for _ in full[m]]
                    others = [x for m in partners for x in full[m]]
                    for one in full[n]:
                        for m in np.array(names)[_linked(one, others, percent)].tolist():
                            found_a.append(min(n, m))
                            found_b.append(max(n, m))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    compared = cells.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(
        compare, candidates)
    compared = fr.stored(compared, "near-cells", few=True)
    sets = sets_of(compared.select("node"), docs, words)
    whole = compared.join(sets, "node").repartition("cell").sortWithinPartitions("cell", "node")
    return whole.mapInArrow(verify, "a long, b long").distinct()


# ------------------------------------------------------------------ components

#: Rows of a file of labels.
LABELS = 1_000_000


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over undirected (a, b) edges.

    In each round a node takes the smallest of its own label, its neighbours' labels and
    its label's label, and hands its neighbours' smallest on to the node that labels it, so
    whole trees hang on to smaller ones: a path of 1,000 nodes takes about a dozen rounds in
    any order, one of 100,000 about 30. Every round is written to the shared folder; only
    one number per round reaches the driver.
    """
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(
        edges.select("b", "a")).distinct()
    both = settle(both, f"{label}-edges")
    files = 1 + both.count() // LABELS
    now = settle(both.groupBy("x").agg(F.min("y").alias("near")).select(
        F.col("x").alias("node"), F.least("x", "near").alias("component")).coalesce(files), label)
    unknown = F.lit(None).cast("long")
    while True:
        seen = now.select(F.col("node").alias("y"), F.col("component").alias("other"))
        near = both.join(seen, "y").groupBy("x").agg(F.min("other").alias("near"))
        both_ends = F.explode(F.array(
            F.struct("node", F.col("component").alias("before"), F.least("component", "near").alias("to")),
            F.struct(F.col("component").alias("node"), unknown.alias("before"), F.col("near").alias("to"))))
        offers = now.join(near, now["node"] == near["x"]).select(both_ends.alias("o")).select("o.*")
        up = now.select(F.col("node").alias("component"), F.col("component").alias("to"))
        jumps = now.filter("node <> component").join(up, "component").select(
            "node", unknown.alias("before"), "to")
        after = offers.union(jumps).groupBy("node").agg(
            F.max("before").alias("before"), F.min("to").alias("component"))
        after = settle(after.coalesce(files), label)
        changed = after.filter("before <> component").limit(1).count()
        now = after.select("node", "component")
        if not changed:
            return now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``, written and read back."""
    fr.bounded_batches(docs.sparkSession)
    docs = fr.documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    with scratch(docs.sparkSession):
        return fr.stored(_grouped(docs, words, percent, miss), "near-duplicates", outlive=True)


def _grouped(docs: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    rows = settle(features(docs, words), "near-features")
    usable = rows.filter("n_shingles > 0 and doc_id is not null")
    groups = usable.groupBy("fp_hi", "fp_lo").agg(F.min("doc_id").alias("node"))
    # Rows that repeat a doc_id give one node row per set.
    nodes = usable.select("fp_hi", "fp_lo", F.col("doc_id").alias("node"), "n_shingles", "sig",
                          "bands").join(groups, ["fp_hi", "fp_lo", "node"], "left_semi")
    nodes = fr.stored(nodes.dropDuplicates(["fp_hi", "fp_lo", "node"]), "near-nodes")

    def links(pairs: DataFrame) -> DataFrame:
        tried = fr.stored(pairs, "near-pairs", few=True)
        return fr.stored(confirmed(tried, docs, words, percent), "near-links", few=True)

    # Rows that share a doc_id are one document: tie their sets' nodes together.
    of = usable.select("doc_id", "fp_hi", "fp_lo").join(groups, ["fp_hi", "fp_lo"]).select(
        "doc_id", "node")
    ends = of.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("last"))
    ends = ends.filter("a < last").select("doc_id", "a")
    same = of.join(ends, "doc_id").filter("node <> a").select("a", F.col("node").alias("b"))
    few = nodes.select("node", F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("key"))
    edges = links(pruned(_stars(few), nodes, percent, miss)).union(
        fr.stored(same, "near-links", few=True))
    labels = components(edges)
    edges = edges.union(links(pruned(_between_components(nodes, labels), nodes, percent, miss)))
    labels = components(edges)
    more = fr.stored(_links_in_cells(_cells(nodes, labels), docs, words, percent, miss),
                     "near-links", few=True)
    if not more.isEmpty():
        labels = components(edges.union(more))

    out = rows.select("doc_id", "n_shingles", "fp_hi", "fp_lo").join(
        groups, ["fp_hi", "fp_lo"], "left").join(labels, "node", "left")
    known = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(known, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(
        F.col("doc_id") == F.col("component_id"), F.lit(True)))
