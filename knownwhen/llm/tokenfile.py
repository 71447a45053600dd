"""Token ids in patched frame-of-reference blocks.

The file format is a table, one row per block of token ids, in the order of the
documents' ids; parts of the table are *shards* (the tasks that wrote them).

=================  =========================================================
shard, block       where the block stands; blocks count from 0 in their shard
first, n           place of its first id in the shard, and how many ids it has
base, width        the smallest id, and the bits of a packed difference to it
packed             the differences, ``width`` bits each, most significant bit first
exc_at, exc_value  places (uint32) and differences (uint32) that need more bits
docs               the documents that start here: doc_id, start in the shard, n
chain              start of the long document that the block is a part of, or null
=================  =========================================================

``width`` is the cheapest of the bit widths that cover a fixed percentile of the
block; ids beyond it are exceptions. A block ends with a document once it has
``BLOCK`` ids; only a document that is longer than that by itself spans blocks,
which then hold nothing else, so no block grows with a document.

Texts are encoded by the tokenizers library. Since its pre-tokens never reach
over blanks, a text's ids are those of its pieces, one after the other; pieces met
before are looked up, and only new ones are encoded.

Defined results: null and empty texts have the end id alone. A null doc_id comes
first in order. Repeated rows are encoded each time.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx
from knownwhen.sources.shared import settle

BLOCK = 8192
END = 1
PERCENTILES = (90, 95, 99, 100)
#: Pieces of text whose ids a Python worker remembers at least, and twice as many at most.
MEMORY = 400_000

_SCHEMA = ("shard int, block int, first long, n int, base int, width int, packed binary, "
           "exc_at binary, exc_value binary, "
           "docs array<struct<doc_id:long,start:long,n:int>>, chain long")
#: Blanks at which a text may be cut. Rarer white space stays inside a word.
_BLANK = re.compile(r"[ \t\r\n]+")
#: Bytes of Latin-1 text that are cut into pre-tokens at a time.
PART = 1 << 20
#: Fixed value: the rule by which the tokenizer file cuts pre-tokens, as its JSON has it.
PRE_TOKENS = json.dumps("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")


# ------------------------------------------------------------------ tokenizing

class WordIds:
    """Ids of texts; remembers the pieces of earlier texts.

    Texts of Latin-1 characters are cut into the tokenizer's own pre-tokens here: such
    characters are in normal form already, and their lower case depends on nothing else.
    They are cut many at a time, and a pre-token is looked up once for all its places. Other
    texts, and those that name special tokens, are cut at blanks only. Both follow from the
    tokenizer's rule for pre-tokens, so a file with another rule is refused.
    """

    def __init__(self, path: str, memory: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())["pre_tokenizer"]
        if PRE_TOKENS not in json.dumps(rules):
            raise ValueError(f"{path} cuts its pre-tokens by another rule than {PRE_TOKENS}")
        # The last token of every pre-token, and no other, has this mark.
        self.ends = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.memory = memory
        self.new: dict[int | bytes | str, bytes] = {}
        self.old: dict[int | bytes | str, bytes] = {}  # met before the last ``memory`` new pieces
        self.kind, self.lower = _latin_tables()
        self.mask = (np.uint64(1) << (np.uint64(8) * np.arange(8, dtype=np.uint64))) - np.uint64(1)

    def _encode(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(
            parts, add_special_tokens=False)]

    def _encode_tokens(self, parts: list[str]) -> list[bytes]:
        """Pre-tokens are encoded together and told apart by their last tokens."""
        ids = np.array(self.tokenizer.encode_batch_fast(
            [" ".join(parts)], add_special_tokens=False)[0].ids, np.uint32)
        stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(stops) != len(parts):
            return self._encode(parts)
        data, begin, out = ids.tobytes(), 0, []
        for stop in stops.tolist():
            out.append(data[begin:stop])
            begin = stop
        return out

    def _known(self, keys: list, part_of, encode) -> list[bytes]:
        """The ids of pieces by their keys; ``part_of`` gives the text of an unknown one."""
        got = [self.new.get(k) for k in keys]
        unknown: dict = {}
        for i, ids in enumerate(got):
            if ids is None:
                got[i] = self.old.get(keys[i])
                if got[i] is None:
                    unknown.setdefault(keys[i], i)
                else:
                    self.new[keys[i]] = got[i]
        fresh = list(unknown.values())
        for at in range(0, len(fresh), 4096):
            some = fresh[at:at + 4096]
            for i, ids in zip(some, encode([part_of(i) for i in some])):
                self.new[keys[i]] = ids
        return [self.new[k] if ids is None else ids for k, ids in zip(keys, got)] if fresh else got

    def _of_part(self, data: bytes, cuts: np.ndarray) -> list[np.ndarray]:
        """Ids of Latin-1 bytes, split where texts end at ``cuts``."""
        text = self.lower[np.frombuffer(data, np.uint8)]
        begin, end = _pre_tokens(text, self.kind)
        plain, size = text.tobytes(), end - begin
        # A token of up to seven bytes is told apart by these and their number, a longer one by
        # itself, so different tokens never share a key.
        short = size < 8
        padded = np.concatenate((text, np.zeros(8, np.uint8)))
        windows = np.lib.stride_tricks.sliding_window_view(padded, 8)[begin[short]]
        codes = np.ascontiguousarray(windows).view(np.uint64)[:, 0]
        codes = (codes & self.mask[size[short]]) | (size[short].astype(np.uint64) << np.uint64(56))
        codes, first, of = np.unique(codes, return_index=True, return_inverse=True)
        at = np.flatnonzero(short)[first].tolist()
        known: dict[bytes, int] = {}
        words = [known.setdefault(plain[b:e], len(known)) for b, e in zip(
            begin[~short].tolist(), end[~short].tolist())]
        places = np.empty(len(begin), np.int64)
        places[short], places[~short] = of, np.array(words, np.int64) + len(codes)
        keys: list[int | bytes] = [*codes.tolist(), *known]

        def part_of(k: int) -> str:
            key = keys[k]
            word = key if isinstance(key, bytes) else plain[begin[at[k]]:end[at[k]]]
            return word.decode("latin-1")

        got = self._known(keys, part_of, self._encode_tokens)
        sizes = np.fromiter(map(len, got), np.int64, len(got)) >> 2
        ids = np.frombuffer(b"".join(got), np.uint32)
        long = sizes[places]
        stops = np.concatenate([[0], np.cumsum(long)])
        shift = np.repeat((np.cumsum(sizes) - sizes)[places] - stops[:-1], long)
        out = ids[shift + np.arange(int(stops[-1]))]
        return np.split(out, stops[np.searchsorted(begin, cuts)][:-1])

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.new) > self.memory:
            self.old, self.new = self.new, {}
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            if held:
                cuts = np.cumsum([len(d) + 1 for _, d in held])
                parts = self._of_part(b"\n".join(d for _, d in held), cuts)
                for (k, _), ids in zip(held, parts):
                    out[k].append(ids)
                held.clear()

        for k, text in enumerate(texts):
            if not text:
                continue
            if not _is_latin(text):
                words = [w for w in _BLANK.split(text) if w]
                out[k].append(np.frombuffer(b"".join(self._known(
                    words, words.__getitem__, self._encode)), np.uint32))
                continue
            for part in tx.pieces(text.encode("latin-1"), PART // 2):
                if len(part) >= PART:  # one endless word
                    if held and held[-1][0] == k:
                        flush()
                        size = 0
                    out[k].append(np.frombuffer(self._encode([part.decode("latin-1")])[0],
                                                np.uint32))
                    continue
                if size + len(part) + 1 > PART:
                    flush()
                    size = 0
                held.append((k, part))
                size += len(part) + 1
        flush()
        nothing = np.empty(0, np.uint32)
        return [np.concatenate([nothing, *parts]) for parts in out]


def _latin_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every Latin-1 character: 0 white space, 1 letter, 2 number, 3 other; its lower case."""
    kind, lower = np.full(256, 3, np.uint8), np.arange(256, dtype=np.uint8)
    for c in range(256):
        if chr(c) in "\t\n\v\f\r \x85\xa0":
            kind[c] = 0
        elif chr(c).isalpha():
            kind[c] = 1
        elif chr(c).isnumeric():
            kind[c] = 2
        if chr(c).isupper():
            lower[c] = ord(chr(c).lower())
    return kind, lower


def _pre_tokens(text: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the pre-tokens: runs of letters, single numbers, runs of others, and
    an apostrophe with one of the endings s, t, m, d, re, ve, ll."""
    kind = kinds[text]
    edge = np.ones(len(text) + 1, bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begin = np.flatnonzero(edge[:-1] & (kind != 0))
    end = np.flatnonzero(edge[1:] & (kind != 0)) + 1
    mark = np.flatnonzero((text[begin] == ord("'")) & (end - begin == 1))
    mark = mark[mark + 1 < len(begin)]
    mark = mark[(begin[mark + 1] == end[mark]) & (kind[begin[mark + 1]] == 1)]
    if len(mark):
        at = begin[mark + 1]
        one, two = text[at], text[np.minimum(at + 1, len(text) - 1)]
        pair = (end[mark + 1] - at >= 2) & (
            (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")))
            | ((one == ord("l")) & (two == ord("l"))))
        taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(pair, 2, 0))
        end[mark] += taken
        begin[mark + 1] += taken
        left = begin < end
        begin, end = begin[left], end[left]
    return begin, end


def _is_latin(text: str) -> bool:
    if "<|" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _word_ids(path: str, memory: int) -> WordIds:
    """One per Python worker, kept from task to task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_known_word_ids", {})
    if (path, memory) not in kept:
        kept.clear()
        kept[path, memory] = WordIds(path, memory)
    return kept[path, memory]


# ------------------------------------------------------------------ blocks

def packed(ids: np.ndarray) -> dict:
    """One block: base, width, packed differences and exceptions."""
    base = int(ids.min())
    rest = (ids - np.uint32(base)).astype(np.uint32)
    ordered = np.sort(rest)
    best = None
    for percent in PERCENTILES:
        top = int(ordered[min(len(ordered) - 1, (len(ordered) * percent) // 100)])
        width = max(1, top.bit_length())
        out = len(ordered) - int(np.searchsorted(ordered, 1 << width)) if width < 32 else 0
        cost = len(ordered) * width + out * 64
        if best is None or cost < best[0]:
            best = (cost, width)
    width = best[1]
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    low = rest & np.uint32((1 << width) - 1)
    bits = np.unpackbits(low.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width:]
    return {"base": base, "width": width, "packed": np.packbits(bits.ravel()).tobytes(),
            "exc_at": over.astype(np.uint32).tobytes(), "exc_value": rest[over].tobytes()}


def unpacked(n: int, base: int, width: int, data: bytes, exc_at: bytes, exc_value: bytes
             ) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, 32 - width:] = bits
    rest = np.packbits(full, axis=1).view(">u4").ravel().astype(np.uint32)
    rest[np.frombuffer(exc_at, np.uint32)] = np.frombuffer(exc_value, np.uint32)
    return rest + np.uint32(base)


class _Shard:
    """Gathers documents and gives out finished blocks."""

    def __init__(self, number: int, block: int):
        self.number, self.size = number, block
        self.blocks, self.total = 0, 0
        self.held: list[np.ndarray] = []
        self.docs: list[dict] = []
        self.first = 0

    def _row(self, ids: np.ndarray, first: int, docs: list[dict], chain: int | None) -> dict:
        self.blocks += 1
        return {"shard": self.number, "block": self.blocks - 1, "first": first, "n": len(ids),
                **packed(ids), "docs": docs, "chain": chain}

    def close(self) -> Iterator[dict]:
        if self.docs:
            yield self._row(np.concatenate(self.held), self.first, self.docs, None)
        self.held, self.docs, self.first = [], [], self.total

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        doc = {"doc_id": doc_id, "start": self.total, "n": len(ids)}
        if len(ids) > self.size:
            yield from self.close()
            for at in range(0, len(ids), self.size):
                yield self._row(ids[at:at + self.size], self.total + at, [] if at else [doc],
                                self.total)
            self.total += len(ids)
            self.first = self.total
            return
        self.held.append(ids)
        self.docs.append(doc)
        self.total += len(ids)
        if self.total - self.first >= self.size:
            yield from self.close()


def encoded(docs: DataFrame, tokenizer: str, end: int = END, block: int = BLOCK,
            memory: int = MEMORY) -> DataFrame:
    """The blocks of all documents (doc_id, text), ranges of doc_id by ranges of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, shard = _word_ids(tokenizer, memory), _Shard(TaskContext.get().partitionId(), block)
        tail = np.array([end], np.uint32)

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=_arrow())

        out: list[dict] = []
        for rows in tx.slices(batches, 512):
            for doc_id, found in zip(rows["doc_id"], ids.of(rows["text"])):
                out.extend(shard.add(doc_id, np.concatenate([found, tail])))
            if len(out) >= 64:
                yield batch(out)
                out = []
        out.extend(shard.close())
        if out:
            yield batch(out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, _SCHEMA)


def _arrow() -> pa.Schema:
    return pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int32()),
        ("base", pa.int32()), ("width", pa.int32()), ("packed", pa.binary()),
        ("exc_at", pa.binary()), ("exc_value", pa.binary()),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()),
                                     ("n", pa.int32())]))),
        ("chain", pa.int64())])


# ------------------------------------------------------------------ reading

_CODE = ["n", "base", "width", "packed", "exc_at", "exc_value"]


def _shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, before): ids in the shards before it. One row per shard, of its last block."""
    sizes = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    return sizes.select("shard", F.coalesce(before, F.lit(0)).alias("before"))


def documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the blocks."""
    schema = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 5
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tx.slices(batches, 64):
            out = []
            for i, docs in enumerate(rows["docs"]):
                data = unpacked(*(rows[c][i] for c in _CODE)).astype("<u4").tobytes()
                for doc in docs:
                    at = (doc["start"] - rows["first"][i]) * 4
                    out.append((rows["shard"][i], doc["doc_id"], doc["start"], doc["n"],
                                zlib.crc32(data[at:at + doc["n"] * 4])))
            yield batch(out)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, crc, key = None, 0, None  # of one long document; its blocks come in order
        for rows in tx.slices(batches, 64):
            out = []
            for i, docs in enumerate(rows["docs"]):
                if (rows["shard"][i], rows["chain"][i]) != key:
                    if held:
                        out.append((*held, crc))
                    key, crc = (rows["shard"][i], rows["chain"][i]), 0
                if docs:
                    held = (rows["shard"][i], docs[0]["doc_id"], docs[0]["start"], docs[0]["n"])
                data = unpacked(*(rows[c][i] for c in _CODE)).astype("<u4").tobytes()
                crc = zlib.crc32(data, crc)
            yield batch(out)
        if held:
            yield batch([(*held, crc)])

    single = blocks.filter("chain is null").mapInArrow(whole, schema)
    parts = blocks.filter("chain is not null").repartition("shard", "chain").sortWithinPartitions(
        "shard", "chain", "block")
    found = single.union(parts.mapInArrow(chained, schema))
    starts = F.broadcast(_shard_starts(blocks))  # two numbers for each task that wrote
    return found.join(starts, "shard").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def written(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
            end: int = END, block: int = BLOCK, memory: int = MEMORY) -> DataFrame:
    """Write the blocks to the shared folder; returns them as read from there."""
    fr.bounded_batches(docs.sparkSession)
    return settle(encoded(fr.documents(docs, id_col, text_col), tokenizer, end, block,
                          memory), "tokens")
