"""Small helpers that run inside Python workers: batches of rows, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Rows that are turned into Python objects at a time.
ROWS = 256
#: Bytes of one text that are split into words at a time.
SLICE = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[dict[str, list]]:
    """Columns of at most ``rows`` rows as Python lists."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}


def pieces(data: bytes, size: int = SLICE) -> Iterator[bytes]:
    """Parts of ``data`` that end at white space (or wherever none is near)."""
    at, end = 0, len(data)
    while end - at > size:
        cut = max(data.rfind(b" ", at, at + size), data.rfind(b"\n", at, at + size))
        if cut <= at:  # one very long word
            nexts = [x for x in (data.find(b" ", at + size), data.find(b"\n", at + size)) if x >= 0]
            cut = min(nexts, default=end)
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the white-space words of ``text``, A-Z lower-cased, in order."""
    out = []
    for part in pieces(text.encode("utf-8", "surrogatepass").lower()):
        words = part.split()
        out.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    return out[0] if len(out) == 1 else np.concatenate(out)
