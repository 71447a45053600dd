"""Language identification: sparse multinomial logistic regression on character n-grams.

* Features: hashed character n-grams (1 to 3, over the lower-cased text with every
  character that is no letter turned into a space), as TF-IDF of unit length.
* Document frequencies come from *all* training documents, in one distributed pass.
* Weights are trained by follow-the-regularised-leader (FTRL-proximal) with an
  elastic-net penalty, on a bounded sample of the labelled rows: about
  ``PER_LANGUAGE`` documents of every language, fewer of each if there are many
  languages, chosen by a hash, whole texts. No language is left out.
* A part of that sample is held back to fit one temperature, so that the score of
  a prediction is a calibrated probability.

A text is read in pieces of bounded size, never cut off. Defined results: null
texts and texts without a letter are predicted as ``und`` with score 0. Rows whose
label or id is null teach nothing. Without any training row every text is ``und``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx

BITS = 15
ORDERS = (1, 2, 3)
#: Labelled documents of each language in the training sample, about.
PER_LANGUAGE = 400
#: All languages together bring no more than about so many: with many languages each brings
#: fewer, but not less than ``LEAST_ROWS`` different ones (or all that it has).
SAMPLE_LIMIT = 20_000
LEAST_ROWS = 5
#: Every so many-th sample row fits the temperature instead of the weights.
CALIBRATION = 5
#: Documents draw a place below this, by a hash; the first places are taken.
PLACES = 1 << 30
PIECE = 1 << 18
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_MIX = np.uint32(0x9E3779B1)
_STEP = np.uint32(0x01000193)


# ------------------------------------------------------------------ features

def _letters() -> np.ndarray:
    """For each code point of the basic plane, itself or a space if it is no letter."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            out[c] = c
    return out


def ngram_counts(text: str, letters: np.ndarray, bits: int = BITS,
                 orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """How often each hashed n-gram stands in the text."""
    counts = np.zeros(1 << bits, np.int64)
    shift, over = np.uint32(32 - bits), max(orders) - 1
    for at in range(0, len(text), PIECE):
        # The characters before a piece let n-grams run across its edge.
        part = text[max(0, at - over):at + PIECE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(codes < 1 << 16, letters[codes & np.uint32(0xFFFF)], codes)
        held = min(at, over)
        gram = np.zeros(len(codes), np.uint32)
        for n in range(1, max(orders) + 1):
            # gram[i] stands for the n characters from i on.
            gram = (gram[:len(codes) - n + 1] * _STEP) ^ codes[n - 1:]
            if n in orders and len(gram):
                # Those that end before the piece were counted with the piece before.
                new = gram[max(0, held - n + 1):] if held else gram
                ids = ((new + np.uint32(n)) * _MIX) >> shift
                counts += np.bincount(ids, minlength=1 << bits)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: one in five by their id, and rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


# ------------------------------------------------------------------ training

@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # n-grams x languages
    bias: np.ndarray
    temperature: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        vector = counts * self.idf
        norm = math.sqrt(float(vector @ vector))
        return (vector @ self.weights) / norm + self.bias if norm else self.bias

    def predict(self, counts: np.ndarray) -> tuple[str, float]:
        p = softmax(self.logits(counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, classes: int, epochs: int = 6,
         alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3, seed: int = 7
         ) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for softmax regression. Rows: (n-gram numbers, values, class)."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))  # the last row: bias

    def weights(at: np.ndarray) -> np.ndarray:
        zi, ni = z[at], n[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            ids, values, label = rows[k]
            at, x = np.append(ids, size), np.append(values, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[label] -= 1.0
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], w[size]


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search."""

    def loss(log_t: float) -> float:
        x = logits / math.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), labels]).mean())

    low, high, ratio = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def _frequencies(docs: DataFrame, bits: int
                 ) -> tuple[np.ndarray, int, dict[str, tuple[int, list[int]]]]:
    """Of all training documents: in how many each n-gram stands, how many there are, and for
    each language how many it has and the first places that they drew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, seen, total = _letters(), np.zeros(1 << bits, np.int64), 0
        sizes: dict[str, int] = {}
        first: dict[str, list[int]] = {}
        for rows in tx.slices(batches):
            for lang, text, place in zip(rows["lang"], rows["text"], rows["place"]):
                if has_letter(text):
                    seen += ngram_counts(text, letters, bits) > 0
                    total += 1
                    sizes[lang] = sizes.get(lang, 0) + 1
                    first[lang] = sorted({*first.get(lang, ()), place})[:LEAST_ROWS]
        used = np.flatnonzero(seen)
        grams, names = len(used) + 1, list(sizes)
        yield pa.RecordBatch.from_arrays([
            pa.array([*used, -1, *[None] * len(names)], pa.int64()),
            pa.array([*seen[used], total, *sizes.values()], pa.int64()),
            pa.array([None] * grams + names, pa.string()),
            pa.array([None] * grams + [first[x] for x in names], pa.list_(pa.int64()))],
            names=["gram", "n", "lang", "places"])

    rows = docs.select("lang", "text", _place().alias("place")).mapInArrow(
        run, "gram long, n long, lang string, places array<long>").groupBy("gram", "lang").agg(
        F.sum("n").alias("n"), F.slice(F.array_sort(F.array_distinct(F.flatten(
            F.collect_list("places")))), 1, LEAST_ROWS).alias("places")
        ).collect()  # at most 2 ** bits + 1 rows, and one for each language
    df, total, sizes = np.zeros(1 << bits), 0, {}
    for gram, lang, n, places in rows:
        if gram is None:
            sizes[lang] = (n, places)
        elif gram < 0:
            total = n
        else:
            df[gram] = n
    return df, total, sizes


def _place() -> Column:
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(PLACES))


def _sample(docs: DataFrame, sizes: dict[str, tuple[int, list[int]]], per_language: int,
            bits: int) -> list[tuple[str, bytes, bytes]]:
    """(language, n-gram numbers, counts) of a bounded choice of the training documents."""
    if not sizes:
        return []
    each = min(per_language, max(LEAST_ROWS, SAMPLE_LIMIT // len(sizes)))
    share = {lang: math.ceil(PLACES * min(1.0, each / n)) for lang, (n, _) in sizes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, extra = _letters(), set()
        for rows in tx.slices(batches):
            out = []
            for lang, text, place in zip(rows["lang"], rows["text"], rows["place"]):
                if not has_letter(text):
                    continue
                # Past the share only the first places count, each once for all its repeats.
                past = place if place >= share[lang] else None
                if past is None or (lang, past) not in extra:
                    extra.add((lang, past))
                    counts = ngram_counts(text, letters, bits)
                    used = np.flatnonzero(counts).astype(np.int32)
                    out.append((lang, past, used.tobytes(),
                                counts[used].astype(np.int32).tobytes()))
            columns = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    columns, (pa.string(), pa.int64(), pa.binary(), pa.binary()))],
                names=["lang", "past", "grams", "counts"])

    ends = F.create_map(*[F.lit(x) for lang, (_, first) in sizes.items()
                          for x in (lang, max(share[lang], first[-1] + 1))])
    chosen = docs.withColumn("place", _place()).filter(F.col("place") < ends[F.col("lang")])
    rows = chosen.select("lang", "text", "place").mapInArrow(
        run, "lang string, past long, grams binary, counts binary").collect()
    taken = [r for r in rows if r["past"] is None]
    taken += {(r["lang"], r["past"]): r for r in rows if r["past"] is not None}.values()
    return sorted((r["lang"], bytes(r["grams"]), bytes(r["counts"])) for r in taken)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, bits: int = BITS) -> Model | None:
    """A model from all rows of (doc_id, text, lang); None if there is nothing to learn from."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                         & F.col("doc_id").isNotNull())
    df, total, sizes = _frequencies(usable, bits)
    sample = _sample(usable, sizes, per_language, bits)
    if not sample:
        return None
    languages = sorted({lang for lang, _, _ in sample})
    idf = np.log((1 + total) / (1 + df)) + 1.0
    rows = []
    for lang, grams, counts in sample:
        ids = np.frombuffer(grams, np.int32)
        x = np.frombuffer(counts, np.int32) * idf[ids]
        rows.append((ids, x / math.sqrt(float(x @ x)), languages.index(lang)))
    mixed = np.random.default_rng(11).permutation(len(rows))
    kept = [rows[k] for i, k in enumerate(mixed) if i % CALIBRATION or len(rows) < 50]
    back = [rows[k] for i, k in enumerate(mixed) if not i % CALIBRATION] if len(rows) >= 50 else []
    weights, bias = ftrl(kept, 1 << bits, len(languages))
    logits = np.array([x @ weights[ids] + bias for ids, x, _ in back])
    temperature = fitted_temperature(logits, np.array([r[2] for r in back])) if back else 1.0
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32),
                 bias.astype(np.float32), temperature)


# ------------------------------------------------------------------ prediction

def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row; only the text decides."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits weights a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known = _letters(), sent.value
        for rows in tx.slices(batches):
            said = [known.predict(ngram_counts(t, letters)) if known and has_letter(t)
                    else (UNKNOWN, 0.0) for t in rows["text"]]
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["doc_id"], pa.int64()), pa.array([s[0] for s in said], pa.string()),
                pa.array([s[1] for s in said], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    rows = fr.documents(docs, id_col, text_col)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model | None, least_score: float,
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose language is known with at least ``least_score``."""
    fr.bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known = _letters(), sent.value

        def sure(text: str | None) -> bool:
            return known is not None and has_letter(text) and (
                known.predict(ngram_counts(text, letters))[1] >= least_score)

        for batch in batches:
            for at in range(0, batch.num_rows, tx.ROWS):
                part = batch.slice(at, tx.ROWS)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                yield part.filter(pa.array([sure(t) for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learnable(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id")))


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learnt from the rows that are not held out."""
    fr.bounded_batches(docs.sparkSession)
    said = identify(docs, train(learnable(docs)))
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
