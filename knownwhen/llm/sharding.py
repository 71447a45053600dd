"""Sharding by vector bin packing: bytes, words and rows are balanced together.

Groups of equal texts are placed as a whole. What is packed is a list of *items*
whose length has a fixed bound, whatever the corpus:

* only a group above a shard's capacity in some measure is cut, by a hash of its
  documents' ids, into ``PARTS`` parts a shard (few such groups can exist, and none of
  them could stay together);
* a group above ``1 / FINE`` of a shard is an item of its own (there are at most
  3 * shards * FINE of them, since each measure can be used up only once);
* all smaller groups are dealt by hash into ``PIECES`` items.

Items are placed from the largest on, each on the shard where the dot product of
its measures with what is left of the shard's capacity is highest. Only sums of
items reach the driver; documents learn their shard from a broadcast of the
placed items. Nothing is shuffled by group except partial sums.

The law that holds is ``bytes``: shards have nearly equal sizes. Defined results:
a null text has size 1 like an empty one and is in the same group. Repeated rows
are placed like any equal texts and have slots of their own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.llm.mixing import _bits, n_words, running
from knownwhen.sources.shared import settle

SHARDS = 16
SPLIT = 1.0
FINE = 256
PIECES = 4096
#: Parts that a group of one shard's capacity is cut into.
PARTS = 16
#: How much bytes, words and rows count when an item looks for its shard: bytes are the law,
#: and a group that fills a shard by rows must not leave it short of bytes.
IMPORTANCE = (1.0, 0.05, 0.05)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        n_words(text).alias("words"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("copies"))


def placed(items: np.ndarray, capacity: np.ndarray, shards: int = SHARDS,
           importance: tuple[float, ...] = IMPORTANCE) -> np.ndarray:
    """The shard of each item (rows: its measures), placed in the order of their largest share."""
    share = items / np.maximum(capacity, 1)
    left = np.ones((shards, items.shape[1]))
    out = np.empty(len(items), np.int64)
    weight = np.asarray(importance)
    for k in np.argsort(-share.max(axis=1), kind="stable"):
        best = int(np.argmax(left @ (share[k] * weight)))
        left[best] -= share[k]
        out[k] = best
    return out


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``."""
    spark = docs.sparkSession
    rows = settle(measured(docs, id_col, text_col), "shard-rows")
    sums = [F.sum("size"), F.sum("words"), F.count(F.lit(1))]
    total = rows.agg(*sums).first()
    capacity = np.array([float(x or 0) / shards for x in total])
    groups = rows.groupBy("copies").agg(*[s.alias(n) for s, n in zip(sums, ("b", "w", "r"))])
    load = F.greatest(*[F.col(n) / F.lit(max(float(c), 1.0)) for n, c in zip("bwr", capacity)])
    parts = F.when(load > SPLIT, F.ceil(load * PARTS)).otherwise(F.lit(1)).cast("int")
    groups = groups.withColumn("load", load)
    large = settle(groups.filter(F.col("load") > 1.0 / FINE).select(
        "copies", parts.alias("parts")), "shard-groups")

    of = rows.join(F.broadcast(large), "copies", "left")  # at most 3 * shards * FINE rows
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    small = F.pmod(F.xxhash64("copies"), F.lit(PIECES))
    of = of.withColumn("item", F.when(
        F.col("parts").isNotNull(), F.concat_ws(":", "copies", part)).otherwise(
        small.cast("string")))
    items = of.groupBy("item").agg(*[s.alias(n) for s, n in zip(sums, ("b", "w", "r"))])
    known = items.orderBy("item").collect()  # bounded, see above
    where = placed(np.array([[r["b"], r["w"], r["r"]] for r in known], float).reshape(-1, 3),
                   capacity, shards)
    table = spark.createDataFrame([(r["item"], int(s)) for r, s in zip(known, where)],
                                  "item string, shard int")
    of = of.join(F.broadcast(table), "item")
    pieces = 1 << _bits(max(1, total[2] // shards))
    of = of.withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.lit(pieces)))
    out = running(of, "shard", "piece", ["doc_id", "text_crc32"], F.lit(1), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
