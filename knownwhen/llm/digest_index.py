"""Exact dedup against a persistent index of digests.

The index is a table of the shared folder, bucketed and sorted by digest. A portion of new
rows is folded to one entry per digest (before and after its shuffle), and a sort-merge
anti-join finds the digests that the index lacks: both sides are bucketed alike, so the
index is neither shuffled nor sorted again. New digests are appended as their first entry,
known ones as a further entry of the same bucket, so the index is append-only and what it
says of a digest is an aggregate over neighbouring rows without a shuffle.

Texts are equal when they are identical without white space (``[\\x20\\x09-\\x0D]``). Of equal
texts the row with the most code points in the original text stays, then the smallest id,
null last, then the row that was read first. Who stays and how many there are doesn't depend
on how rows were dealt into portions.

A digest that holds more than 1 / ``FINE`` of all rows is hot. There are at most ``FINE`` of
those, which are broadcast, so no group of copies meets in one task; all others find their
entry by a sort-merge join with the index.

Defined results: a null text counts as empty. Rows that share id and text are copies of each
other and one of them stays. Null ids stay null. Other columns are ignored. An empty table
gives no rows and leaves the index as it was. A portion whose number the index already has
is not taken again, so a repeated job changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.sources.shared import new_folder, settle

#: White space that doesn't count.
BLANKS = ("\x20", "\x09", "\x0a", "\x0b", "\x0c", "\x0d")
#: A digest above 1 / FINE of the rows is hot; at most this many can be.
FINE = 512
#: Rows of a bucket, about, when the number of buckets is derived from the rows.
BUCKET_ROWS = 1 << 21
LEAST_BUCKETS = 32
#: Portions in which the query hands its rows to a new index.
PORTIONS = 2

_COLUMNS = ("digest binary, copies bigint, best struct<short: bigint, none: boolean, "
            "doc_id: bigint, portion: int, row: bigint>, portion int")


def normalised(text: Column) -> Column:
    """``text`` without white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_chars, digest) per row, stored, so that row numbers hold from now on."""
    text = F.col(text_col)
    return settle(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"),
        F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest")), "digests")


def buckets_for(rows: int) -> int:
    """Buckets of an index that is to hold about ``rows`` digests."""
    return max(LEAST_BUCKETS, 1 << max(0, (rows // BUCKET_ROWS)).bit_length())


@dataclass(frozen=True)
class DigestIndex:
    """The index in ``path``. A catalog entry is made for it when it is opened."""

    spark: SparkSession
    path: str
    buckets: int

    @classmethod
    def new(cls, spark: SparkSession, rows: int) -> DigestIndex:
        return cls(spark, new_folder(spark, "digest-index"), buckets_for(rows)).opened()

    @property
    def name(self) -> str:
        return "digest_index_" + self.path.rstrip("/").rsplit("-", 1)[-1]

    def opened(self) -> DigestIndex:
        """Registers the index with this session's catalog, unless it knows it."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")
        return self

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def has(self, portion: int) -> bool:
        return not self.entries().filter(F.col("portion") == portion).isEmpty()

    def take(self, rows: DataFrame, portion: int) -> DataFrame:
        """Append the digests of ``rows`` (from :func:`digested`); returns the new ones among
        them, (digest, copies, best): what an incremental run keeps."""
        if not self.has(portion):
            order = F.struct(
                (-F.col("n_chars")).alias("short"), F.col("doc_id").isNull().alias("none"),
                "doc_id", F.lit(portion).alias("portion"), "row")
            folded = rows.groupBy("digest").agg(
                F.count(F.lit(1)).alias("copies"), F.min(order).alias("best"))
            folded = folded.withColumn("portion", F.lit(portion))
            known = self.entries().select("digest")
            fresh = folded.join(known, "digest", "left_anti").withColumn("fresh", F.lit(True))
            again = folded.join(known, "digest", "left_semi").withColumn("fresh", F.lit(False))
            # Settled first: a table can't be read and appended to by one job.
            both = settle(fresh.unionByName(again), "digest-portion")
            (both.drop("fresh").repartition(self.buckets, "digest").sortWithinPartitions("digest")
             .write.insertInto(self.name))
            return both.filter("fresh").drop("fresh")
        held = self.entries()
        before = held.filter(F.col("portion") < portion).select("digest")
        return held.filter(F.col("portion") == portion).join(before, "digest", "left_anti")

    def groups(self) -> DataFrame:
        """(digest, copies, best) over all portions; no shuffle, entries of a digest share a
        bucket."""
        return self.entries().groupBy("digest").agg(
            F.sum("copies").alias("copies"), F.min("best").alias("best"))


def decided(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """``rows`` (with their portion) with the entry of their digest: copies and best."""
    groups = index.groups()
    total = index.entries().agg(F.sum("copies")).first()[0] or 0
    hot = settle(groups.filter(F.col("copies") * FINE > F.lit(total)), "hot-digests")
    marked = rows.join(F.broadcast(hot), "digest", "left")  # fewer than FINE rows
    cold = marked.filter(F.col("best").isNull()).drop("copies", "best")
    return marked.filter(F.col("best").isNotNull()).unionByName(
        cold.join(groups, "digest"), allowMissingColumns=False)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     portions: int = PORTIONS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row of ``docs``, by a new index that
    takes them in ``portions``."""
    rows = digested(docs, id_col, text_col).withColumn(
        "portion", F.pmod(F.xxhash64("row"), F.lit(portions)).cast("int"))
    index = DigestIndex.new(docs.sparkSession, rows.count())
    for portion in range(portions):
        index.take(rows.filter(F.col("portion") == portion).drop("portion"), portion)
    best = F.col("best")
    return decided(rows, index).select(
        "doc_id", best["doc_id"].alias("keep_id"), F.col("copies").alias("group_size"),
        ((best["portion"] == F.col("portion")) & (best["row"] == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
