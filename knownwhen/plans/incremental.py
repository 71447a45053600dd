"""Keep a stored interval table up to date with newly arrived, possibly late, facts.

Two things are stored, both split into parts by company: the *reports* (what each filing
instant said of a key) and the *intervals* built from them. Intervals alone would not do:
a late report can turn an old repeat into a change, and repeats leave no interval.

A batch touches some parts and in these some keys. For a touched key nothing before its
first new instant changes but the end of the interval in force there. So its line is
threaded anew from that interval on: the interval travels as a report of its own value at its
own start, followed by the stored and new reports after the first new instant; numbers go
on from it. Earlier intervals, and all intervals of other keys, are copied, and the
reports of untouched parts are not opened.

Reports are only appended and folded when read (the last in tie order of an instant
counts), so a batch that is taken twice changes nothing. Interval parts are written anew. One
log entry switches both: a run that dies leaves the state before, and of two runs that
started from one state only the first counts. Columns of the key hold no nulls.

Within a part rows lie in buckets by key (fixed, too, when the store is first used). So only
the batch is shuffled, once, into its buckets: what is stored is joined, counted, spliced and
written again bucket by bucket, where it lies. Spark learns of the buckets by a name in the
session catalog that lasts as long as a batch is taken; the files stay under ``root``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.operators import timeline as tl
from knownwhen.plans import gold
from knownwhen.plans.gold import FACT_LINE, KEY
from knownwhen.sources.shared import scratch, settle
from knownwhen.sources.versions import Log

PARTS = 64
PART = "part"
# Order of the rows in a file.
CLUSTER = ["cik", "ddate", "canonical_tag", "qtrs"]
# Reports of a bucket, about: a task sorts them in memory. Each bucket is a file of every part,
# so small stores have few.
BUCKET_REPORTS = 500_000
BUCKETS = 8

REPORT = [*KEY, "accepted_ts", "adsh", "value", "statement", "form"]


@dataclass(frozen=True)
class IntervalStore:
    """Reports and intervals under ``root``, in ``parts`` parts (fixed when it is first used) and
    in as many buckets as the ``expected`` number of reports needs."""

    spark: SparkSession
    root: str
    parts: int = PARTS
    limit: int = tl.SLICE_INSTANTS
    expected: int = 0
    _names: list[str] = field(default_factory=list, repr=False, compare=False)

    @property
    def log(self) -> Log:
        return Log(self.spark, self.root)

    def intervals(self) -> DataFrame | None:
        """The stored interval table, None before the first batch."""
        _, state = self.log.latest()
        return self._files(self._chosen(state.get("intervals", {})))

    def _chosen(self, folders: dict[str, list[str]], parts: list[int] | None = None
                ) -> list[tuple[int, str]]:
        return [(int(p), f) for p, found in sorted(folders.items())
                if parts is None or int(p) in parts for f in found]

    def _files(self, chosen: list[tuple[int, str]]) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for _, f in chosen]) if chosen else None

    def _read(self, folders: dict[str, list[str]], parts: list[int] | None = None
              ) -> DataFrame | None:
        """Stored rows in their buckets; folders of stores without any are read as files."""
        chosen = self._chosen(folders, parts)
        buckets = {f: _buckets_of(f) for _, f in chosen}
        tables = [self._files([c for c in chosen if not buckets[c[1]]])]
        for n in sorted(set(buckets.values()) - {0}):
            tables.append(self._table([c for c in chosen if buckets[c[1]] == n], n))
        found = [t for t in tables if t is not None]
        return reduce(DataFrame.unionByName, found) if found else None

    def _table(self, chosen: list[tuple[int, str]], buckets: int) -> DataFrame:
        schema = self._files(chosen[:1]).schema
        columns = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in schema)
        name = self._new_name()
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, {PART} int, nth int) USING parquet "
            f"PARTITIONED BY ({PART}, nth) CLUSTERED BY ({', '.join(KEY)}) "
            f"INTO {buckets} BUCKETS LOCATION '{self.root}'")
        places = " ".join(f"PARTITION ({PART} = {p}, nth = {i}) LOCATION '{self.root}/{f}'"
                          for i, (p, f) in enumerate(chosen))
        self.spark.sql(f"ALTER TABLE {name} ADD {places}")
        # Only an alias that says more than the name lasts. Columns without a table are alike to
        # a union, which then leaves rows in their buckets.
        return self.spark.table(name).select(*[
            F.col(c).alias(c, metadata={"lie": "in buckets"}) for c in schema.names])

    def _new_name(self) -> str:
        self._names.append(f"spark_catalog.default.knownwhen_{uuid.uuid4().hex}")
        return self._names[-1]

    @contextmanager
    def _named(self) -> Iterator[None]:
        """Names given to files inside go at the end, the files stay."""
        before = len(self._names)
        try:
            with scratch(self.spark):
                yield
        finally:
            while len(self._names) > before:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._names.pop()}")

    def _write(self, rows: DataFrame, kind: str, buckets: int) -> str:
        """Write rows that lie in their buckets; returns their folder."""
        folder = f"{kind}-{uuid.uuid4().hex}-of-{buckets}"
        plain = rows.select(*[F.col(c).alias(c, metadata={}) for c in rows.columns])
        (plain.write.format("parquet").partitionBy(PART).bucketBy(buckets, *KEY).sortBy(*CLUSTER)
         .option("path", f"{self.root}/{folder}").saveAsTable(self._new_name()))
        return folder

    def _new_buckets(self) -> int:
        return max(BUCKETS, -(-self.expected // BUCKET_REPORTS))

    def take(self, facts: DataFrame) -> int:
        """Fit a batch in; returns the version, the old one if the batch is empty.

        ``facts`` are joined with their filings: the key, ``value``, ``accepted_ts``, ``adsh``,
        ``form`` and ``statement``.
        """
        with self._named():
            return self._take(facts)

    def _take(self, facts: DataFrame) -> int:
        version, state = self.log.latest()
        parts = state.get("parts", self.parts)
        buckets = state.get("buckets") or self._new_buckets()
        known_reports, known_intervals = state.get("reports", {}), state.get("intervals", {})

        # A column that holds a constant would be taken out of what rows are folded by, but not
        # out of what they are dealt out by, and Spark would deal them out once more.
        said = FACT_LINE.reports(facts).select(*REPORT).withColumns({
            c: F.when(F.spark_partition_id() >= 0, F.col(c)) for c in KEY})
        folded = tl.fold_instants(said.repartition(buckets, *KEY), FACT_LINE, KEY).select(
            *REPORT, self._part(parts).alias(PART))
        # Reports go to where they stay, and are read from there.
        added = self._write(folded, "reports", buckets)
        touched = sorted(r[0] for r in self.spark.read.schema(folded.schema).parquet(
            f"{self.root}/{added}").select(PART).distinct().collect())  # <= parts
        if not touched:
            return version

        new = self._read({str(p): [_in(added, p)] for p in touched})
        old_reports = self._read(known_reports, touched)
        old_intervals = self._read(known_intervals, touched)
        if old_intervals is None:
            copied, made = [], gold.described(rethread(new, old_reports, self.limit))
        else:
            stay, made = spliced(
                new, old_reports, old_intervals.withColumn(PART, self._part(parts)), self.limit)
            copied = [stay]
        written = self._write(reduce(DataFrame.unionByName, [
            *copied, made.withColumn(PART, self._part(parts))]), "intervals", buckets)
        return self.log.commit(version, {
            "parts": parts, "buckets": buckets,
            "intervals": known_intervals | {str(p): [_in(written, p)] for p in touched},
            "reports": known_reports | {
                str(p): [*known_reports.get(str(p), []), _in(added, p)] for p in touched}})

    def compact(self, folders: int = 8) -> int:
        """Fold the reports of parts that lie in more than ``folders`` folders into one each."""
        version, state = self.log.latest()
        known = state.get("reports", {})
        long = sorted(int(p) for p, found in known.items() if len(found) > folders)
        if not long:
            return version
        buckets = state.get("buckets") or self._new_buckets()
        with self._named():
            rows = tl.fold_instants(self._read(known, long), FACT_LINE, KEY).select(
                *REPORT, self._part(state["parts"]).alias(PART))
            folder = self._write(rows, "reports", buckets)
        return self.log.commit(version, state | {
            "buckets": buckets,
            "reports": known | {str(p): [_in(folder, p)] for p in long}})

    @staticmethod
    def _part(parts: int) -> Column:
        return F.pmod(F.xxhash64("cik"), F.lit(parts)).cast("int")


def _in(folder: str, part: int) -> str:
    return f"{folder}/{PART}={part}"


def _buckets_of(folder: str) -> int:
    """The number of buckets in a folder's name, 0 if it has none."""
    found = re.search(r"-of-(\d+)/", folder)
    return int(found[1]) if found else 0


def rethread(new: DataFrame, old: DataFrame | None, limit: int) -> DataFrame:
    """Intervals of reports, built from the start of their lines."""
    both = new.select(*REPORT) if old is None else new.select(*REPORT).unionByName(
        old.select(*REPORT))
    return tl.build(_sliced(both, both, limit), FACT_LINE, lying=True)


def spliced(new: DataFrame, old: DataFrame, intervals: DataFrame, limit: int
            ) -> tuple[DataFrame, DataFrame]:
    """``intervals`` of some companies after ``new`` reports came to the ``old`` ones: those that
    are copied as they are, with their part, and those that are made anew. Rows stay in their
    buckets, in which each learns the first new instant of its key.
    """
    # Keys with a null are equal to none: what is held of them stays, what is new is added.
    first = new.groupBy(*KEY).agg(F.min("accepted_ts").alias("_first")).hint("shuffle_hash")
    held = intervals.join(first, KEY, "left")
    starts, ends = F.col("known_from_ts"), F.col("known_to_ts")
    # Other keys, and what was over before anything new was said.
    copied = held.where(F.col("_first").isNull() | (ends < F.col("_first"))).select(
        *intervals.columns)
    # The interval that the first new instant falls into or ends, as a report of itself.
    carried = held.where((starts < F.col("_first")) & (ends >= F.col("_first"))).select(
        *KEY, starts.alias("accepted_ts"), F.col("source_adsh").alias("adsh"), "value",
        "statement", F.col("source_form").alias("form"),
        F.struct(F.col("revision_seq").alias("_seq"), F.col("prev_value").alias("_prev"))
        .alias("_base"))
    later = old.join(first, KEY).where(F.col("accepted_ts") >= F.col("_first"))
    told = new.select(*REPORT).unionByName(later.select(*REPORT)).unionByName(
        carried, allowMissingColumns=True)
    line = told.withColumn("_base", F.max("_base").over(Window.partitionBy(*KEY)))
    built = tl.build(_sliced(line, told, limit), FACT_LINE, lying=True)
    goes_on = (F.col("seq") == 1) & F.col("_base").isNotNull()
    renewed = built.withColumns({
        "prior": F.when(goes_on, F.col("_base._prev")).otherwise(F.col("prior")),
        "seq": (F.col("seq") + F.coalesce(F.col("_base._seq"), F.lit(1)) - 1).cast("int")})
    return copied, gold.described(renewed)


def _sliced(line: DataFrame, reports: DataFrame, limit: int) -> DataFrame:
    """``line`` with slices for keys of more than ``limit`` of its ``reports``, which are counted
    where they lie; the days of such keys are stored, and usually there are none."""
    many = reports.groupBy(*KEY).count().where(F.col("count") > limit).hint("shuffle_hash")
    slices = settle(tl.plan_slices(
        reports.join(many, KEY, "left_semi"), KEY, "accepted_ts", limit), "slices")
    return tl.in_slices(line, F.broadcast(slices), KEY, "accepted_ts")
