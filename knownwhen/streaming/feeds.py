"""Incremental feeds: raw files to bronze, bronze to silver.

Each feed is one streaming query with its own checkpoint, run until everything
that is there has been taken. Transforms are stateless, so late filings about
old periods are ordinary rows and no watermark is needed; gold is a batch job
over the sinks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.operators import quality
from knownwhen.plans import silver
from knownwhen.sources import headers
from knownwhen.sources.delimited import LAYOUT, stream_raw
from knownwhen.sources.versions import Log

Step = Callable[[DataFrame], DataFrame]
Load = Callable[[SparkSession, list[str]], DataFrame]

# Files, or batches of the feed before, that one micro-batch takes.
FILES_AT_ONCE = 1000


@dataclass(frozen=True)
class Feed:
    """Where a feed's rows and its progress are kept.

    A full refresh after a code change is a run at the next ``version``: a new
    sink and a new checkpoint, so nothing of the old code's output is mixed in.
    """

    root: str
    name: str
    version: int = 1

    @property
    def sink(self) -> str:
        return f"{self.root}/{self.name}/v{self.version}/rows"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/{self.name}/v{self.version}/progress"

    def refreshed(self) -> Feed:
        return Feed(self.root, self.name, self.version + 1)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.sink)


def run(source: DataFrame, feed: Feed) -> None:
    """Append everything new in ``source`` to the feed's sink, once."""
    query = (
        source.writeStream.format("parquet").outputMode("append")
        .option("path", feed.sink).option("checkpointLocation", feed.checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def ingest(spark: SparkSession, raw_root: str, kind: str, feed: Feed,
           layout: str = LAYOUT) -> None:
    run(stream_raw(spark, raw_root, kind, layout), feed)


def follow(spark: SparkSession, upstream: Feed) -> DataFrame:
    """The upstream feed's rows as a stream."""
    schema = spark.read.parquet(upstream.sink).schema
    return spark.readStream.schema(schema).parquet(upstream.sink)


def new_files(spark: SparkSession, glob: str, most: int = FILES_AT_ONCE) -> DataFrame:
    """Paths of new files as a stream, at most ``most`` a batch; their content is not read."""
    return (
        spark.readStream.format("binaryFile").option("maxFilesPerTrigger", str(most))
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(glob).select("path"))


def new_batches(spark: SparkSession, upstream: Feed, most: int = FILES_AT_ONCE) -> DataFrame:
    """The batches that a routed feed has finished, as a stream of the entries of its log."""
    return new_files(spark, f"{upstream.sink}/_log/[0-9]*", most)


def batches_of(upstream: Feed, name: str) -> Load:
    """How to read one sink of the batches of :func:`new_batches`."""
    def load(spark: SparkSession, entries: list[str]) -> DataFrame:
        log = Log(spark, upstream.sink)
        folders = [log.state(int(e.rsplit("/", 1)[-1]))["folders"][name] for e in sorted(entries)]
        return spark.read.parquet(*[f"{upstream.sink}/{f}" for f in folders])
    return load


def run_routed(source: DataFrame, steps: Mapping[str, Step], feed: Feed,
               contracts: Mapping[str, tuple[Mapping[str, Column], Mapping[str, Column]]] = {},
               load: Load | None = None) -> dict[str, dict[str, int]]:
    """Send one pass over ``source`` to several sinks.

    A batch is written under its own number and then entered in the feed's log. Only what
    the log has counts, for readers and for the next feed: a batch that was cut off is
    written again, one that was entered but not yet committed to the checkpoint is left as it
    is. With ``load`` the source says what to read (paths, such as those of
    :func:`new_files`), not the rows. ``contracts`` gives rules (to count, to stop at) for
    sinks; returned are the rows and the breaches that this run wrote to each.
    """
    counts: dict[str, dict[str, int]] = {}
    log = Log(source.sparkSession, feed.sink)

    def write(batch: DataFrame, number: int) -> None:
        if number < max(log.versions(), default=0):
            return
        held = batch.persist() if load is None else load(
            batch.sparkSession, sorted(r[0] for r in batch.distinct().collect()))
        folders = {}
        try:
            for name, step in steps.items():
                warn, fail = contracts.get(name, ({}, {}))
                rows = quality.enforce(step(held), fail) if fail else step(held)
                watched, seen = quality.watch(rows, warn)
                folders[name] = f"{name}/batch={number}"
                watched.write.mode("overwrite").parquet(f"{feed.sink}/{folders[name]}")
                total = counts.setdefault(name, dict.fromkeys(("rows", *warn), 0))
                for key, n in seen.get.items():
                    total[key] += n
        finally:
            if load is None:
                held.unpersist()
        log.commit(number, {"folders": folders})

    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", feed.checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return counts


def routed_rows(spark: SparkSession, feed: Feed, name: str) -> DataFrame:
    """What the feed's finished batches hold."""
    finished = max(Log(spark, feed.sink).versions(), default=0)
    return spark.read.parquet(f"{feed.sink}/{name}").where(F.col("batch") < finished).drop("batch")


def ingest_by_header(spark: SparkSession, raw_root: str, kind: str, feed: Feed,
                     layout: str = LAYOUT, most: int = FILES_AT_ONCE,
                     contract: tuple[Mapping[str, Column], Mapping[str, Column]] = ({}, {})
                     ) -> dict[str, dict[str, int]]:
    """New raw files to bronze, at most ``most`` a batch, each read by its own header.

    Sinks: ``{kind}_raw`` with the rows, ``{kind}_files`` with the files that don't fit.
    """
    paths: list[str] = []

    def load(session: SparkSession, found: list[str]) -> DataFrame:
        paths[:] = found
        return headers.read_by_header(session, found, kind)

    return run_routed(
        new_files(spark, layout.format(root=raw_root, kind=kind), most),
        {f"{kind}_raw": lambda rows: rows,
         f"{kind}_files": lambda rows: headers.not_read(rows.sparkSession, paths, kind)},
        feed, {f"{kind}_raw": contract}, load)


def fact_steps(concept_map: DataFrame) -> dict[str, Step]:
    return {"num": lambda raw: silver.facts(raw, concept_map),
            "num_quarantine": silver.facts_quarantine}


def submission_steps() -> dict[str, Step]:
    return {"sub": silver.submissions, "sub_quarantine": silver.submissions_quarantine}
