"""Published tables: their names, what they hold, and how they are laid out.

Every version of a table is a folder of its own, and its log names the current one, so a
table is replaced as a whole or not at all, and a change may read the table it replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from knownwhen.operators.quality import watch
from knownwhen.sources.layout import along_curve
from knownwhen.sources.shared import scratch, settle
from knownwhen.sources.versions import ConcurrentChange, Log


@dataclass(frozen=True)
class Published:
    name: str
    layer: str
    comment: str
    # Rows are range-clustered by these, so readers skip row groups. The later
    # columns only split runs that would otherwise land in one file.
    cluster: tuple[str, ...] = field(default=())


CATALOGUE = {t.name: t for t in [
    Published("sub_raw", "bronze", "Submissions as filed, all text"),
    Published("num_raw", "bronze", "Reported numbers as filed, all text"),
    Published("tag_raw", "bronze", "Taxonomy entries as filed, all text"),
    Published("pre_raw", "bronze", "Statement presentation as filed, all text"),
    Published("sub", "silver", "Typed submissions of the annual and quarterly forms"),
    Published("sub_quarantine", "quarantine", "Broken submissions and why"),
    Published("num", "silver", "Consolidated USD facts with their concept"),
    Published("num_quarantine", "quarantine", "Broken facts and why"),
    Published("exclusions", "silver", "How many facts were kept, broken or out of scope"),
    Published("concept_map", "silver", "Source tag to concept"),
    Published("fact_fundamental_pit", "gold", "Knowledge intervals per fact",
              ("cik", "ddate", "canonical_tag", "qtrs", "known_from_ts")),
    Published("fact_revision", "gold", "Restatements", ("cik", "ddate", "revised_at_ts")),
    Published("dim_company_scd2", "gold", "Company attributes over time",
              ("cik", "valid_from_ts")),
    Published("dim_concept", "gold", "Concepts and their source tags"),
    Published("dim_rebalance_date", "gold", "Quarter ends"),
    Published("fact_roa_comparison", "gold", "Return on assets, then and now"),
    Published("fact_roa_ranked", "gold", "Decile under each view"),
    Published("agg_bias_by_quarter", "gold", "How much the two rankings disagree"),
    Published("quality_run", "ops", "Rows and breaches of each rule per run"),
    Published("ingest_control", "ops", "One row per quarter to fetch"),
]}


def log_of(spark: SparkSession, root: str, name: str) -> Log:
    return Log(spark, f"{root}/{CATALOGUE[name].layer}/{name}")


def version_of(spark: SparkSession, root: str, name: str) -> int:
    """The current version of a table, 0 if it was never published."""
    return log_of(spark, root, name).latest()[0]


def publish(rows: DataFrame, root: str, name: str, based_on: int | None = None) -> str:
    """Replace a published table; returns the folder of its rows.

    ``based_on`` is the version that the rows were made from (by default the current one):
    if another one was published since, nothing changes and :class:`ConcurrentChange` is raised.
    """
    return _write(_clustered(rows, name), root, name, based_on)


def publish_along_curve(rows: DataFrame, root: str, name: str, columns: Sequence[str],
                        files: int | None = None) -> str:
    """Replace a published table, laid out so that each of ``columns`` prunes files.

    The rows are settled first: they are made once, though the layout reads them three times.
    """
    with scratch(rows.sparkSession):
        settled = settle(rows, "curve")
        return _write(along_curve(settled, columns, files=files), root, name)


def publish_watched(rows: DataFrame, root: str, name: str, rules: Mapping[str, Column]
                    ) -> dict[str, int]:
    """Replace a published table and count ``rows`` and the breaches of each rule.

    Rows are looked at after they are laid out, in the stage that writes them.
    """
    watched, seen = watch(_clustered(rows, name), rules)
    _write(watched, root, name)
    return seen.get


def update(spark: SparkSession, root: str, name: str, change: Callable[[DataFrame], DataFrame],
           attempts: int = 5) -> int:
    """Publish ``change`` of the current rows; returns the new version.

    Where somebody else was faster, the change is made again from what they published.
    """
    for left in reversed(range(attempts)):
        version = version_of(spark, root, name)
        try:
            publish(change(read_published(spark, root, name)), root, name, version)
            return version + 1
        except ConcurrentChange:
            if not left:
                raise
    raise ValueError("at least one attempt is needed")


def create_if_absent(spark: SparkSession, root: str, name: str, schema: StructType) -> bool:
    """An empty table with the schema's column comments, unless it is there; says which."""
    if version_of(spark, root, name):
        return False
    try:
        publish(spark.createDataFrame([], schema), root, name, 0)
    except ConcurrentChange:
        return False
    return True


def _clustered(rows: DataFrame, name: str) -> DataFrame:
    by = CATALOGUE[name].cluster
    return rows.repartitionByRange(*by).sortWithinPartitions(*by) if by else rows


def _write(rows: DataFrame, root: str, name: str, based_on: int | None = None) -> str:
    log = log_of(rows.sparkSession, root, name)
    version = log.latest()[0] if based_on is None else based_on
    folder = f"rows-{uuid.uuid4().hex}"
    rows.write.parquet(f"{log.path}/{folder}")
    log.commit(version, {"folder": folder})
    return f"{log.path}/{folder}"


def folder_of(spark: SparkSession, root: str, name: str, version: int | None = None) -> str:
    """Where the rows of a table's current (or an earlier, kept) version are."""
    log = log_of(spark, root, name)
    number = version or log.latest()[0]
    if not number:
        raise LookupError(f"{name} was never published under {root}")
    return f"{log.path}/{log.state(number)['folder']}"


def read_published(spark: SparkSession, root: str, name: str,
                   version: int | None = None) -> DataFrame:
    return spark.read.parquet(folder_of(spark, root, name, version))


def describe(spark: SparkSession) -> DataFrame:
    rows = [(t.name, t.layer, t.comment, ",".join(t.cluster)) for t in CATALOGUE.values()]
    return spark.createDataFrame(rows, "name string, layer string, comment string, cluster string")
