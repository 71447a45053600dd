"""From raw files to every published table, with the contract of each on the way."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.operators import quality
from knownwhen.operators.asof import Quarters
from knownwhen.plans import concepts, dimensions, factors, gold, silver
from knownwhen.sources import tables
from knownwhen.sources.delimited import LAYOUT
from knownwhen.streaming import feeds


@dataclass(frozen=True)
class Contract:
    """Rules whose breaches are counted, and rules whose first breach stops the run."""

    warn: Mapping[str, Column] = field(default_factory=dict)
    fail: Mapping[str, Column] = field(default_factory=dict)


def contracts() -> dict[str, Contract]:
    filing = Contract(warn={"adsh_not_null": F.col("adsh").isNotNull()})
    return {
        "sub_raw": filing, "num_raw": filing, "pre_raw": filing,
        "tag_raw": Contract(warn={"tag_not_null": F.col("tag").isNotNull()}),
        "sub": Contract(
            warn={"adsh_well_formed": F.col("adsh").rlike(silver.ACCESSION_FORMAT)},
            fail={"accepted_ts_not_null": F.col("accepted_ts").isNotNull(),
                  "cik_not_null": F.col("cik").isNotNull()}),
        "num": Contract(
            warn={"value_not_null": F.col("value").isNotNull(),
                  "qtrs_valid": F.col("qtrs").isin(*silver.PERIODS_IN_SCOPE)},
            fail={"ddate_not_null": F.col("ddate").isNotNull()}),
        "fact_fundamental_pit": Contract(
            warn={"revision_seq_positive": F.col("revision_seq") >= 1},
            fail={"known_from_before_known_to": F.col("known_from_ts") < F.col("known_to_ts"),
                  "value_not_null": F.col("value").isNotNull()}),
        "dim_company_scd2": Contract(
            fail={"valid_interval": F.col("valid_from_ts") < F.col("valid_to_ts")}),
    }


class Run:
    """One run: where tables go, and what was counted when they were written."""

    def __init__(self, spark: SparkSession, root: str,
                 rules: Mapping[str, Contract] | None = None):
        self.spark, self.root = spark, root
        self.rules = contracts() if rules is None else rules
        self.counts: dict[str, dict[str, int]] = {}

    def _of(self, name: str) -> Contract:
        return self.rules.get(name, Contract())

    def publish(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a table under its contract; returns it as written."""
        contract = self._of(name)
        if contract.fail:
            rows = quality.enforce(rows, contract.fail)
        self.counts[name] = tables.publish_watched(rows, self.root, name, contract.warn)
        return tables.read_published(self.spark, self.root, name)

    def bronze(self, raw_root: str, kind: str, feed: feeds.Feed, layout: str) -> None:
        """Take new raw files in, each by its own header; files that don't fit are counted."""
        contract = self._of(f"{kind}_raw")
        seen = feeds.ingest_by_header(self.spark, raw_root, kind, feed, layout,
                                      contract=(contract.warn, contract.fail))
        self.counts[f"{kind}_raw"] = seen[f"{kind}_raw"]

    def stream(self, upstream: feeds.Feed, name: str, feed: feeds.Feed,
               steps: Mapping[str, feeds.Step]) -> dict[str, DataFrame]:
        """Send one sink of a feed on to tables under their contracts; returns them as written."""
        seen = feeds.run_routed(
            feeds.new_batches(self.spark, upstream), steps, feed,
            {n: (self._of(n).warn, self._of(n).fail) for n in steps},
            feeds.batches_of(upstream, name))
        for table, counts in seen.items():
            self.counts[table] = counts
        return {n: feeds.routed_rows(self.spark, feed, n) for n in steps}

    def report(self) -> DataFrame:
        """(table, rows, rule, breaches): one row per rule, or one without a rule."""
        rows = []
        for name, counts in self.counts.items():
            warn = [(rule, counts[rule]) for rule in self._of(name).warn] or [(None, None)]
            rows += [(name, counts["rows"], rule, n) for rule, n in warn]
        return self.spark.createDataFrame(
            rows, "table string, rows long, rule string, breaches long")


def publish_all(spark: SparkSession, raw_root: str, root: str, concept_map: DataFrame,
                factor: factors.Factor, layout: str = LAYOUT,
                rules: Mapping[str, Contract] | None = None) -> DataFrame:
    """Take all raw files in as streams, then build and publish every table.

    ``concept_map`` has the columns of the published map. Returns :meth:`Run.report`.
    """
    run = Run(spark, root, rules)
    bronze: dict[str, feeds.Feed] = {}
    for kind in ("sub", "num", "tag", "pre"):
        bronze[kind] = feeds.Feed(f"{root}/bronze", f"{kind}_raw")
        run.bronze(raw_root, kind, bronze[kind], layout)
    mapping = run.publish("concept_map", concept_map)

    subs = run.stream(bronze["sub"], "sub_raw", feeds.Feed(f"{root}/silver", "sub"),
                      feeds.submission_steps())["sub"]
    facts = run.stream(bronze["num"], "num_raw", feeds.Feed(f"{root}/silver", "num"),
                       feeds.fact_steps(mapping))["num"]
    raw_facts = feeds.routed_rows(spark, bronze["num"], "num_raw")
    run.publish("exclusions", silver.exclusions(silver.fact_outcomes(raw_facts, mapping)))

    calendar = Quarters.of(subs, "accepted_ts")
    pit = run.publish("fact_fundamental_pit", gold.pit_from_silver(facts, subs))
    run.publish("fact_revision", gold.fact_revision(pit))
    run.publish("dim_company_scd2", dimensions.company_scd2(subs))
    run.publish("dim_concept", concepts.dim_concept(mapping))
    run.publish("dim_rebalance_date", calendar.dates(spark))
    compared = run.publish("fact_roa_comparison", factors.roa_comparison(
        factors.with_current_value(pit), calendar, factor))
    ranked = run.publish("fact_roa_ranked", factors.roa_deciles(compared))
    run.publish("agg_bias_by_quarter", factors.bias_by_quarter(ranked))
    return run.report()
