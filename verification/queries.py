"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.functions.values import quarter_of
from knownwhen.operators import asof, dedup, digests, quality
from knownwhen.plans import (
    concepts, control, dimensions, distinct, factors, gold, incremental, invariants, lineage,
    monitor, presentation, publishing, quality_history, silver, snapshots)
from knownwhen.plans.gold import KEY
from knownwhen.sources import catalog, delimited, files, headers, links, tables
from knownwhen.sources import driver_tables as dt
from knownwhen.sources.schemas import CONTROL, RESCUED, raw_columns
from knownwhen.sources.shared import new_folder, settle
from knownwhen.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "1998-06-30 00:00:00"
FACTOR = factors.Factor(top=("NET_INCOME", 4), bottom=("ASSETS", 0))
CENSOR_FROM = "2000-06-30"
CONCEPT_NAMES = ["NET_INCOME", "ASSETS", "REVENUE"]
MONITOR_ABOVE = 50.0
SEED = "42"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- shared inputs

def mapped_facts(spark: SparkSession, d: str) -> DataFrame:
    return dt.source_facts(spark, d).join(dt.concept_map(spark), "src_tag")


def _folded(spark: SparkSession, d: str) -> DataFrame:
    """Facts with their concept. Copies are folded before anything is joined."""
    rows = gold.fact_rows(dt.source_facts(spark, d)).join(dt.concept_map(spark), "src_tag")
    return rows.drop("src_tag")


def _dated(joined: DataFrame) -> DataFrame:
    return joined.withColumn("ddate", dt.period_end()).drop("years_back")


def attributed(spark: SparkSession, d: str) -> DataFrame:
    """Facts with concept and filing."""
    return _dated(gold.attach_filings(_folded(spark, d), dt.filings(spark, d)))


def sliced(spark: SparkSession, d: str) -> DataFrame:
    """The same with the slice of time each fact belongs to."""
    return _dated(_folded(spark, d).join(gold.sliced_filings(dt.filings(spark, d)), "adsh"))


def pit(spark: SparkSession, d: str, today: bool = False) -> DataFrame:
    return gold.fundamental_pit(sliced(spark, d), today=today)


def comparison(spark: SparkSession, d: str, filings: DataFrame) -> DataFrame:
    return factors.roa_comparison(
        pit(spark, d, today=True), factors.calendar_of(filings), FACTOR)


def deciles(spark: SparkSession, d: str) -> DataFrame:
    return factors.roa_deciles(comparison(spark, d, dt.filings(spark, d)))


def revisions(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_revision(pit(spark, d))


# ---------------------------------------------------------------- facts and intervals

@query
def fact_filing_join(spark: SparkSession, d: str) -> DataFrame:
    lines = dt.source_facts(spark, d).select("adsh", "src_tag", "qtrs", "uom", "value")
    return gold.attach_filings(lines, dt.filings(spark, d))


@query
def concept_map_apply(spark: SparkSession, d: str) -> DataFrame:
    return mapped_facts(spark, d).select(
        "adsh", "src_tag", "canonical_tag", "statement", "qtrs", "value")


@query
def dedup_per_filing(spark: SparkSession, d: str) -> DataFrame:
    return dedup.one_per_filing(attributed(spark, d), KEY, "adsh", "value")


@query
def dedup_per_instant(spark: SparkSession, d: str) -> DataFrame:
    per_filing = dedup.one_per_filing(attributed(spark, d), KEY, "adsh", "value")
    return dedup.one_per_instant(per_filing, KEY, "accepted_ts", "adsh")


@query
def change_points(spark: SparkSession, d: str) -> DataFrame:
    return gold.change_points(sliced(spark, d))


@query
def knowledge_intervals(spark: SparkSession, d: str) -> DataFrame:
    return pit(spark, d)


@query
def revision_class(spark: SparkSession, d: str) -> DataFrame:
    return pit(spark, d).groupBy("canonical_tag", "change_class").agg(
        F.count(F.lit(1)).alias("n"), F.min("pct_change").alias("min_pct"),
        F.max("pct_change").alias("max_pct"))


@query
def fact_revision(spark: SparkSession, d: str) -> DataFrame:
    return revisions(spark, d)


@query
def fundamental_as_of(spark: SparkSession, d: str) -> DataFrame:
    return asof.as_of(pit(spark, d), AS_OF).select(
        *KEY, "value", "known_from_ts", "source_adsh", "revision_seq")


@query
def asof_grid(spark: SparkSession, d: str) -> DataFrame:
    filings = dt.filings(spark, d)
    return asof.as_of_grid(pit(spark, d), factors.calendar_of(filings)).select(
        "rebalance_dt", *KEY, "value", "revision_seq")


@query
def intervals_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Filings arrive in four batches without regard to time, so most of the later ones are late;
    after each the stored intervals are spliced, never rebuilt."""
    rows = attributed(spark, d)
    store = incremental.IntervalStore(spark, new_folder(spark, "intervals"), parts=16,
                                      expected=dt.table(spark, d, "lineitem").count())
    batch = F.pmod(F.xxhash64("adsh"), F.lit(8))
    for share in ([0, 1, 2, 3, 4], [5], [6], [7]):
        store.take(rows.where(batch.isin(share)))
    return store.intervals()


# ---------------------------------------------------------------- dimensions and concepts

@query
def scd2_build(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.company_scd2(dt.registrants(spark, d))


def concept_map(spark: SparkSession, d: str) -> DataFrame:
    found = concepts.candidates(dt.named_facts(spark, d))
    return concepts.build_map(concepts.curated(spark), found)


@query
def concept_candidates(spark: SparkSession, d: str) -> DataFrame:
    return concepts.candidates(dt.named_facts(spark, d))


@query
def concept_statement_vote(spark: SparkSession, d: str) -> DataFrame:
    """Statements by the presentation lines of spelled-out tags, weighted by reported facts."""
    facts = dt.named_facts(spark, d)
    votes = presentation.statement_votes(dt.named_presentation(spark, d), facts)
    return presentation.statement_vote(votes)


@query
def concept_map_placed(spark: SparkSession, d: str) -> DataFrame:
    facts = dt.named_facts(spark, d)
    voted = presentation.statement_vote(
        presentation.statement_votes(dt.named_presentation(spark, d), facts))
    return presentation.placed(concept_map(spark, d), voted).select(
        "src_tag", "canonical_tag", "statement", "mapping_method")


@query
def concept_map_build(spark: SparkSession, d: str) -> DataFrame:
    folder = new_folder(spark, "concepts")
    tables.publish(concept_map(spark, d), folder, "concept_map")
    return tables.read_published(spark, folder, "concept_map").drop("note")


@query
def dim_concept(spark: SparkSession, d: str) -> DataFrame:
    dim = concepts.dim_concept(concept_map(spark, d))
    return dim.withColumn("source_tags", F.concat_ws(",", "source_tags"))


@query
def concept_lineage(spark: SparkSession, d: str) -> DataFrame:
    mapping = concept_map(spark, d)
    used = dt.named_facts(spark, d).groupBy("tag").agg(F.count(F.lit(1)).alias("facts"))
    lineage = concepts.lineage(mapping).withColumn("src_tag", F.explode("tags"))
    return lineage.join(used, lineage["src_tag"] == used["tag"], "left").groupBy(
        "canonical_tag", "n_source_tags").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("src_tag"))).alias("tags"),
        F.coalesce(F.sum("facts"), F.lit(0)).alias("facts"))


@query
def concept_coverage(spark: SparkSession, d: str) -> DataFrame:
    return concepts.coverage(dt.raw_facts(spark, d), dt.raw_concept_map(spark))


# ---------------------------------------------------------------- factor experiment

@query
def rebalance_calendar(spark: SparkSession, d: str) -> DataFrame:
    return factors.calendar_of(dt.filings(spark, d)).dates(spark)


@query
def factor_input_asof(spark: SparkSession, d: str) -> DataFrame:
    filings = dt.filings(spark, d)
    return factors.latest_inputs(
        pit(spark, d, today=True), factors.calendar_of(filings), FACTOR)


@query
def roa_comparison(spark: SparkSession, d: str) -> DataFrame:
    return comparison(spark, d, dt.filings(spark, d))


@query
def roa_deciles(spark: SparkSession, d: str) -> DataFrame:
    return deciles(spark, d)


@query
def bias_by_quarter(spark: SparkSession, d: str) -> DataFrame:
    return factors.bias_by_quarter(deciles(spark, d))


@query
def bias_window(spark: SparkSession, d: str) -> DataFrame:
    return factors.settled_quarters(factors.bias_by_quarter(deciles(spark, d)), CENSOR_FROM)


# ---------------------------------------------------------------- reports

@query
def coverage_by_quarter(spark: SparkSession, d: str) -> DataFrame:
    return monitor.coverage_by_quarter(
        silver.facts(_raw(dt.raw_facts(spark, d)), dt.raw_concept_map(spark)))


@query
def fact_explorer(spark: SparkSession, d: str) -> DataFrame:
    return monitor.fact_explorer(pit(spark, d), "NET_INCOME", 4)


@query
def restatement_monitor(spark: SparkSession, d: str) -> DataFrame:
    return monitor.restatement_monitor(
        revisions(spark, d), dimensions.current_names(dt.registrants(spark, d)), MONITOR_ABOVE)


# ---------------------------------------------------------------- checks

def _invariant(name: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        filings = dt.filings(spark, d)
        return invariants.CHECKS[name](pit(spark, d), filings)
    run.__name__ = name
    query(run)


for _name in invariants.CHECKS:
    _invariant(_name)


@query
def invariant_report(spark: SparkSession, d: str) -> DataFrame:
    filings = dt.filings(spark, d)
    return invariants.report(settle(pit(spark, d), "pit"), filings)


@query
def key_sample(spark: SparkSession, d: str) -> DataFrame:
    stored = settle(pit(spark, d), "pit")
    return invariants.of_keys(stored, invariants.key_sample(stored, 300, SEED)).select(
        *KEY, "value", "known_from_ts", "known_to_ts")


@query
def equivalence_check(spark: SparkSession, d: str) -> DataFrame:
    rows = settle(sliced(spark, d), "attributed")
    return invariants.equivalence(gold.fundamental_pit(rows), invariants.rebuilt(rows))


@query
def table_digest(spark: SparkSession, d: str) -> DataFrame:
    """A copy of the intervals that lacks some and has others changed: found by digests, and
    compared by row only in the parts where these differ."""
    held = settle(pit(spark, d), "pit")
    columns = [*KEY, "value", "known_from_ts", "known_to_ts"]
    lost = (F.col("cik") % 50 == 0) & (F.col("revision_seq") == 2)
    changed = (F.col("cik") % 70 == 1) & (F.col("revision_seq") == 1)
    copy = settle(held.where(~lost).withColumn("value", F.when(
        changed, F.col("value") + 1).otherwise(F.col("value")).cast("decimal(28,4)")), "copy")
    return digests.differences(held.select(*columns), copy.select(*columns), KEY)


@query
def distinct_filings(spark: SparkSession, d: str) -> DataFrame:
    """Different filings per tag and in all, merged from the bitmaps of three deliveries."""
    rows = settle(dt.named_facts(spark, d).where(
        silver.is_consolidated() & silver.is_standard_tag() & (F.col("uom") == "USD")
        & F.col("value").isNotNull()).select("adsh", "tag", "quarter"), "usable")
    store = distinct.DistinctStore(spark, new_folder(spark, "distinct"))
    year = F.substring("quarter", 1, 4).cast("int")
    for part in range(3):
        store.take(f"part {part}", rows.where(year % 3 == part), "tag", "adsh")
    return store.counts().unionByName(
        store.total().select(F.lit("all").alias("grouped"), "items"))


# ---------------------------------------------------------------- raw files and silver

def _raw(rows: DataFrame) -> DataFrame:
    """Raw rows as the reader would deliver them."""
    return rows.withColumns({
        "_ingested_at": F.current_timestamp(), "_source_file": F.lit(None).cast("string")})


def _files(spark: SparkSession, d: str, *kinds: str) -> tuple[str, str]:
    """The raw views written as text files; returns (root, layout)."""
    root = new_folder(spark, "raw")
    views = {"sub": dt.raw_submissions, "num": dt.raw_facts,
             "tag": dt.raw_tags, "pre": dt.raw_presentation}
    layout = ""
    for kind in kinds:
        layout = delimited.write_raw(views[kind](spark, d), root, kind)
    return root, layout


@query
def bronze_read(spark: SparkSession, d: str) -> DataFrame:
    """All four kinds read back: a digest of every field of every row, in file order."""
    root, layout = _files(spark, d, "sub", "num", "tag", "pre")
    out = None
    for kind in ("sub", "num", "tag", "pre"):
        rows = delimited.read_raw(spark, root, kind, layout)
        fields = [F.coalesce(c, F.lit("~")) for c in (*raw_columns(kind), RESCUED)]
        part = rows.select(F.lit(kind).alias("kind"), "quarter", F.md5(
            F.concat_ws("|", *fields).cast("binary")).alias("fields"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def bronze_rescue(spark: SparkSession, d: str) -> DataFrame:
    """Lines with a field too many or too few keep their text aside."""
    root = new_folder(spark, "torn")
    text = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in
                               ("adsh", "tag", "version", "ddate", "qtrs", "uom", "segments",
                                "coreg", "value", "footnote")])
    rows = dt.raw_facts(spark, d)
    last = F.substring(F.split("adsh", "-")[0], -1, 1)
    torn = F.when(last == "3", F.concat(text, F.lit("\textra"))).when(
        last == "7", F.regexp_replace(text, "\t[^\t]*\t[^\t]*$", "")).otherwise(text)
    header = "\t".join(("adsh", "tag", "version", "ddate", "qtrs", "uom", "segments", "coreg",
                        "value", "footnote"))
    # CSV with one unquoted column, so that every part file starts with the header.
    (rows.select(torn.alias(header), "quarter").write.partitionBy("quarter")
     .options(header="true", sep="\u0001", quote="", escape="", emptyValue="",
              ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
     .csv(f"{root}/num"))
    read = delimited.read_raw(spark, root, "num", "{root}/{kind}/quarter=*")
    rescued = F.col(delimited.RESCUED)
    return read.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("rows"), F.count(rescued).alias("rescued"),
        F.count_if(rescued.endswith("\textra")).alias("too_long"),
        F.count_if(rescued.isNull() & F.col("value").isNotNull()).alias("sound_values"))


@query
def bronze_provenance(spark: SparkSession, d: str) -> DataFrame:
    root, layout = _files(spark, d, "sub")
    rows = delimited.read_raw(spark, root, "sub", layout)
    return rows.select(
        "adsh", "quarter", F.col("_ingested_at").isNotNull().alias("has_time"),
        F.col("_source_file").contains("/sub/quarter=").alias("has_file"))


@query
def bronze_stream(spark: SparkSession, d: str) -> DataFrame:
    """Both feeds taken as streams, run twice: the second run finds nothing new."""
    root, layout = _files(spark, d, "sub", "num")
    out = None
    for kind in ("sub", "num"):
        feed = feeds.Feed(new_folder(spark, "bronze"), f"{kind}_raw")
        for _ in range(2):
            feeds.ingest(spark, root, kind, feed, layout)
        rows = feed.rows(spark).select(F.lit(kind).alias("kind"), "quarter", "adsh")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("kind", "quarter").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("adsh").alias("filings"))


@query
def silver_stream(spark: SparkSession, d: str) -> DataFrame:
    """Raw files to bronze to typed facts and quarantine, all as streams."""
    root, layout = _files(spark, d, "num")
    bronze = feeds.Feed(new_folder(spark, "bronze"), "num_raw")
    feeds.ingest(spark, root, "num", bronze, layout)
    routed = feeds.Feed(new_folder(spark, "silver"), "num")
    feeds.run_routed(feeds.follow(spark, bronze), feeds.fact_steps(dt.raw_concept_map(spark)),
                     routed)
    kept = feeds.routed_rows(spark, routed, "num")
    return kept.select("adsh", "src_tag", "canonical_tag", "statement", "ddate", "qtrs", "uom",
                       "value", "version", "quarter")


@query
def stream_bounded(spark: SparkSession, d: str) -> DataFrame:
    """Raw files to typed facts and quarantine, 24 files and two batches at a time; each hop
    runs twice and finds nothing new. Files are read by their header."""
    root, layout = _files(spark, d, "num")
    bronze = feeds.Feed(new_folder(spark, "bronze"), "num_raw")
    routed = feeds.Feed(new_folder(spark, "silver"), "num")
    for _ in range(2):
        feeds.ingest_by_header(spark, root, "num", bronze, layout, most=24)
        feeds.run_routed(feeds.new_batches(spark, bronze, most=2),
                         feeds.fact_steps(dt.raw_concept_map(spark)), routed,
                         load=feeds.batches_of(bronze, "num_raw"))
    kept = feeds.routed_rows(spark, routed, "num").select(
        "adsh", "quarter", F.lit("kept").alias("outcome"))
    return kept.unionByName(feeds.routed_rows(spark, routed, "num_quarantine").select(
        "adsh", "quarter", F.col(silver.REASON).alias("outcome")))


@query
def bronze_header_route(spark: SparkSession, d: str) -> DataFrame:
    """Files whose columns are swapped, missing, extra or repeated, depending on the quarter:
    rows are mapped by name, other columns kept aside, files that don't fit listed."""
    # Joined once, not for each of the four kinds of files.
    root, rows = new_folder(spark, "headers"), settle(dt.raw_facts(spark, d), "raw-num")
    known = raw_columns("num")
    swapped = ["tag", "adsh", *known[2:-1]]  # and without the footnote
    heads = {"q1": known, "q2": swapped, "q3": [*known, "note"],
             "q4": [c for c in known if c != "value"]}
    for end, head in heads.items():
        (rows.where(F.col("quarter").endswith(end)).withColumn("note", F.col("segments"))
         .select(*head, "quarter").write.mode("append").partitionBy("quarter")
         .options(sep="\t", header="true", quote="", escape="", emptyValue="", nullValue="",
                  ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
         .csv(f"{root}/num"))
    glob = f"{root}/num/quarter=*"
    read = headers.read_by_header(spark, glob, "num").groupBy("quarter").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("adsh").contains("-")).alias("adshs"),
        F.count("value").alias("values"), F.count(RESCUED).alias("rescued"),
        F.lit(None).cast("string").alias("reason"))
    left = headers.not_read(spark, glob, "num").groupBy("quarter", "reason").agg(
        F.sum("rows").alias("rows"))
    return read.unionByName(left, allowMissingColumns=True)


@query
def submission_stream(spark: SparkSession, d: str) -> DataFrame:
    """Submissions as a stream into silver and quarantine."""
    root, layout = _files(spark, d, "sub")
    bronze = feeds.Feed(new_folder(spark, "bronze"), "sub_raw")
    feeds.ingest(spark, root, "sub", bronze, layout)
    routed = feeds.Feed(new_folder(spark, "silver"), "sub")
    feeds.run_routed(feeds.follow(spark, bronze), feeds.submission_steps(), routed)
    kept = feeds.routed_rows(spark, routed, "sub").select(
        "adsh", "cik", "form", F.lit(None).cast("string").alias("reason"), "quarter")
    broken = feeds.routed_rows(spark, routed, "sub_quarantine").select(
        "adsh", F.col("cik").cast("bigint"), "form", F.col(silver.REASON).alias("reason"),
        "quarter")
    return kept.unionByName(broken)


@query
def publish_all(spark: SparkSession, d: str) -> DataFrame:
    """Raw files to all published tables: rows written, and breaches of each contract."""
    root, layout = _files(spark, d, "sub", "num", "tag", "pre")
    full_map = dt.raw_concept_map(spark).select(
        "src_tag", "canonical_tag", "statement", F.lit("MANUAL").alias("mapping_method"),
        F.lit("HIGH").alias("confidence"), F.lit("").alias("note"))
    return publishing.publish_all(
        spark, root, new_folder(spark, "published"), full_map, FACTOR, layout)


@query
def header_profile(spark: SparkSession, d: str) -> DataFrame:
    """The column names that raw files of each kind start with."""
    root, layout = _files(spark, d, "sub", "num")
    out = None
    for kind in ("sub", "num"):
        found = files.headers(spark, layout.format(root=root, kind=kind)).select(
            F.lit(kind).alias("kind"), "quarter", F.concat_ws(",", "columns").alias("columns"))
        out = found if out is None else out.unionByName(found)
    return out.distinct()


@query
def full_refresh(spark: SparkSession, d: str) -> DataFrame:
    """After a code change the feed is rebuilt from the start in a new version."""
    root, layout = _files(spark, d, "num")
    bronze = feeds.Feed(new_folder(spark, "bronze"), "num_raw")
    feeds.ingest(spark, root, "num", bronze, layout)
    old = feeds.Feed(new_folder(spark, "silver"), "num")
    feeds.run(silver.facts_quarantine(feeds.follow(spark, bronze)), old)
    new = old.refreshed()
    feeds.run(silver.facts(feeds.follow(spark, bronze), dt.raw_concept_map(spark)), new)
    return new.rows(spark).groupBy("canonical_tag").agg(
        F.count(F.lit(1)).alias("facts"), F.sum("value").alias("total"))


@query
def raw_manifest(spark: SparkSession, d: str) -> DataFrame:
    root, layout = _files(spark, d, "sub", "num")
    counts = files.manifest(spark, {
        kind: layout.format(root=root, kind=kind) for kind in ("sub", "num")})
    return counts.select(
        "quarter", F.col("row_counts")["sub.txt"].alias("sub_rows"),
        F.col("row_counts")["num.txt"].alias("num_rows"))


@query
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return files.column_profile(dt.raw_facts(spark, d), ["quarter"])


@query
def silver_sub(spark: SparkSession, d: str) -> DataFrame:
    return silver.submissions(_raw(dt.raw_submissions(spark, d))).drop(
        "_ingested_at", "_source_file")


@query
def silver_num(spark: SparkSession, d: str) -> DataFrame:
    return silver.facts(_raw(dt.raw_facts(spark, d)), dt.raw_concept_map(spark)).drop(
        "_ingested_at")


@query
def quarantine_route(spark: SparkSession, d: str) -> DataFrame:
    broken = silver.facts_quarantine(dt.raw_facts(spark, d)).select(
        F.lit("num").alias("table"), "adsh", silver.REASON, "quarter")
    subs = silver.submissions_quarantine(_raw(dt.raw_submissions(spark, d))).select(
        F.lit("sub").alias("table"), "adsh", silver.REASON, "quarter")
    return broken.unionByName(subs)


@query
def exclusion_funnel(spark: SparkSession, d: str) -> DataFrame:
    return silver.exclusions(
        silver.fact_outcomes(dt.raw_facts(spark, d), dt.raw_concept_map(spark)))


@query
def reconcile_layers(spark: SparkSession, d: str) -> DataFrame:
    """The layers are published, then what they hold is compared with the raw rows."""
    root = new_folder(spark, "layers")
    raw, mapping = settle(dt.raw_facts(spark, d), "bronze-num"), dt.raw_concept_map(spark)
    subs = _raw(settle(dt.raw_submissions(spark, d), "bronze-sub"))
    for name, rows in (
            ("num", silver.facts(_raw(raw), mapping)),
            ("num_quarantine", silver.facts_quarantine(raw)),
            ("exclusions", silver.exclusions(silver.fact_outcomes(raw, mapping))),
            ("sub", silver.submissions(subs)),
            ("sub_quarantine", silver.submissions_quarantine(subs))):
        tables.publish(rows, root, name)

    def read(name: str) -> DataFrame:
        return tables.read_published(spark, root, name)

    return silver.reconciliation(
        "num", raw, read("num"), read("num_quarantine"), read("exclusions"), silver.FACT_BREAKS,
    ).unionByName(silver.reconciliation(
        "sub", subs, read("sub"), read("sub_quarantine"),
        silver.exclusions(silver.submission_outcomes(subs)), silver.SUBMISSION_BREAKS))


@query
def quality_rates(spark: SparkSession, d: str) -> DataFrame:
    facts = quality.breach_counts(
        silver.typed_facts(dt.raw_facts(spark, d)), silver.fact_rules())
    subs = quality.breach_counts(
        silver.typed_submissions(dt.raw_submissions(spark, d)), silver.submission_rules())
    return facts.select(F.lit("num").alias("table"), "*").unionByName(
        subs.select(F.lit("sub").alias("table"), "*"))


def _quality_runs(spark: SparkSession, d: str) -> DataFrame:
    """The ledger after every quarter was recorded, the early ones twice."""
    root = new_folder(spark, "quality")
    counts = settle(quality_history.run_counts(
        silver.typed_facts(dt.raw_facts(spark, d)),
        {**silver.fact_rules(), "reported_before_1995": F.col("ddate_dt") < F.lit("1995-01-01")},
        "quarter"), "quality-counts")
    quality_history.record(counts.where("run < '1995'"), root)
    quality_history.record(counts, root)
    return quality_history.ledger(spark, root)


@query
def quality_jumps(spark: SparkSession, d: str) -> DataFrame:
    return quality_history.jumps(_quality_runs(spark, d))


@query
def quality_change_points(spark: SparkSession, d: str) -> DataFrame:
    return quality_history.change_points(_quality_runs(spark, d))


@query
def expect_warn(spark: SparkSession, d: str) -> DataFrame:
    """Breaches counted while rows are written, also where the table is laid out in ranges;
    every row is kept."""
    root = new_folder(spark, "watched")
    watched = {
        "sub": (silver.submissions(_raw(dt.raw_submissions(spark, d))), {
            "adsh_well_formed": silver.submission_rules()["adsh_well_formed"],
            "fp_known": F.col("fp").isNotNull()}),
        "fact_fundamental_pit": (pit(spark, d), {
            "revision_seq_positive": F.col("revision_seq") >= 1,
            "value_positive": F.col("value") > 0})}
    out = None
    for name, (rows, rules) in watched.items():
        seen = tables.publish_watched(rows, root, name, rules)
        written = tables.read_published(spark, root, name).agg(
            F.count(F.lit(1)).alias("written"))
        for rule in rules:
            row = written.select(
                F.lit(name).alias("table"), F.lit(rule).alias("rule"), "written",
                F.lit(seen["rows"]).cast("bigint").alias("rows"),
                F.lit(seen[rule]).cast("bigint").alias("breaches"))
            out = row if out is None else out.unionByName(row)
    return out


@query
def expect_fail(spark: SparkSession, d: str) -> DataFrame:
    """Guarded rows: any breach would abort the job."""
    guarded = quality.enforce(silver.submissions(_raw(dt.raw_submissions(spark, d))), {
        "accepted_ts_not_null": F.col("accepted_ts").isNotNull(),
        "cik_not_null": F.col("cik").isNotNull()})
    return guarded.groupBy("form").agg(F.count(F.lit(1)).alias("filings"))


@query
def publish_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    folder = new_folder(spark, "gold")
    guarded = quality.enforce(pit(spark, d), {
        "known_from_before_known_to": F.col("known_from_ts") < F.col("known_to_ts"),
        "value_not_null": F.col("value").isNotNull()})
    tables.publish(guarded, folder, "fact_fundamental_pit")
    return tables.read_published(spark, folder, "fact_fundamental_pit")


@query
def company_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Names over time of companies that are one under several numbers."""
    return lineage.entity_names(dt.renamed_registrants(spark, d))


# Ranges of one column each, that a layout should let a reader find without the rest.
RANGES = {"cik": ("100", "199"), "ddate": ("1994-12-31", "1995-12-31"),
          "known_from_ts": ("1996-01-01 00:00:00", "1996-03-31 00:00:00")}


@query
def layout_curve(spark: SparkSession, d: str) -> DataFrame:
    """Ranges of company, period and publication, read from intervals laid out along a curve."""
    root = new_folder(spark, "gold")
    tables.publish_along_curve(pit(spark, d), root, "fact_fundamental_pit", list(RANGES))
    rows = tables.read_published(spark, root, "fact_fundamental_pit")
    answers = [
        rows.where(F.col(c).between(*[F.lit(x).cast(rows.schema[c].dataType) for x in ends]))
        .groupBy(F.lit(c).alias("ranged_by"), "canonical_tag")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"),
             F.min("known_from_ts").alias("first_known"))
        for c, ends in RANGES.items()]
    return reduce(DataFrame.union, answers)


# ---------------------------------------------------------------- catalog

def _registered(spark: SparkSession, root: str) -> str:
    """The database in which the tables under ``root`` can be selected from."""
    database = "kw_" + root.rsplit("-", 1)[-1]
    catalog.register(spark, root, database=database)
    catalog.create_views(spark, database)
    catalog.create_functions(spark, database)
    return database


@query
def as_of_function(spark: SparkSession, d: str) -> DataFrame:
    """The as-of question in SQL, as a table function over the published table."""
    root = new_folder(spark, "gold")
    tables.publish(pit(spark, d), root, "fact_fundamental_pit")
    _registered(spark, root)
    return spark.sql(
        f"SELECT {', '.join(KEY)}, value, known_from_ts, source_adsh, revision_seq "
        f"FROM fundamental_as_of(TIMESTAMP '{AS_OF}')")


@query
def company_function(spark: SparkSession, d: str) -> DataFrame:
    """Company attributes at one instant beside today's, by function and view."""
    root = new_folder(spark, "gold")
    tables.publish(dimensions.company_scd2(dt.registrants(spark, d)), root, "dim_company_scd2")
    database = _registered(spark, root)
    return spark.sql(
        f"SELECT t.cik, t.name, t.sic, t.fye, n.name AS name_now, n.version_seq AS versions "
        f"FROM company_as_of(TIMESTAMP '{AS_OF}') t JOIN {database}.current_company n "
        f"ON t.cik = n.cik")


@query
def catalog_tables(spark: SparkSession, d: str) -> DataFrame:
    """What the catalog says of published tables, with the rows a SELECT finds in each. Tables
    are published twice: entries move on to the second version."""
    root, database = new_folder(spark, "gold"), ""
    for _ in range(2):
        held = tables.publish(pit(spark, d), root, "fact_fundamental_pit")
        tables.publish(gold.fact_revision(spark.read.parquet(held)), root, "fact_revision")
        tables.publish(_merged_control(spark, d), root, "ingest_control")
        database = _registered(spark, root)
    counted = None
    for name, layer, comment, version in catalog.described(spark, database):
        row = spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), F.lit(layer).alias("layer"),
            F.lit(comment).alias("comment"), F.lit(version).alias("version"), "rows")
        counted = row if counted is None else counted.unionByName(row)
    return counted


# ---------------------------------------------------------------- control table

def _links(spark: SparkSession, d: str) -> DataFrame:
    quarter = quarter_of("accepted_ts")
    return dt.filings(spark, d).select(quarter.alias("quarter")).distinct().withColumn(
        "zip_url", F.concat(F.lit("https://example.org/"), "quarter", F.lit(".zip")))


def _known_control(spark: SparkSession, d: str) -> DataFrame:
    """Quarters before 1999, in a state that follows from their name."""
    state = F.element_at(
        F.array(*[F.lit(s) for s in ("DONE", "PENDING", "FAILED", "RUNNING")]),
        F.right("quarter", F.lit(1)).cast("int"))
    return control.as_control(_links(spark, d).where(F.col("quarter") < "1999").select(
        "quarter", "zip_url", state.alias("status"), F.lit(1).alias("attempts"),
        F.lit("2024-01-01 00:00:00").alias("discovered_at")))


def _merged_control(spark: SparkSession, d: str) -> DataFrame:
    offered = control.offer(_links(spark, d), "2025-01-01 00:00:00")
    return control.merge_discovered(_known_control(spark, d), offered)


_CONTROL_SHOWN = ["quarter", "zip_url", "status", "attempts", "last_error", "discovered_at"]


@query
def control_merge(spark: SparkSession, d: str) -> DataFrame:
    """The table is created on the first run only; what is discovered again changes nothing.
    Discoveries are offered as a temporary view, and the result is read from the catalog."""
    root = new_folder(spark, "control")
    for _ in range(2):
        tables.create_if_absent(spark, root, "ingest_control", CONTROL)
        for offered in (_known_control(spark, d),
                        control.offer(_links(spark, d), "2025-01-01 00:00:00")):
            offered.createOrReplaceTempView("offered_quarter")
            tables.update(spark, root, "ingest_control", lambda held: control.merge_discovered(
                held, spark.table("offered_quarter")))
    shown = ", ".join(_CONTROL_SHOWN)
    return spark.sql(f"SELECT {shown} FROM {_registered(spark, root)}.ingest_control")


@query
def control_transition(spark: SparkSession, d: str) -> DataFrame:
    """Start everything open, finish the first halves of the years, fail the third quarters.
    Each step is a published version of its own."""
    root = new_folder(spark, "control")
    tables.publish(_merged_control(spark, d), root, "ingest_control")
    merged = tables.read_published(spark, root, "ingest_control")
    every = merged.select("quarter")

    def change(step: Callable[[DataFrame, DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
        tables.update(spark, root, "ingest_control", lambda held: step(held, rows))
        return tables.read_published(spark, root, "ingest_control")

    started = change(control.start, every.union(every))  # asked for twice, done once
    per_quarter = dt.filings(spark, d).groupBy(quarter_of("accepted_ts").alias("quarter")).agg(
        F.count(F.lit(1)).alias("n"))
    running = started.where("status = 'RUNNING'").select("quarter").join(per_quarter, "quarter")
    done = running.where(F.col("quarter").rlike("q[12]$")).select(
        "quarter", (F.col("n") * 100).alias("bytes_downloaded"),
        F.lit(1).alias("files_extracted"),
        F.create_map(F.lit("sub.txt"), "n").alias("row_counts"),
        F.lit("2025-02-01 00:00:00").alias("completed_at"))
    failed = running.where(F.col("quarter").endswith("q3")).select(
        "quarter", F.concat(F.lit("can't read "), F.repeat(F.lit("x"), F.lit(1000))).alias("error"))
    change(control.finish, done.union(done))
    return change(control.fail, failed.union(failed)).select(
        "quarter", "status", "attempts", "bytes_downloaded", "files_extracted",
        F.col("row_counts")["sub.txt"].alias("sub_rows"), "last_error", "completed_at")


@query
def control_status(spark: SparkSession, d: str) -> DataFrame:
    """Counts by status, with the quarters still to do (a list bounded by the calendar)."""
    merged = _merged_control(spark, d)
    waiting = control.pending(merged).groupBy("status").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("quarter"))).alias("pending"))
    return control.status_counts(merged).join(waiting, "status", "left")


@query
def link_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Distinct absolute links in the pages that end in a plain word."""
    pages = dt.table(spark, d, "pages")
    found = links.discover(pages, "https://example.org", link=r'href="([^"]+)"',
                           token="([a-z]+)$")
    return links.require_some(found)


# ---------------------------------------------------------------- snapshots

YEARS = (("1997-01-01", "1998-01-01"), ("1998-01-01", "1999-01-01"))


def _told(spark: SparkSession, d: str) -> DataFrame:
    facts = snapshots.comparable(
        dt.raw_facts(spark, d), dt.raw_concept_map(spark), CONCEPT_NAMES)
    return facts.join(snapshots.filed(_raw(dt.raw_submissions(spark, d))), "adsh")


def _diff(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.diff(_told(spark, d), *YEARS)


@query
def snapshot_resolve(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.resolve(_told(spark, d).where(snapshots.within(YEARS[1])))


@query
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    return _diff(spark, d).drop("factor")


@query
def snapshot_rates(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.rates(_diff(spark, d), "canonical_tag", "qtrs")


@query
def snapshot_artefacts(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.artefacts(_diff(spark, d))


@query
def snapshot_histogram(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.histogram(_diff(spark, d))


@query
def snapshot_year_mix(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.year_mix(_diff(spark, d))


@query
def snapshot_candidates(spark: SparkSession, d: str) -> DataFrame:
    want = snapshots.Verifiable(pct_from=3, pct_to=90, base_above=20)
    return snapshots.candidates(_diff(spark, d), want).select(
        *snapshots.KEY, "value_a", "value_b", "pct")


@query
def snapshot_buckets(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.buckets(_diff(spark, d), large=40, very_large=1000, revenue="REVENUE")


@query
def snapshot_largest(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.largest_revisions(_diff(spark, d)).select(
        *snapshots.KEY, "value_a", "value_b", "pct", "adsh_a", "adsh_b")


@query
def filing_path(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.filing_path(
        silver.submissions(_raw(dt.raw_submissions(spark, d))),
        "https://example.org/data/", "adsh").select("adsh", "cik", "path")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """What was each company's figure as of one day, as then known?"""
    return fundamental_as_of(spark, d)
