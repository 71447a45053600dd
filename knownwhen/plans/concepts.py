"""Which source tags count towards which concept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownwhen.functions.values import any_of, first_match, share
from knownwhen.operators.dedup import bounded_tasks
from knownwhen.plans.silver import STANDARD_TAXONOMY, UNIT_IN_SCOPE, is_consolidated
from knownwhen.sources.schemas import CONCEPT_MAP

# Source tag, concept, statement, method, confidence, note.
CURATED = [
    ("Revenues", "REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH", "used under both rules"),
    ("RevenueFromContractWithCustomerExcludingAssessedTax", "REVENUE", "IS",
     "TAXONOMY_MIGRATION", "HIGH", "standard since the 2018 rule"),
    ("SalesRevenueNet", "REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH",
     "standard before the 2018 rule"),
    ("SalesRevenueGoodsNet", "REVENUE", "IS", "TAXONOMY_MIGRATION", "MEDIUM", "goods only"),
    ("CostOfRevenue", "COST_OF_REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH", ""),
    ("CostOfGoodsAndServicesSold", "COST_OF_REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH",
     "preferred since 2018"),
    ("CostOfGoodsSold", "COST_OF_REVENUE", "IS", "TAXONOMY_MIGRATION", "MEDIUM", "goods only"),
    ("CostsAndExpenses", "TOTAL_COSTS", "IS", "MANUAL", "HIGH", "all costs, kept apart"),
    ("NetIncomeLoss", "NET_INCOME", "IS", "SELF", "HIGH", "parent only"),
    ("ProfitLoss", "NET_INCOME_INCL_NCI", "IS", "MANUAL", "HIGH", "with minorities, kept apart"),
    ("CashAndCashEquivalentsAtCarryingValue", "CASH", "BS", "SELF", "HIGH",
     "without restricted cash"),
    ("Cash", "CASH", "BS", "MANUAL", "MEDIUM", "older narrow tag"),
    ("CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "CASH_INCL_RESTRICTED",
     "BS", "MANUAL", "HIGH", "with restricted cash, kept apart"),
]

# Words that place a tag on a statement; the first group that matches counts.
STATEMENT_WORDS = {
    "BS": ["Assets", "Liabilities", "StockholdersEquity", "Goodwill", "Inventory",
           "PropertyPlant", "AccountsPayable", "AccountsReceivable", "RetainedEarnings",
           "CommonStock", "PreferredStock", "AdditionalPaidIn", "AccumulatedOther", "Deposits"],
    "CF": ["NetCashProvided", "PaymentsTo", "ProceedsFrom", "IncreaseDecreaseIn",
           "Depreciation", "ShareBasedCompensation", "RepaymentsOf"],
    "EPS": ["EarningsPerShare", "PerBasicShare", "PerDilutedShare", "ParOrStatedValue"],
}
OTHER_STATEMENT = "IS"
COMMON_FROM = 0.05
CONFIDENCE_ORDER = ["LOW", "MEDIUM", "HIGH"]


def curated(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CURATED, CONCEPT_MAP)


def statement_of(tag: str) -> Column:
    lowered = F.lower(tag)
    return first_match(
        {name: any_of([lowered.contains(w.lower()) for w in words])
         for name, words in STATEMENT_WORDS.items()},
        otherwise=OTHER_STATEMENT)


def candidates(raw_facts: DataFrame, common_from: float = COMMON_FROM) -> DataFrame:
    """Tags that appear in at least ``common_from`` of the filings with usable facts.

    Filings per tag and in total are counted in one pass over the facts.
    """
    usable = raw_facts.where(
        is_consolidated() & (F.col("uom") == UNIT_IN_SCOPE)
        & F.col("version").startswith(STANDARD_TAXONOMY) & F.col("value").isNotNull())
    counts = _filings_per(usable.select("adsh", "tag"), [["tag"]])
    total = F.max(F.when(F.col("_level") == 1, F.col("filings"))).over(Window.partitionBy())
    return counts.withColumn("_total", total).where(
        (F.col("_level") == 0) & (F.col("filings") >= F.col("_total") * common_from)
    ).select("tag", "filings")


def _filings_per(rows: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Distinct filings for each set of columns and in total; ``_level`` is the grouping id."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return rows.groupingSets([[F.col(c) for c in s] for s in [*sets, []]], *columns).agg(
        F.grouping_id().alias("_level"), F.count_distinct("adsh").alias("filings"))


def build_map(decided: DataFrame, found: DataFrame) -> DataFrame:
    """Curated rows, then every common tag nobody decided on as its own concept."""
    undecided = found.join(decided, found["tag"] == decided["src_tag"], "left_anti")
    own = undecided.select(
        F.col("tag").alias("src_tag"), F.col("tag").alias("canonical_tag"),
        statement_of("tag").alias("statement"), F.lit("SELF").alias("mapping_method"),
        F.lit("HIGH").alias("confidence"), F.lit("").alias("note"))
    return decided.unionByName(own)


def dim_concept(concept_map: DataFrame) -> DataFrame:
    """Concepts with their source tags.

    ``min_confidence`` is the smallest word; ``weakest_confidence`` follows the scale.
    """
    scale = F.array(*[F.lit(c) for c in CONFIDENCE_ORDER])
    step = F.array_position(scale, F.col("confidence"))
    return concept_map.groupBy("canonical_tag", "statement").agg(
        F.count(F.lit(1)).alias("n_source_tags"),
        F.array_sort(F.collect_set("src_tag")).alias("source_tags"),
        F.max("mapping_method").alias("mapping_method"),
        F.min("confidence").alias("min_confidence"),
        F.min(step).alias("_weakest"),
    ).withColumn("weakest_confidence", F.get(scale, (F.col("_weakest") - 1).cast("int"))).drop(
        "_weakest")


def lineage(concept_map: DataFrame) -> DataFrame:
    """Concepts that fold several decisions together, largest first."""
    return (
        concept_map.where(F.col("mapping_method") != "SELF").groupBy("canonical_tag")
        .agg(F.count(F.lit(1)).alias("n_source_tags"),
             F.array_sort(F.collect_list("src_tag")).alias("tags"))
        .orderBy(F.desc("n_source_tags"), "canonical_tag")
    )


def coverage(raw_facts: DataFrame, concept_map: DataFrame) -> DataFrame:
    """Share of filings with a concept, by its best single tag and by all its tags."""
    bounded_tasks(raw_facts.sparkSession)
    mapping = concept_map.select("src_tag", "canonical_tag")
    pairs = raw_facts.select("adsh", F.col("tag").alias("src_tag")).distinct()
    levels = _filings_per(pairs.join(mapping, "src_tag", "left"),
                          [["canonical_tag", "src_tag"], ["canonical_tag"]])

    def at(level: int) -> Column:
        return F.when(F.col("_level") == level, F.col("filings"))

    per_concept = levels.withColumn("_all", F.max(at(3)).over(Window.partitionBy())).where(
        F.col("canonical_tag").isNotNull()).groupBy("canonical_tag").agg(
        F.max("_all").alias("filings"), F.max(at(0)).alias("filings_best_tag"),
        F.max(at(1)).alias("filings_mapped"))
    return per_concept.select(
        "canonical_tag", "filings", "filings_best_tag", "filings_mapped",
        share(F.col("filings_best_tag"), F.col("filings")).alias("pct_best_tag"),
        share(F.col("filings_mapped"), F.col("filings")).alias("pct_mapped"))
