"""The driver's order tables seen as filings and facts.

An order is a filing by a customer, its lines are the reported facts. The
period a fact describes is stated relative to the filing year (``years_back``),
so copies can be folded before the filing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.functions.values import quarter_of
from knownwhen.sources.schemas import raw_columns

# Source tag, concept, statement.
CONCEPTS = [
    ("AF", "NET_INCOME", "IS"), ("AO", "NET_INCOME", "IS"),
    ("NF", "ASSETS", "BS"), ("NO", "ASSETS", "BS"),
    ("RF", "REVENUE", "IS"), ("RO", "REVENUE", "IS"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def filings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("adsh"), F.col("o_custkey").alias("cik"),
        F.col("o_orderdate").alias("accepted_ts"), F.col("o_orderpriority").alias("form"),
    )


def registrants(spark: SparkSession, folder: str) -> DataFrame:
    """Filings with the attributes a company states about itself."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("cik"), F.col("o_orderdate").alias("accepted_ts"),
        F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("sic"),
        F.when(F.col("o_orderkey") % 97 != 0, F.lit("1231")).alias("fye"),
    )


def renamed_registrants(spark: SparkSession, folder: str) -> DataFrame:
    """Filings of companies of which some share a tax number or give a former name."""
    cik, at = F.col("o_custkey"), F.col("o_orderdate")
    renamed = (cik % 7 == 3) & (cik % 50 >= 7)
    return table(spark, folder, "orders").select(
        cik.alias("cik"), at.alias("accepted_ts"),
        F.concat(F.lit("Company "), cik.cast("string")).alias("name"),
        F.when(cik % 35 == 0, F.floor(cik / 70).cast("string")).when(cik % 11 == 0, " ").alias("ein"),
        F.when(renamed, F.concat(F.lit(" COMPANY  "), (cik - 7).cast("string"))).alias("former"),
        F.when(renamed & (F.col("o_orderkey") % 2 == 0), F.date_sub(at.cast("date"), 30))
        .alias("changed"))


def concept_map(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{s}', '{c}', '{st}')" for s, c, st in CONCEPTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS m(src_tag, canonical_tag, statement)")


def _reported() -> Column:
    """Line quantities, bucketed so that repeats, sign flips and scale errors occur.

    Whole numbers are built as integers: they convert to decimals much faster.
    """
    exact = "decimal(28,4)"
    tens = F.floor(F.col("l_quantity") / 5 + 0.5) * 10
    return (
        F.when(F.col("l_returnflag") == "N", F.floor(F.col("l_quantity") * 100 + 0.5).cast(exact))
        .when(F.col("l_discount") >= 0.095, (-tens).cast(exact))
        .when(F.col("l_discount") <= 0.005, (tens * 1000).cast(exact))
        .when(F.col("l_tax") < 0.005, (tens + 0.01).cast(exact))
        .otherwise(tens.cast(exact))
    )


def source_facts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("adsh"),
        F.concat("l_returnflag", "l_linestatus").alias("src_tag"),
        (F.lit(1) + F.col("l_linenumber") % 2).alias("years_back"),
        F.when(F.col("l_returnflag") == "N", 0).otherwise(4).cast("smallint").alias("qtrs"),
        F.lit("USD").alias("uom"),
        _reported().alias("value"),
    )


def period_end(accepted: str = "accepted_ts", years_back: str = "years_back") -> Column:
    return F.make_date(F.year(accepted) - F.col(years_back), F.lit(12), F.lit(31))


# ---------------------------------------------------------------- raw text with faults
# A fault depends on key columns only, so the counts repeat at every size.

RAW_CONCEPTS = [c for c in CONCEPTS if c[0] != "RO"]


def raw_concept_map(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{s}', '{c}', '{st}')" for s, c, st in RAW_CONCEPTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS m(src_tag, canonical_tag, statement)")


def _every(column: str, n: int, rest: int = 0) -> Column:
    return F.col(column) % n == rest


def _accession(order_key: str) -> Column:
    key = F.col(order_key)
    # Formatting numbers costs more than all else here, so usual keys are only padded.
    padded = F.concat(F.lpad(key.cast("string"), 10, "0"), F.lit("-00-"),
                      F.lpad((key % 1000000).cast("string"), 6, "0"))
    well_formed = F.when(key.between(0, 9_999_999_999), padded).otherwise(F.concat(
        F.format_string("%010d", key), F.lit("-00-"), F.format_string("%06d", key % 1000000)))
    return F.when(_every(order_key, 199), key.cast("string")).otherwise(well_formed)


def _day_text(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("1231"))


def raw_submissions(spark: SparkSession, folder: str) -> DataFrame:
    form = F.col("o_orderpriority")
    filled = {
        "adsh": _accession("o_orderkey"),
        "cik": F.when(_every("o_orderkey", 211), "x").otherwise(F.col("o_custkey").cast("string")),
        "name": F.concat(F.lit('Company "'), F.col("o_custkey").cast("string"), F.lit('"')),
        "sic": F.col("o_orderstatus"),
        "fye": F.lit("1231"),
        "form": F.when(form == "1-URGENT", "8-K").when(form == "2-HIGH", "10-K/A")
                 .when(form == "5-LOW", "10-Q").otherwise("10-K"),
        "period": F.when(_every("o_orderkey", 223), "19xx0101")
                   .when(_every("o_orderkey", 227), "20301231")
                   .otherwise(_day_text(F.year("o_orderdate") - 1)),
        "fy": (F.year("o_orderdate") - 1).cast("string"),
        "fp": F.lit("FY"),
        "filed": F.date_format("o_orderdate", "yyyyMMdd"),
        "accepted": F.when(_every("o_orderkey", 229), "bad").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        "prevrpt": F.when(_every("o_orderkey", 5), "1").otherwise("0"),
        "detail": F.lit("1"),
    }
    empty = F.lit(None).cast("string")
    return table(spark, folder, "orders").select(
        *[filled.get(c, empty).alias(c) for c in raw_columns("sub")],
        quarter_of("o_orderdate").alias("quarter"))


def raw_facts(spark: SparkSession, folder: str) -> DataFrame:
    text = "string"
    dated = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    year = F.year("o_orderdate") - 1 - F.col("l_linenumber") % 2
    return dated.select(
        _accession("l_orderkey").alias("adsh"),
        F.concat("l_returnflag", "l_linestatus").alias("tag"),
        F.when(_every("l_partkey", 31), F.col("l_orderkey").cast(text))
         .otherwise("us-gaap/2024").alias("version"),
        F.when(_every("l_suppkey", 23) & _every("l_partkey", 41), "9999")
         .when(_every("l_partkey", 43), "19791231").otherwise(_day_text(year)).alias("ddate"),
        F.when(_every("l_partkey", 29), "2").when(F.col("l_returnflag") == "N", "0")
         .otherwise("4").alias("qtrs"),
        F.when(_every("l_partkey", 19), "EUR").otherwise("USD").alias("uom"),
        F.when(_every("l_partkey", 7), "Seg=A").when(_every("l_partkey", 7, 1), "  ")
         .alias("segments"),
        F.when(_every("l_partkey", 53), "Sub").alias("coreg"),
        F.when(_every("l_partkey", 47), "abc")
         .when(~_every("l_partkey", 59), F.col("l_quantity").cast(text)).alias("value"),
        F.lit(None).cast(text).alias("footnote"),
        quarter_of("o_orderdate").alias("quarter"))


# What the six source tags are called where names matter.
TAG_NAMES = {"AF": "Revenues", "AO": "ProceedsFromSaleOfProperty", "NF": "AssetsCurrent",
             "NO": "NetIncomeLoss", "RF": "EarningsPerShareBasic", "RO": "CostOfGoodsSold"}


def named_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw facts with spelled-out tags, and rare tags below the usual threshold."""
    name = F.lit(None).cast("string")
    for code, tag in TAG_NAMES.items():
        name = F.when(F.col("tag") == code, tag).otherwise(name)
    rare = F.concat(F.lit("RareTag"), F.substring("value", 1, 1))
    return raw_facts(spark, folder).withColumn(
        "tag", F.when(F.col("ddate") == "19791231", rare).otherwise(name))


def raw_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Taxonomy entries: each tag once per quarter it is used in."""
    used = raw_facts(spark, folder).select(
        "tag", "quarter", F.col("version").startswith("us-gaap").alias("standard")).distinct()
    filled = {
        "tag": F.col("tag"),
        "version": F.when(F.col("standard"), "us-gaap/2024").otherwise("filer"),
        "custom": F.when(F.col("standard"), "0").otherwise("1"),
        "abstract": F.lit("0"), "datatype": F.lit("monetary"),
        "iord": F.when(F.col("tag").startswith("N"), "I").otherwise("D"),
        "tlabel": F.concat(F.lit("Label "), F.col("tag")),
    }
    empty = F.lit(None).cast("string")
    return used.select(*[filled.get(c, empty).alias(c) for c in raw_columns("tag")], "quarter")


def raw_presentation(spark: SparkSession, folder: str) -> DataFrame:
    """Where each distinct tag of a filing is shown."""
    shown = raw_facts(spark, folder).select("adsh", "tag", "version", "quarter").distinct()
    filled = {
        "adsh": F.col("adsh"), "report": F.lit("1"), "line": F.lit("1"),
        "stmt": F.when(F.col("tag").startswith("N"), "BS").otherwise("IS"),
        "inpth": F.lit("0"), "rfile": F.lit("H"), "tag": F.col("tag"),
        "version": F.col("version"),
        "plabel": F.concat(F.lit('As "shown": '), F.col("tag")), "negating": F.lit("0"),
    }
    return shown.select(*[filled[c].alias(c) for c in raw_columns("pre")], "quarter")


def named_presentation(spark: SparkSession, folder: str) -> DataFrame:
    """Where filings show spelled-out tags; some show one elsewhere, on two statements or on none."""
    shown = named_facts(spark, folder).select("adsh", "tag").distinct()
    usual = F.when(F.col("tag").startswith("Assets"), "BS").when(
        F.col("tag").startswith("Proceeds"), "CF").otherwise("IS")
    last = F.substring("adsh", -1, 1)
    places = F.when(last == "1", F.array(F.lit("BS"))).when(
        last == "2", F.array(usual, F.lit("EQ"))).when(
        last == "3", F.array(F.lit(" "))).otherwise(F.array(usual))
    return shown.select("adsh", "tag", F.explode(places).alias("stmt"))
