"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept. All but the last return the columns of ``documents``. The key by which a
decision finds its row is a hash of id and text, so rows without an id and rows that
share one are decided by their own text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.llm import decontam, langid, mixing, neardup, tokenfile
from knownwhen.llm.frames import table
from knownwhen.sources.shared import settle

#: Documents whose language is less certain than this go.
LEAST_SCORE = 0.4
#: Pieces of text a token worker remembers; it shares its process with the stages before.
TOKEN_MEMORY = 150_000


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go: those without letters and uncertain ones."""
    model = langid.train(langid.learnable(docs))
    return langid.accepted(docs, model, LEAST_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id, null last."""
    keyed = docs.withColumn("_key", _key())
    groups = neardup.near_duplicates(keyed, id_col="_key").select(
        F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_key", *rest, "text")
    one = keyed.join(groups, "_key").groupBy("_group").agg(F.min(order).alias("_one"))
    return one.select("_one.*").select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    keyed = docs.withColumn("_key", _key())
    found = decontam.matches(keyed, table(spark, sf_dir, "benchmark"), id_col="_key")
    hit = found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(hit, "_key", "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: the words it takes, in whole copies."""
    keyed = docs.withColumn("_key", _key())
    taken = mixing.mix(keyed, id_col="_key").groupBy("doc_id").agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_times"))
    taken = taken.filter("_times > 0").select(F.col("doc_id").alias("_key"), "_times")
    rows = keyed.join(taken, "_key")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file, and what it says of every document."""
    blocks = tokenfile.written(
        docs, public_tokenizers.path("word_bpe_49k.json"), memory=TOKEN_MEMORY)
    return tokenfile.documents(blocks)


STAGES = [
    ("language identification", languages),
    ("near-duplicates", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("source mixing", mixed),
    ("token ids", tokens),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
