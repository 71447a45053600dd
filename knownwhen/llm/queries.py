"""The operators as queries over the driver's tables, and their SQL for DuckDB."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.llm import (
    decontam, digest_index, divergence, html_text, langid, mixing, neardup, pii, runs, sharding,
    tokenfile, topk, warc)
from knownwhen.llm.oracles import ORACLES  # noqa: F401 - read by the entry
from knownwhen.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op1_exact_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op2_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return pii.personal_data(table(spark, d, "documents"))


@query
def op3_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"))


@query
def op4_token_blocks(spark: SparkSession, d: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return tokenfile.documents(tokenfile.written(table(spark, d, "documents"), path))


@query
def op5_html_text(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extracted(table(spark, d, "pages"))


@query
def op6_minhash_neardup(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "documents"))


@query
def op7_warc_chunks(spark: SparkSession, d: str) -> DataFrame:
    return warc.archived(table(spark, d, "pages"))


@query
def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.languages(table(spark, d, "documents"))


@query
def op9_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.decontaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op10_vector_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.sharded(table(spark, d, "documents"))


@query
def op11_digest_index(spark: SparkSession, d: str) -> DataFrame:
    return digest_index.exact_duplicates(table(spark, d, "documents"))


@query
def op12_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audited(table(spark, d, "documents"))


def _planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """One document in ten (by the checksum of its id) repeats a stretch of its words to its end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    begin = h // 10 % n
    period = 1 + (n - begin) // (3 + h // 10 % 8)
    at = np.arange(n)
    return np.where(at < begin, at, begin + (at - begin) % period)


@query
def op13_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(table(spark, d, "documents"), order=_planted))
