"""Where intermediate and published tables go.

Every executor has to reach them and they have to outlive any one executor, so
the root is the folder the cluster names in ``spark.checkpoint.dir``. Only a
local-mode session, where driver and executors are one process, may fall back
to a temporary folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Tables of the innermost open scope, to be removed with it.
_SCOPE: ContextVar[list[str] | None] = ContextVar("_SCOPE", default=None)
_LOCAL_ROOT = "spark.knownwhen.localRoot"


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_ROOT, None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="knownwhen-")
    spark.conf.set(_LOCAL_ROOT, root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody else uses; nothing is created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, outlive: bool = False) -> DataFrame:
    """Write ``df`` once and go on from the written rows.

    Used where later steps must see exactly the same rows and row positions even
    if executors are lost and tasks are repeated. Inside :func:`scratch` the table
    goes with the scope, unless it is to ``outlive`` it.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    scope = _SCOPE.get()
    if scope is not None and not outlive:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside are removed at the end; nothing that reads them may leave."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        paths = _SCOPE.get() or []
        _SCOPE.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever the cluster keeps it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
