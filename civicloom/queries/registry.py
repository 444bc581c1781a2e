"""Registry of the bound queries and the complaint table they share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.labels import label_description
from civicloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The test tables of one scale, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """The session prepared for a bound query. A local session without a shared folder gets a
    temporary one: there the driver and the executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None and spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="civicloom-"))
    return prepare(spark)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(ready(spark), folder))

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def labeled_documents(t: Tables) -> DataFrame:
    """Documents as complaints: a code from ``labels`` where there is one, and its text."""
    code = (
        F.when((F.col("toxic") == 1) & (F.col("quality") == 0), "255")
        .when(F.col("toxic") == 1, "2")
        .otherwise(F.col("quality").cast("string"))
    )
    label = F.when(F.col("code").isNotNull(), label_description(F.col("code")))
    return (
        t.documents.join(t.labels, "doc_id", "left")
        .select("doc_id", "text", "source", "lang", "quality", code.alias("code"))
        .withColumn("llm_label", label)
    )


LABELED_DOCUMENTS = """
    complaints AS (
        SELECT doc_id, text, source, lang, quality, code,
               CASE code WHEN '0' THEN 'Not Sufficient' WHEN '1' THEN 'Sufficient'
                         WHEN '2' THEN 'Uncertain (has partial evidence)'
                         WHEN '255' THEN 'API Error' END AS llm_label
        FROM (SELECT d.doc_id, d.text, d.source, d.lang, l.quality,
                     CASE WHEN l.toxic = 1 AND l.quality = 0 THEN '255'
                          WHEN l.toxic = 1 THEN '2'
                          ELSE CAST(l.quality AS VARCHAR) END AS code
              FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id))
"""


def nation_districts(t: Tables) -> DataFrame:
    """Nations as districts: the name is the English one, the key as text the Thai one."""
    return t.nation.select(
        F.col("n_nationkey").cast("string").alias("amp_th"), F.col("n_name").alias("amp_en")
    )


NATION_DISTRICTS = """
    districts AS (SELECT CAST(n_nationkey AS VARCHAR) AS amp_th, n_name AS amp_en FROM nation)
"""
