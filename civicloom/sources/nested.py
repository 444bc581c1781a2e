"""Nested JSON inputs: feature collections and open-data envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.session import spread

FEATURE_COLLECTION = (
    "features array<struct<properties: struct<amp_en: string, amp_th: string>, geometry: string>>"
)


def read_feature_collection(
    spark: SparkSession, path: str, multi_line: bool = True
) -> DataFrame:
    """One row per feature: ``amp_en``, ``amp_th`` and the geometry as JSON text.

    ``multi_line=False`` reads one collection per line, which Spark can split.
    """
    collections = spark.read.schema(FEATURE_COLLECTION).json(path, multiLine=multi_line)
    return collections.select(F.explode("features").alias("f")).select(
        "f.properties.amp_en", "f.properties.amp_th", "f.geometry"
    )


def _parsed(bodies: DataFrame, record_schema: T.StructType, body_col: str) -> DataFrame:
    envelope = T.StructType(
        [
            T.StructField("success", T.BooleanType()),
            T.StructField(
                "result",
                T.StructType(
                    [
                        T.StructField("total", T.LongType()),
                        T.StructField("records", T.ArrayType(record_schema)),
                    ]
                ),
            ),
        ]
    )
    # A list is taken apart without being filtered first, so the body is read once.
    return bodies.withColumn("_e", F.from_json(F.col(body_col), envelope))


def _accepted(need_success: bool) -> Column:
    """Whether the flag lets a body count: absent it does unless it is needed; ``false`` never."""
    return F.coalesce(F.col("_e.success"), F.lit(not need_success))


def read_api_envelope(
    bodies: DataFrame,
    record_schema: T.StructType,
    body_col: str = "body",
    need_success: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """The records of the answers, with the total each answer states.

    ``fetched`` is the number of records in the same body: where it is below ``total`` the
    caller has not read all pages. A body whose ``success`` is false gives no records, nor does
    one without the flag if ``need_success``; ``rejected_bodies`` lists them.
    """
    read = _parsed(spread(bodies.select(body_col), partitions), record_schema, body_col)
    return read.select(
        F.col("_e.result.total").alias("total"),
        F.size("_e.result.records").cast("bigint").alias("fetched"),
        F.explode(F.when(_accepted(need_success), F.col("_e.result.records"))).alias("r"),
    ).select("r.*", "total", "fetched")


def rejected_bodies(
    bodies: DataFrame,
    record_schema: T.StructType,
    body_col: str = "body",
    need_success: bool = False,
) -> DataFrame:
    """Bodies that ``read_api_envelope`` does not take, or not whole, with the reason: ``null``,
    ``unreadable``, ``unsuccessful``, ``no flag``, ``no records``, or ``incomplete`` where the
    body states a larger total than it holds records. All columns of ``bodies`` are kept."""
    read = _parsed(bodies, record_schema, body_col)
    body, records = F.col(body_col), F.col("_e.result.records")
    is_object = F.schema_of_variant(F.try_parse_json(body)).startswith("OBJECT")
    reason = (
        F.when(body.isNull(), "null")
        .when(~F.coalesce(is_object, F.lit(False)), "unreadable")
        .when(F.col("_e.success") == F.lit(False), "unsuccessful")
        .when(F.lit(need_success) & F.col("_e.success").isNull(), "no flag")
        .when(records.isNull(), "no records")
        .when(F.col("_e.result.total") > F.size(records), "incomplete")
    )
    return read.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_e")
