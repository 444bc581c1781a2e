"""First load: CSV to a cleaned, typed snapshot, checked after it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.functions.text import clean_text, parse_timestamp
from civicloom.operators.aggregate import null_profile
from civicloom.session import spread
from civicloom.sources.snapshots import read_snapshot, write_snapshot
from civicloom.sources.tables import read_complaints_csv


def load_complaints(
    spark: SparkSession,
    csv_path: str,
    root: str,
    schema: T.StructType,
    text_col: str = "comment",
    ts_col: str = "timestamp",
    day_col: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read, clean the text, type the time, write the next snapshot, and return it. With
    ``day_col`` the snapshot is partitioned by the day, so that range queries open only the
    days they need. ``partitions`` deals the rows out after reading: a file with quoted line
    breaks is one task."""
    raw = spread(read_complaints_csv(spark, csv_path, schema), partitions)
    cleaned = raw.withColumns(
        {text_col: clean_text(F.col(text_col)), ts_col: parse_timestamp(F.col(ts_col))}
    )
    if day_col:
        cleaned = cleaned.withColumn(day_col, F.col(ts_col).cast("date"))
    write_snapshot(cleaned, root, (day_col,) if day_col else ())
    return read_snapshot(spark, root)


def verify_load(loaded: DataFrame) -> DataFrame:
    """Row count and nulls per column of what was written, in one pass."""
    return null_profile(loaded.withColumn("rows", F.lit(None))).select(
        F.col("rows").alias("row_count"), *loaded.columns
    )
