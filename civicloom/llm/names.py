"""Column names that cannot clash with an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with its columns renamed ``column_0``, ``column_1``, ..., and the new name of each."""
    new = [f"column_{k}" for k in range(len(df.columns))]
    return df.toDF(*new), dict(zip(df.columns, new))
