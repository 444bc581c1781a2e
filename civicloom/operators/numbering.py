"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicloom.session import pin

_PART, _PLACE, _BEFORE, _TIE = "_part", "_place", "_before", "_tie"
_PLACE_BITS = 33  # monotonically_increasing_id keeps the place in the task in its low bits


def number_rows(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Numbers from 1 in the order given; rows equal in all of it come in any order.

    A global sort cuts the table into ranges of all sort columns together, and of a number
    that tells equal rows apart, so neither rows of one time stamp nor exact copies crowd one
    task. The sorted table is written once; each row keeps its range and its place in it, and
    the number of rows in the ranges before (one row per sort task) is all that has to be added.
    """
    told_apart = df.withColumn(_TIE, F.monotonically_increasing_id())
    in_order = told_apart.orderBy(*order_by, _TIE).select(
        *df.columns,
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1).alias(_PLACE),
    )
    written = pin(in_order, "in-order")
    sizes = written.groupBy(_PART).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE)
    )
    # At most one row per sort task: a bound the session's partition count sets.
    return (
        written.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col(_BEFORE) + F.col(_PLACE) + 1)
        .drop(_PART, _PLACE, _BEFORE)
    )


def assign_batches(
    df: DataFrame, order_by: Sequence[str], batch_size: int = 20
) -> DataFrame:
    """Adds ``batch_num`` and ``pos``, both from 1, in the order given."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    place = F.col("_row_number") - 1
    return number_rows(df, order_by, "_row_number").select(
        *df.columns,
        (F.expr(f"(_row_number - 1) div {int(batch_size)}") + 1).alias("batch_num"),
        (place % batch_size + 1).cast("int").alias("pos"),
    )
