"""Response times: how long from report to completion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


UNITS = {"hours": 3600, "days": 86_400}


def _with_time(df: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """``_seconds`` between the raw times, whole ones (downwards), and whether the end is first."""
    start, end = (F.col(c).cast("timestamp") for c in (start_col, end_col))
    return df.withColumns({
        "_negative": end < start,
        "_seconds": F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000),
    })


def response_time_by_group(
    df: DataFrame, group_col: str, start_col: str, end_col: str, unit: str = "hours"
) -> DataFrame:
    """Cases, cases that end before they start, and mean, median and 90th percentile of the
    others, in ``unit`` (hours or days, with fractions).

    Times of day count: a case that ends earlier on its own day is negative. Rows are first
    counted per group and whole second, so a hot group reaches the exact percentiles as one
    weighted row per distinct duration.
    """
    size = float(UNITS[unit])
    counted = (
        _with_time(df, start_col, end_col)
        .filter(F.col("_seconds").isNotNull())
        .groupBy(group_col, "_negative", "_seconds")
        .agg(F.count("*").alias("cases"))
    )
    valid = ~F.col("_negative")
    time = F.when(valid, F.col("_seconds"))
    cases = F.when(valid, F.col("cases"))
    grouped = counted.groupBy(group_col).agg(
        F.sum("cases").alias("n_all"),
        F.coalesce(F.sum(F.when(~valid, F.col("cases"))), F.lit(0)).alias("n_negative"),
        F.coalesce(F.sum(cases), F.lit(0)).alias("n"),
        F.sum(time * cases).alias("total"),
        F.percentile(time, F.array(F.lit(0.5), F.lit(0.9)), F.coalesce(cases, F.lit(0))).alias("p"),
    )
    return grouped.select(
        group_col,
        "n_all",
        "n_negative",
        "n",
        (F.try_divide("total", "n") / size).alias(f"mean_{unit}"),
        (F.col("p")[0] / size).alias(f"median_{unit}"),
        (F.col("p")[1] / size).alias(f"p90_{unit}"),
    )


def daily_response_series(
    df: DataFrame, group_col: str, start_col: str, end_col: str, window_days: int = 7, unit: str = "hours"
) -> DataFrame:
    """Per group and start day: cases, their mean time in ``unit``, and the mean over the trailing
    week, the plain forecast for the next day. Cases that end before they start are left out."""
    size = float(UNITS[unit])
    daily = (
        _with_time(df, start_col, end_col)
        .filter(~F.col("_negative"))
        .groupBy(group_col, F.col(start_col).cast("date").alias("day"))
        .agg(F.count("*").alias("n"), F.sum("_seconds").alias("_sum"))
    )
    # At most one row per calendar day in a group.
    trailing = (
        Window.partitionBy(group_col)
        .orderBy(F.unix_date("day"))
        .rangeBetween(-(window_days - 1), Window.currentRow)
    )
    return daily.select(
        group_col,
        "day",
        "n",
        (F.col("_sum") / F.col("n") / size).alias(f"mean_{unit}"),
        (F.sum("_sum").over(trailing) / F.sum("n").over(trailing) / size).alias(f"trailing_mean_{unit}"),
    )


# Durations that share a first-level sum, so that no window sees more than one block of a group
# or the list of its blocks.
SECONDS_PER_BLOCK = 86_400
# A share of open cases counts as reached if rounding alone keeps it above.
_ROUNDING = 1e-12


def open_and_closed_times(
    df: DataFrame, group_col: str, start_col: str, end_col: str, as_of_col: str, unit: str = "hours"
) -> DataFrame:
    """How long cases take by the product-limit estimate, which counts cases that are still open
    for as long as they are known to have been open. Leaving them out makes times look short just
    where cases stay open.

    A case is open at the moment in ``as_of_col`` if it has no end or a later one; cases that start
    later, or end before they start, are left out. Per group: ``n_closed``, ``n_open``, the
    ``median`` and ``p90`` (null while more cases than that are open), ``mean_to_longest`` (mean
    time up to the longest known one) and ``still_open`` (estimated share open at that time). Ends
    come before open cases of the same second.
    """
    size = float(UNITS[unit])
    start, end, now = (F.col(c).cast("timestamp") for c in (start_col, end_col, as_of_col))
    closed = F.coalesce(end <= now, F.lit(False))
    until = F.when(closed, end).otherwise(now)
    known = (now >= start) & F.coalesce(end >= start, F.lit(True))
    counted = (
        df.filter(known)
        .select(group_col, closed.cast("bigint").alias("_closed"),
                F.floor((F.unix_micros(until) - F.unix_micros(start)) / 1_000_000).alias("_seconds"))
        .groupBy(group_col, "_seconds")
        .agg(F.sum("_closed").alias("_ends"), F.count("*").alias("_cases"))
        .withColumn("_block", F.floor(F.col("_seconds") / SECONDS_PER_BLOCK))
    )
    group = F.col(group_col)
    later = Window.partitionBy(group_col).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.groupBy(group_col, "_block").agg(F.sum("_cases").alias("_in"), F.max("_seconds").alias("_last"))
    blocks = blocks.select(
        group.alias("_group"), F.col("_block").alias("_of"), F.coalesce(F.sum("_in").over(later), F.lit(0)).alias("_beyond"),
        F.coalesce(F.lag("_last").over(Window.partitionBy(group_col).orderBy("_block")), F.lit(0)).alias("_reached"))
    inside = Window.partitionBy(group_col, "_block")
    longest_first = inside.orderBy(F.desc("_seconds")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_risk = F.sum("_cases").over(longest_first) + F.col("_beyond")
    # Where all that are left end, nothing stays open: a logarithm below all others.
    factor = F.when(F.col("_ends") == F.col("_at_risk"), F.lit(-1e6)).otherwise(
        F.log1p(-F.col("_ends") / F.col("_at_risk")))
    shortest_first = inside.orderBy("_seconds")
    so_far = shortest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = (
        counted.join(blocks, group.eqNullSafe(F.col("_group")) & (F.col("_block") == F.col("_of")))
        .withColumn("_at_risk", at_risk).withColumn("_factor", factor)
        .withColumns({
            "_sum": F.sum("_factor").over(so_far),
            "_since": F.coalesce(F.lag("_seconds").over(shortest_first), F.col("_reached")),
        })
    )
    earlier = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    totals = steps.groupBy("_group", "_of").agg(F.sum("_factor").alias("_all")).select(
        F.col("_group").alias("_g"), F.col("_of").alias("_o"), F.coalesce(F.sum("_all").over(earlier), F.lit(0.0)).alias("_before"))
    steps = steps.join(totals, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_of") == F.col("_o")))
    open_after = F.exp(F.col("_before") + F.col("_sum"))
    open_until = F.exp(F.col("_before") + F.col("_sum") - F.col("_factor"))

    def reached(share: float):
        return F.min(F.when(open_after <= 1 - share + _ROUNDING, F.col("_seconds"))) / size

    return steps.groupBy(group_col).agg(
        F.sum("_ends").alias("n_closed"),
        (F.sum("_cases") - F.sum("_ends")).alias("n_open"),
        reached(0.5).alias(f"median_{unit}"),
        reached(0.9).alias(f"p90_{unit}"),
        (F.sum((F.col("_seconds") - F.col("_since")) * open_until) / size).alias(f"mean_to_longest_{unit}"),
        F.min(open_after).alias("still_open"),
    )


def closing_day_series(
    df: DataFrame, group_col: str, start_col: str, end_col: str, window_days: int = 7, unit: str = "hours"
) -> DataFrame:
    """Per group and day on which cases ended: ``n``, their mean time, ``forecast`` (the mean over
    cases that ended in the ``window_days`` days before, which is all that was known that morning)
    and ``error``, the day's mean less the forecast. Cases that end before they start are left out.
    """
    size = float(UNITS[unit])
    daily = (
        _with_time(df, start_col, end_col)
        .filter(~F.col("_negative"))
        .groupBy(group_col, F.col(end_col).cast("date").alias("day"))
        .agg(F.count("*").alias("n"), F.sum("_seconds").alias("_sum"))
    )
    before = Window.partitionBy(group_col).orderBy(F.unix_date("day")).rangeBetween(-window_days, -1)
    mean = F.col("_sum") / F.col("n") / size
    forecast = F.try_divide(F.sum("_sum").over(before), F.sum("n").over(before)) / size
    return daily.select(
        group_col, "day", "n", mean.alias(f"mean_{unit}"), forecast.alias(f"forecast_{unit}"),
        (mean - forecast).alias(f"error_{unit}"))
