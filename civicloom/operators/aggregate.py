"""Counts, shares, label statistics, bins and top lists.

Every aggregate is a partial and a final one, so a key that holds a third of all rows sends
one row per task over the network. Totals and maxima over groups are scalar subqueries on the
grouped table: no window pulls all groups into one task, and Spark reuses the grouping's shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.functions.labels import severity
from civicloom.functions.numbers import relative_bin
from civicloom.operators.filters import has_coordinates, split_by_status
from civicloom.schemas import FIFTH_BINS, KNOWN_LABELS, SEVERITY_WEIGHTS

# Output column of each label the dashboard shows.
LABEL_COLUMNS = {
    "Sufficient": "sufficient",
    "Not Sufficient": "not_sufficient",
    "Uncertain (has partial evidence)": "uncertain",
    "API Error": "api_error",
}


def over_groups(groups: DataFrame, value: Column) -> Column:
    """One value over a grouped table, such as a sum or a maximum, as a scalar subquery.

    The subquery takes in every column of the groups: otherwise Catalyst would prune the ones
    it does not need, the two groupings would differ, and the source would be read twice.
    """
    kept = [F.max(field.name).alias(field.name) for field in groups.schema if _is_plain(field)]
    parts = F.struct(value.alias("value"), *kept)
    return groups.agg(parts.alias("parts")).scalar()["value"]


def _is_plain(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def largest(groups: DataFrame, value: str) -> Column:
    """The largest value, 1 where there is none."""
    return F.coalesce(over_groups(groups, F.max(value)), F.lit(1))


def group_sizes(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key in no order; null keys do not count."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))


def count_by_key(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key, largest first, ties by key; null keys do not count."""
    return group_sizes(df, key, name).orderBy(F.desc(name), key)


def sizes_and_total(df: DataFrame, key: str, name: str = "n") -> tuple[DataFrame, Column]:
    """``group_sizes``, and the number of all rows, those with a null key among them, out of
    the same grouping. The null group is told by a count, not by the key: a filter on the key
    would be pushed below the grouping, and the total would need a second one."""
    sizes = df.groupBy(key).agg(F.count("*").alias(name), F.count(key).alias("_keyed"))
    total = over_groups(sizes, F.sum(name))
    return sizes.filter(F.col("_keyed") > 0).drop("_keyed"), total


def count_with_share(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """``count_by_key`` with the share in percent of all rows, rows with a null key among them."""
    sizes, total = sizes_and_total(df, key, name)
    return sizes.withColumn("percentage", F.col(name) / total * 100).orderBy(F.desc(name), key)


def normalized_distribution(
    df: DataFrame, stratum_col: str, missing: str = "MISSING", name: str = "share"
) -> DataFrame:
    """Share of each stratum, null shown under its own name."""
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit(missing)).alias("stratum")
    sizes = df.groupBy(stratum).agg(F.count("*").alias("n"))
    total = over_groups(sizes, F.sum("n"))
    return sizes.select("stratum", "n", (F.col("n") / total).alias(name))


def time_bounds(
    df: DataFrame, ts_col: str, default_start: datetime, default_end: datetime
) -> DataFrame:
    """First and last time in one pass, the defaults where there is none."""
    dtype = df.schema[ts_col].dataType
    return df.agg(
        F.coalesce(F.min(ts_col), F.lit(default_start).cast(dtype)).alias("min_ts"),
        F.coalesce(F.max(ts_col), F.lit(default_end).cast(dtype)).alias("max_ts"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Number of nulls in every column, in one pass."""
    return df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns])


def dataset_summary(datasets: dict[str, DataFrame]) -> DataFrame:
    """Row count and column names of each dataset."""
    parts = [
        frame.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("dataset"),
            "row_count",
            F.lit(",".join(frame.columns)).alias("columns"),
        )
        for name, frame in datasets.items()
    ]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary


def status_counts(df: DataFrame, label_col: str = "llm_label") -> DataFrame:
    """Cached, new, retry and pending (new or retry) rows in one pass."""
    status = F.col("status")
    return split_by_status(df, label_col).agg(
        F.count_if(status == "cached").alias("cached"),
        F.count_if(status == "new").alias("new"),
        F.count_if(status == "retry").alias("retry"),
        F.count_if(status != "cached").alias("pending"),
    )


def label_pivot(
    df: DataFrame, key: str, label_col: str, labels: Sequence[str] = KNOWN_LABELS
) -> DataFrame:
    """Rows per key and label, one column per known label, 0 where there are none; rows
    without a key or a label do not count."""
    labeled = df.filter(F.col(key).isNotNull() & F.col(label_col).isNotNull())
    counts = [F.count_if(F.col(label_col) == label).alias(label) for label in labels]
    return labeled.groupBy(key).agg(*counts)


def _breakdown(df: DataFrame, key: str, label_col: str) -> DataFrame:
    labeled = df.filter(F.col(key).isNotNull() & F.col(label_col).isNotNull())
    counts = [F.count_if(F.col(label_col) == lb).alias(c) for lb, c in LABEL_COLUMNS.items()]
    return labeled.groupBy(key).agg(*counts, F.count("*").alias("total"))


def classification_breakdown(
    df: DataFrame, key: str, label_col: str, only_with_not_sufficient: bool = False
) -> DataFrame:
    """The four shown labels, the number of all labels, and the severity per key: the weighted
    sum of its label counts. With ``only_with_not_sufficient`` every severity is 0 as long as no
    row anywhere has that label."""
    counted = _breakdown(df, key, label_col)
    score = severity({label: F.col(LABEL_COLUMNS[label]) for label in SEVERITY_WEIGHTS})
    if only_with_not_sufficient:
        any_not_sufficient = over_groups(counted, F.max("not_sufficient"))
        score = F.when(any_not_sufficient > 0, score).otherwise(F.lit(0.0))
    return counted.withColumn("severity_score", score)


def severity_score(
    df: DataFrame, key: str, label_col: str, only_with_not_sufficient: bool = False
) -> DataFrame:
    """The severity alone."""
    breakdown = classification_breakdown(df, key, label_col, only_with_not_sufficient)
    return breakdown.select(key, "severity_score")


def overall_label_stats(df: DataFrame, label_col: str) -> DataFrame:
    """Number and share in percent of all rows for the four shown labels, one row each."""
    counts = [F.count_if(F.col(label_col) == lb).alias(c) for lb, c in LABEL_COLUMNS.items()]
    one_row = df.agg(F.count("*").alias("total"), *counts)
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.col(column).alias("n"))
            for label, column in LABEL_COLUMNS.items()
        ]
    )
    return one_row.select("total", F.inline(pairs)).select(
        "label", "n", (F.try_divide("n", "total") * 100).alias("percentage")
    )


def population_totals(
    df: DataFrame, total: str = "TOTAL", male: str = "MALE", female: str = "FEMALE"
) -> DataFrame:
    """Sums, the average cut to a whole number, and the largest district."""
    return df.agg(
        F.sum(total).alias("total"),
        F.sum(male).alias("male"),
        F.sum(female).alias("female"),
        F.avg(total).cast("bigint").alias("average"),
        F.max(total).alias("largest"),
    )


def last_wins_dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the last in the order given. An aggregate, not a window: copies of
    one key shrink to one row per task before the shuffle."""
    others = [name for name in df.columns if name not in keys]
    place = F.struct(*order_by)
    last = F.max_by(F.struct(*others), place) if others else F.max(place)
    kept = df.groupBy(*keys).agg(last.alias("_last"))
    return kept.select(*[n if n in keys else F.col(f"_last.{n}") for n in df.columns])


def relative_bins(
    df: DataFrame, value: str, cuts: Sequence[float] = FIFTH_BINS, name: str = "bin"
) -> DataFrame:
    """Adds the bin of each value relative to the largest one; 1 stands in for the largest
    where there are no values."""
    return df.withColumn(name, relative_bin(F.col(value), largest(df, value), cuts))


def coverage_counts(
    df: DataFrame, phone_col: str, lat_col: str = "latitude", lon_col: str = "longitude"
) -> DataFrame:
    """Rows, located rows and rows with a phone."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(has_coordinates(lat_col, lon_col)).alias("located"),
        F.count_if(F.col(phone_col) != "").alias("with_phone"),
    )


def order_by_time(df: DataFrame, ts_col: str, id_col: str) -> DataFrame:
    return df.orderBy(ts_col, id_col)


def guarded_take(
    df: DataFrame, ts_col: str, id_col: str, max_rows: int = 1000, force: bool = False
) -> DataFrame:
    """All rows in time order if there are at most ``max_rows``; more are refused, or, when
    forced, cut to the first. One row over the limit is enough to know, so nothing is counted
    in full."""
    if not force and df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows; narrow the range or force the limit")
    return df.orderBy(ts_col, id_col).limit(max_rows)


def top_k_by_count(df: DataFrame, key: str, k: int = 5, name: str = "n") -> DataFrame:
    """The k largest groups, ties by key."""
    return count_by_key(df, key, name).limit(k)


def top_k_rows(df: DataFrame, value: str, key: str, k: int = 5) -> DataFrame:
    """The k rows with the largest value, ties by key."""
    return df.orderBy(F.desc(value), key).limit(k)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    return df.orderBy(*order_by).limit(n)
