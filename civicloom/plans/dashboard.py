"""The district figures behind the dashboard's maps, one row per district."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.functions.numbers import percent_1dp, relative_bin
from civicloom.operators.aggregate import (
    classification_breakdown,
    group_sizes,
    largest,
    last_wins_dedupe,
    over_groups,
)
from civicloom.operators.join import district_two_key_lookup, district_zero_fill
from civicloom.schemas import FIFTH_BINS, QUARTER_BINS


def incidents_by_district(
    districts: DataFrame, incidents: DataFrame, district_col: str = "District"
) -> DataFrame:
    """Incidents under the English name or, where that gives 0, the Thai one, and their bin
    against the largest count of all incidents."""
    counts = group_sizes(incidents, district_col, "incidents")
    matched = district_two_key_lookup(
        districts, counts, district_col, ["incidents"], zero_falls_through=True
    )
    bins = relative_bin(F.col("incidents"), largest(counts, "incidents"), QUARTER_BINS)
    return matched.withColumn("bin", bins)


def population_by_district(
    districts: DataFrame,
    population: DataFrame,
    order_by: Sequence[str],
    district_col: str = "DISTRICT",
) -> DataFrame:
    """Total, male and female residents; a district listed twice counts with its later row."""
    rows = population.select(
        district_col,
        F.col("TOTAL").alias("total"),
        F.col("MALE").alias("male"),
        F.col("FEMALE").alias("female"),
        *order_by,
    )
    unique = last_wins_dedupe(rows, [district_col], order_by)
    matched = district_two_key_lookup(
        districts, unique, district_col, ["total", "male", "female"]
    )
    bins = relative_bin(F.col("total"), largest(population, "TOTAL"), QUARTER_BINS)
    return matched.withColumn("bin", bins)


def issues_by_district(
    districts: DataFrame, complaints: DataFrame, district_col: str, name_col: str = "amp_th"
) -> DataFrame:
    """Complaints per district, their share of all complaints, and the bin. The share is worked
    out once and printed from its column; nothing runs until the rows are asked for."""
    counts = complaints.groupBy(district_col).agg(F.count("*").alias("total_issues"))
    total = over_groups(counts, F.sum("total_issues"))
    most = over_groups(counts, F.max(F.when(F.col(district_col).isNotNull(), F.col("total_issues"))))
    sizes = counts.filter(F.col(district_col).isNotNull())
    filled = district_zero_fill(districts, sizes, name_col, district_col, ["total_issues"])
    share = F.coalesce(F.try_divide(F.col("total_issues"), total) * 100, F.lit(0.0))
    return (
        filled.withColumns({"percentage": share, "_most": F.coalesce(most, F.lit(1))})
        .withColumn("percentage_text", percent_1dp(F.col("percentage")))
        .withColumn("bin", relative_bin(F.col("total_issues"), F.col("_most"), FIFTH_BINS))
        .drop("_most")
    )


def classification_by_district(
    districts: DataFrame,
    complaints: DataFrame,
    district_col: str,
    label_col: str = "llm_label",
    name_col: str = "amp_th",
    only_with_not_sufficient: bool = False,
) -> DataFrame:
    """Label counts, severity and its bin."""
    counted = classification_breakdown(
        complaints, district_col, label_col, only_with_not_sufficient
    )
    values = [name for name in counted.columns if name != district_col]
    filled = district_zero_fill(districts, counted, name_col, district_col, values)
    bins = relative_bin(F.col("severity_score"), largest(counted, "severity_score"), FIFTH_BINS)
    return filled.withColumn("bin", bins)
