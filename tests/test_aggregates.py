from datetime import datetime

import pytest
from pyspark.sql import functions as F

from civicloom.operators.aggregate import (
    classification_breakdown,
    count_by_key,
    count_with_share,
    guarded_take,
    last_wins_dedupe,
    population_totals,
    relative_bins,
    severity_score,
    time_bounds,
)
from civicloom.operators.response import daily_response_series, response_time_by_group
from civicloom.plans.dashboard import (
    classification_by_district,
    issues_by_district,
    population_by_district,
)
from civicloom.schemas import district_dimension


def test_share_counts_rows_without_a_district(spark):
    rows = spark.createDataFrame([("X",), ("X",), ("Y",), (None,)], "district string")
    got = [tuple(row) for row in count_with_share(rows, "district").collect()]
    assert got == [("X", 2, 50.0), ("Y", 1, 25.0)]
    assert [row["district"] for row in count_by_key(rows, "district").collect()] == ["X", "Y"]


LABELS = ["Not Sufficient"] * 2 + ["API Error", "Uncertain (has partial evidence)", "Sufficient",
                                   "Missing in JSON Response"]


def test_severity(spark):
    rows = spark.createDataFrame([("d", label) for label in LABELS] + [("d", None)], "k string, label string")
    row = classification_breakdown(rows, "k", "label").first()
    assert (row["severity_score"], row["total"], row["not_sufficient"]) == (10.5, 6, 2)


def test_severity_without_not_sufficient(spark):
    rows = spark.createDataFrame([("d", "API Error")] * 3, "k string, label string")
    assert severity_score(rows, "k", "label").first()["severity_score"] == 7.5
    guarded = severity_score(rows, "k", "label", only_with_not_sufficient=True)
    assert guarded.first()["severity_score"] == 0.0


def test_bins_of_nothing_and_of_zeros(spark):
    assert relative_bins(spark.createDataFrame([], "n long"), "n").collect() == []
    zeros = relative_bins(spark.createDataFrame([(0,), (0,)], "n long"), "n").collect()
    assert [row["bin"] for row in zeros] == [0, 0]


def test_districts_without_complaints(spark):
    districts = district_dimension(spark)
    rows = spark.createDataFrame([], "district string, llm_label string")
    issues = issues_by_district(districts, rows, "district").collect()
    assert len(issues) == 50
    assert {(r["total_issues"], r["percentage"], r["percentage_text"], r["bin"]) for r in issues} == {
        (0, 0.0, "0.0%", 0)}
    classes = classification_by_district(districts, rows, "district").collect()
    assert {(r["total"], r["severity_score"], r["bin"]) for r in classes} == {(0, 0.0, 0)}


def test_population(spark):
    rows = spark.createDataFrame(
        [("Dusit", 5, 2, 3, 1), ("Dusit", 8, 4, 4, 2), ("พระนคร", 11, 5, 6, 3)],
        "DISTRICT string, TOTAL long, MALE long, FEMALE long, place int")
    totals = population_totals(rows).first()
    assert (totals["total"], totals["average"], totals["largest"]) == (24, 8, 11)
    found = population_by_district(district_dimension(spark), rows, ["place"])
    by_name = {r["amp_en"]: (r["total"], r["male"], r["bin"]) for r in found.collect()}
    assert by_name["Dusit"] == (8, 4, 3) and by_name["Phra Nakhon"] == (11, 5, 4)
    assert by_name["Bang Bon"] == (0, 0, 0) and len(by_name) == 50
    cut = spark.createDataFrame([("a", 7, 0, 0), ("b", 8, 0, 0)], "DISTRICT string, TOTAL long, MALE long, FEMALE long")
    assert population_totals(cut).first()["average"] == 7


def test_last_wins(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 3, None), ("a", 2, "x"), (None, 1, "n")], "k string, t int, v string")
    got = {row["k"]: (row["t"], row["v"]) for row in last_wins_dedupe(rows, ["k"], ["t"]).collect()}
    assert got == {"a": (3, None), None: (1, "n")}


def test_guarded_take(spark):
    rows = spark.range(30).select(F.col("id"), F.timestamp_seconds(F.lit(100) - F.col("id")).alias("ts"))
    assert guarded_take(rows, "ts", "id", 30).count() == 30
    with pytest.raises(ValueError):
        guarded_take(rows, "ts", "id", 29)
    first = guarded_take(rows, "ts", "id", 3, force=True).collect()
    assert [row["id"] for row in first] == [29, 28, 27]


def test_time_bounds_defaults(spark):
    row = time_bounds(spark.createDataFrame([], "ts timestamp"), "ts", datetime(2023, 1, 1), datetime(2023, 2, 1)).first()
    assert (row["min_ts"], row["max_ts"]) == (datetime(2023, 1, 1), datetime(2023, 2, 1))


def test_response_times(spark):
    rows = spark.createDataFrame(
        [("a", f"2024-01-0{s}", f"2024-01-{e:02d}") for s, e in ((1, 1), (1, 3), (2, 12), (9, 2))]
        + [("b", "2024-01-05", "2024-01-01"), ("c", "2024-01-05", None)], "g string, s string, e string"
    ).select("g", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    got = {row["g"]: row for row in response_time_by_group(rows, "g", "s", "e", unit="days").collect()}
    a, b = got["a"], got["b"]
    assert (a["n_all"], a["n_negative"], a["n"], a["mean_days"], a["median_days"]) == (4, 1, 3, 4.0, 2.0)
    assert a["p90_days"] == pytest.approx(8.4)
    assert (b["n_all"], b["n_negative"], b["n"], b["mean_days"], b["median_days"]) == (1, 1, 0, None, None)
    daily = daily_response_series(rows, "g", "s", "e", unit="days").orderBy("g", "day").collect()
    assert [(str(r["day"]), r["n"], r["mean_days"], r["trailing_mean_days"]) for r in daily] == [
        ("2024-01-01", 2, 1.0, 1.0), ("2024-01-02", 1, 10.0, 4.0)]


def test_response_times_know_the_time_of_day(spark):
    rows = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 23), datetime(2024, 1, 1, 1)), ("a", datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 23))],
        "g string, s timestamp, e timestamp")
    row = response_time_by_group(rows, "g", "s", "e").first()
    assert (row["n_all"], row["n_negative"], row["n"], row["mean_hours"]) == (2, 1, 1, 22.0)


def test_a_null_has_no_bin(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 0), ("c", None)], "k string, v long")
    assert {r["k"]: r["bin"] for r in relative_bins(rows, "v").collect()} == {"a": 5, "b": 0, "c": None}
