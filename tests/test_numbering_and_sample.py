import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from civicloom.operators.filters import ensure_columns
from civicloom.operators.numbering import assign_batches, number_rows
from civicloom.operators.sample import stratified_sample_exact, stratified_split


def test_numbers_with_one_hot_time_stamp(spark):
    rows = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 != 0, F.lit(7)).otherwise(F.col("id")).alias("ts")
    ).repartition(7)
    numbered = number_rows(rows, ["ts", "id"], "n").collect()
    expected = sorted((row["ts"], row["id"]) for row in numbered)
    assert [(r["ts"], r["id"]) for r in sorted(numbered, key=lambda r: r["n"])] == expected
    assert sorted(r["n"] for r in numbered) == list(range(1, 5001))


def test_batches(spark):
    rows = assign_batches(spark.range(45).repartition(3), ["id"], 20).collect()
    for row in rows:
        assert (row["batch_num"], row["pos"]) == (row["id"] // 20 + 1, row["id"] % 20 + 1)
    assert assign_batches(spark.range(0), ["id"]).collect() == []
    with pytest.raises(ValueError):
        assign_batches(spark.range(1), ["id"], 0)


def test_ensure_columns(spark):
    rows = ensure_columns(spark.createDataFrame([("b",), ("a",)], "x string"), ["x"]).collect()
    assert {r["x"]: (r["ticket_id"], r["type"]) for r in rows} == {
        "a": ("ticket_0", "ไม่ระบุ"), "b": ("ticket_1", "ไม่ระบุ")}


def by_hand(rows, n, seed):
    sizes = Counter(stratum for _, stratum in rows)
    total = len(rows)
    quota = {s: n * c // total for s, c in sizes.items()}
    order = sorted(sizes, key=lambda s: (-(n * sizes[s] % total), s))
    for stratum in order[: n - sum(quota.values())]:
        quota[stratum] += 1
    picked = set()
    for stratum in sizes:
        ids = sorted((i for i, s in rows if s == stratum),
                     key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))
        picked.update(ids[: quota[stratum]])
    return picked


@pytest.fixture
def strata(spark):
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 10 < 6, "hot").when(F.col("id") % 10 < 9, F.concat(F.lit("s"), F.col("id") % 7)).alias("star"),
    )


@pytest.mark.parametrize("n", [40, 777, 2990])
def test_sample_is_exact(strata, n):
    rows = [(r["id"], r["star"] or "MISSING") for r in strata.collect()]
    got = {r["id"] for r in stratified_sample_exact(strata, n, "star", "id", 42).collect()}
    assert got == by_hand(rows, n, 42)


def test_split_keeps_all_rows(strata):
    rows = [(r["id"], r["star"] or "MISSING") for r in strata.collect()]
    parts = stratified_split(strata, 500, "star", "id", 1).collect()
    assert len(parts) == 3000
    assert {r["id"] for r in parts if r["in_first"]} == by_hand(rows, 500, 1)


@pytest.mark.parametrize("n", [0, 3000, 5000, 3])
def test_sample_rejects(strata, n):
    with pytest.raises(ValueError):
        stratified_sample_exact(strata, n, "star", "id")


def test_sample_rejects_rows_without_id(strata):
    unnamed = strata.withColumn("id", F.when(F.col("id") > 9, F.col("id")))
    with pytest.raises(ValueError, match="no id"):
        stratified_sample_exact(unnamed, 100, "star", "id")


def test_sample_rejects_single_row_stratum(strata):
    lonely = strata.withColumn("star", F.when(F.col("id") == 5, "alone").otherwise(F.col("star")))
    with pytest.raises(ValueError, match="fewer than two"):
        stratified_sample_exact(lonely, 100, "star", "id")
