"""Open cases in response times, the rate of look-ups, and shares of many strata."""

import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from civicloom.operators import response
from civicloom.operators.annotate import lookup
from civicloom.operators.response import closing_day_series, open_and_closed_times
from civicloom.operators.sample import quotas

NOW = datetime(2024, 3, 1)
CASES = "place string, began timestamp, ended timestamp"


def product_limit(cases):
    """Exact: closed, open, median, p90, mean to the longest, share open, of (seconds, closed)."""
    open_, since, mean, found = Fraction(1), 0, Fraction(0), {}
    for t in sorted({s for s, _ in cases}):
        at_risk = sum(s >= t for s, _ in cases)
        ends = sum(s == t and closed for s, closed in cases)
        mean += (t - since) * open_
        since, open_ = t, open_ * Fraction(at_risk - ends, at_risk)
        for share in (Fraction(1, 2), Fraction(9, 10)):
            if open_ <= 1 - share:
                found.setdefault(share, t)
    closed = sum(c for _, c in cases)
    return closed, len(cases) - closed, found.get(Fraction(1, 2)), found.get(Fraction(9, 10)), float(mean), float(open_)


@pytest.mark.parametrize("block", [1, 3, 86_400])
def test_open_cases_by_the_product_limit(spark, block, monkeypatch):
    monkeypatch.setattr(response, "SECONDS_PER_BLOCK", block)
    rng = random.Random(block)
    rows, want = [], {}
    for place in ["a", "b", "c", "d", None]:
        for _ in range(rng.choice([1, 4, 30])):
            age = rng.randint(0, 12)
            length = rng.choice([None, rng.randint(0, 15)])
            began = NOW - timedelta(seconds=age)
            rows.append((place, began, None if length is None else began + timedelta(seconds=length)))
            closed = length is not None and length <= age
            want.setdefault(place, []).append((length if closed else age, closed))
    rows += [("a", NOW + timedelta(seconds=5), None), ("a", NOW, NOW - timedelta(seconds=1)), ("a", None, NOW)]
    df = spark.createDataFrame(rows, CASES).withColumn("now", F.lit(NOW))
    for row in open_and_closed_times(df, "place", "began", "ended", "now").collect():
        closed, open_, median, p90, mean, left = product_limit(want.pop(row["place"]))
        assert (row["n_closed"], row["n_open"]) == (closed, open_)
        for name, value in (("median_hours", median), ("p90_hours", p90)):
            assert row[name] == (None if value is None else pytest.approx(value / 3600))
        assert row["mean_to_longest_hours"] == pytest.approx(mean / 3600)
        assert row["still_open"] == pytest.approx(left, abs=1e-9)
    assert want == {}


def test_a_forecast_uses_earlier_days_only(spark):
    day = datetime(2024, 1, 1)
    rows = [("a", day, day + timedelta(days=1)), ("a", day, day + timedelta(days=3)), ("a", day, day + timedelta(days=3)),
            ("a", day, day + timedelta(days=12)), ("a", day, day - timedelta(days=1)), ("a", day, None)]
    found = closing_day_series(spark.createDataFrame(rows, CASES), "place", "began", "ended", unit="days")
    assert [tuple(r)[2:] for r in found.orderBy("day").collect()] == [
        (1, 1.0, None, None), (2, 3.0, 1.0, 2.0), (1, 12.0, None, None)]


def test_all_tasks_share_one_rate(spark, tmp_path):
    noted = str(tmp_path / "calls")

    def ask(name):
        import time

        with open(noted, "a") as out:
            out.write(f"{time.time()}\n")
        if name == "n3":
            raise TimeoutError
        return 1.0, 2.0

    rows = spark.createDataFrame([(f"n{k}", None, None) for k in range(30)], "name string, latitude double, longitude double")
    found = lookup(rows, ask, "name", pause=0.01, pause_between=0.1, parallelism=16, status_col="status").collect()
    assert sorted(r["status"] for r in found) == ["failed"] + ["found"] * 29
    times = sorted(float(line) for line in open(noted))
    assert len(times) == 32
    assert max(sum(begin <= t < begin + 1 for t in times) for begin in times) <= 11


def test_shares_of_many_strata_are_not_ranked_in_one_task(spark):
    rng = random.Random(3)
    sizes = {f"s{k:05d}": rng.choice([2, 2, 3, 7]) for k in range(3000)}
    n, total = 5000, sum(sizes.values())
    df = spark.createDataFrame(list(sizes.items()), "_stratum string, _size long")
    found = quotas(df, n)
    whole = {s: size * n // total for s, size in sizes.items()}
    order = sorted(sizes, key=lambda s: (-(sizes[s] * n % total), s))
    want = {s: whole[s] + (place < n - sum(whole.values())) for place, s in enumerate(order)}
    assert {r["_stratum"]: r["_quota"] for r in found.collect()} == want
    # The only window runs over one row per sort task.
    text = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert all("_rows" in line for line in text.split("\n") if " Window " in line)
