import pytest

from civicloom.operators.annotate import lookup
from civicloom.operators.join import (
    attach_feature_stats,
    district_two_key_lookup,
    enrich_coordinates,
    merge_labels_replace,
    merge_labels_upsert,
)
from civicloom.operators.aggregate import status_counts

TABLE = [
    ("out", "Sufficient", "old"),
    ("err", "API Error", "old"),
    ("new", None, None),
    ("two", None, None),
    (None, None, None),
]
LABELS = [
    ("err", "Not Sufficient", "now", 1),
    ("new", "Sufficient", "now", 2),
    ("two", "Sufficient", "now", 3),
    ("two", "API Error", "later", 4),
    (None, "Sufficient", "now", 5),
]
COLUMNS = "ticket_id string, llm_label string, llm_reasoning string"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(TABLE, COLUMNS)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(LABELS, COLUMNS + ", place int")


def test_status(table):
    assert status_counts(table).first().asDict() == {"cached": 1, "new": 3, "retry": 1, "pending": 4}
    assert status_counts(table.drop("llm_label")).first()["new"] == 5


def test_replace_is_what_the_old_merge_did(table, labels):
    rows = [(r["ticket_id"], r["llm_label"]) for r in merge_labels_replace(table, labels).collect()]
    assert sorted(rows, key=str) == sorted(
        [("out", None), ("err", "Not Sufficient"), ("new", "Sufficient"), ("two", "Sufficient"),
         ("two", "API Error"), (None, None)], key=str)


def test_upsert_keeps_rows_and_earlier_labels(table, labels):
    rows = merge_labels_upsert(table, labels, ["place"]).collect()
    assert {r["ticket_id"]: (r["llm_label"], r["llm_reasoning"]) for r in rows} == {
        "out": ("Sufficient", "old"), "err": ("Not Sufficient", "now"), "new": ("Sufficient", "now"),
        "two": ("API Error", "later"), None: (None, None)}
    assert len(rows) == len(TABLE)


def test_upsert_without_earlier_labels(table, labels):
    bare = table.select("ticket_id")
    rows = merge_labels_upsert(bare, labels, ["place"]).collect()
    assert {r["ticket_id"]: r["llm_label"] for r in rows}["new"] == "Sufficient"


def test_two_keys(spark):
    districts = spark.createDataFrame([("ก", "A"), ("ข", "B"), ("ค", "C"), ("ง", "D")], "amp_th string, amp_en string")
    stats = spark.createDataFrame([("A", 0), ("ก", 3), ("B", 2), ("ข", 9), ("ค", 4)], "name string, n long")

    def values(**how):
        rows = district_two_key_lookup(districts, stats, "name", ["n"], **how).collect()
        return {row["amp_en"]: row["n"] for row in rows}

    assert values(zero_falls_through=True) == {"A": 3, "B": 2, "C": 4, "D": 0}
    assert values() == {"A": 0, "B": 2, "C": 4, "D": 0}


PLACES = "id int, name string, latitude double, longitude double"


def test_enrich(spark):
    rows = [(1, "a", 1.0, 2.0), (2, "a", None, None), (3, "b", 5.0, None), (4, "zz", 6.0, None),
            (5, " ", None, None), (6, None, None, None)]
    names = [(0, "a", 7.0, 8.0), (0, "b", 9.0, 10.0), (0, "b", 9.0, 11.0), (0, "c", None, 1.0)]
    filled = enrich_coordinates(spark.createDataFrame(rows, PLACES), spark.createDataFrame(names, PLACES), "name")
    assert {r["id"]: (r["latitude"], r["longitude"]) for r in filled.collect()} == {
        1: (1.0, 2.0), 2: (7.0, 8.0), 3: (9.0, 10.0), 4: (6.0, None), 5: (None, None), 6: (None, None)}


def test_lookup_asks_once_per_name_and_tries_again(spark, tmp_path):
    log = str(tmp_path / "asked")

    def fn(name):
        with open(log, "a") as out:
            out.write(name + "\n")
        if name == "down":
            raise TimeoutError
        return None if name == "unknown" else (1.0, 2.0)

    rows = [(i, name, None, None) for i, name in enumerate(["x"] * 50 + ["down"] * 3 + ["unknown"] * 4 + [""])]
    found = lookup(spark.createDataFrame(rows, PLACES), fn, "name", pause=0, pause_between=0).collect()
    assert len(found) == len(rows)
    assert sum(row["latitude"] == 1.0 for row in found) == 50
    asked = open(log).read().split()
    assert {name: asked.count(name) for name in set(asked)} == {"x": 1, "down": 3, "unknown": 1}


