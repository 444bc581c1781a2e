"""What the plans must and must not hold."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from civicloom import queries as bound
from civicloom.operators.aggregate import severity_score
from civicloom.operators.annotate import lookup
from civicloom.operators.filters import filter_known_districts, filter_time_range
from civicloom.operators.join import enrich_coordinates, merge_labels_replace, merge_labels_upsert
from civicloom.plans.dashboard import issues_by_district
from civicloom.plans.labelling import fold_labels, label_range, read_labeled
from civicloom.queries.registry import Tables
from civicloom.session import spread
from civicloom.sources.files import exists
from civicloom.sources.html import extract_contacts, extract_html_tables
from civicloom.sources.snapshots import read_snapshot, write_snapshot

FOLDER = "/root/testdata/sf0.001"
WITH_PYTHON = {"annotate", "extract_contacts", "extract_hospital_contacts", "extract_html_rows",
               "extract_html_rows_implied",
               "annotate_resumed", "label_photos", "label_range", "read_complaints_csv_split", "lookup", "lookup_status"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(bound.queries()))
def test_no_cross_join_and_no_row_python(spark, name):
    text = plan(bound.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if name not in WITH_PYTHON:
        assert "Python" not in text and "InPandas" not in text


def test_time_range_reaches_the_scan(spark):
    events = Tables(spark, FOLDER).events
    text = plan(filter_time_range(events, datetime(2024, 1, 2), datetime(2024, 1, 3), "ts").select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


@pytest.mark.parametrize(
    "name, table, scans",
    [
        ("normalized_distribution", "documents", 1),
        ("count_with_share", "orders", 1),
        ("relative_bins", "orders", 1),
        ("incidents_by_district", "orders", 1),
        ("classification_by_district", "documents", 2),
        ("severity_ranking", "documents", 1),
    ],
)
def test_table_is_read_once(spark, name, table, scans):
    df = bound.queries()[name](spark, FOLDER)
    df.collect()
    final = plan(df)
    # A stage whose exchange is reused is printed once, where it ran.
    ran = [part.split("== Initial Plan ==")[0] for part in final.split("== Final Plan ==")[1:]]
    text = "".join(ran)
    assert "ReusedExchange" in text
    assert text.count(f"{table}.parquet") <= scans


def test_range_on_a_table_partitioned_by_day(spark, folder):
    events = Tables(spark, FOLDER).events
    write_snapshot(events.withColumn("day", F.to_date("ts")), folder, ("day",))
    table = read_snapshot(spark, folder)
    bounds = datetime(2024, 1, 2, 6), datetime(2024, 1, 3)
    chosen = filter_time_range(table, *bounds, "ts", "day")
    text = plan(chosen)
    assert "PartitionFilters: [isnotnull(day" in text and "day" in text
    assert chosen.count() == filter_time_range(events, *bounds, "ts").count() > 0


def test_rows_are_spread_only_where_asked(spark):
    pages = Tables(spark, FOLDER).pages
    assert "RoundRobinPartitioning(7)" in plan(spread(pages, 7))
    assert "Exchange" not in plan(spread(pages, None))


def test_contacts_are_read_without_a_shuffle(spark):
    pages = Tables(spark, FOLDER).pages
    for kind in ("stations", "hospitals"):
        assert "Exchange" not in plan(extract_contacts(extract_html_tables(pages), kind))


def test_large_sides_are_read_once(spark, folder):
    schema = "ticket_id string, name string, latitude double, longitude double, llm_label string, llm_reasoning string"
    spark.createDataFrame([("1", "a", None, None, None, None), (None, None, 1.0, 2.0, None, None)], schema).write.parquet(folder)
    table = spark.read.parquet(folder)
    labels = spark.createDataFrame([("1", "Sufficient", "r", 1)], "ticket_id string, llm_label string, llm_reasoning string, place int")
    places = spark.createDataFrame([("a", 5.0, 6.0)], "name string, latitude double, longitude double")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    for df in (
        merge_labels_replace(table, labels),
        merge_labels_upsert(table, labels, ["place"]),
        enrich_coordinates(table, places, "name"),
        lookup(table, lambda name: (5.0, 6.0), "name", pause=0, pause_between=0),
    ):
        assert plan(df).count(folder.rsplit("/", 1)[1]) == 1
        assert df.count() == 2
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    found = lookup(table, lambda name: (5.0, 6.0), "name", pause=0, pause_between=0, status_col="status")
    assert [tuple(r) for r in found.select("name", "latitude", "status").orderBy("name").collect()] == [
        (None, 1.0, None), ("a", 5.0, "found")]


def test_null_keys_are_spread(spark):
    rows = spark.range(1000).select(F.lit(None).cast("string").alias("ticket_id"), "id")
    labels = spark.createDataFrame([("1", "Sufficient", "r", 1)], "ticket_id string, llm_label string, llm_reasoning string, place int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        merged = merge_labels_upsert(rows, labels, ["place"])
        sizes = [r["n"] for r in merged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 4 and max(sizes) < 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nothing_runs_when_it_is_built(spark):
    t = Tables(spark, FOLDER)
    districts = t.nation.select(F.col("n_nationkey").cast("string").alias("amp_th"), F.col("n_name").alias("amp_en"))
    rows = t.supplier.select(F.col("s_nationkey").cast("string").alias("amp_th"), F.col("s_name").alias("amp_en"))
    labeled = t.documents.select("source", F.lit("API Error").alias("llm_label"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "built")
    try:
        filter_known_districts(rows, districts)
        issues_by_district(districts, rows, "amp_th")
        severity_score(labeled, "source", "llm_label", only_with_not_sufficient=True)
        assert len(tracker.getJobIdsForGroup("built")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_partitioned_write_makes_few_files(spark, folder):
    events = Tables(spark, FOLDER).events.withColumn("day", F.to_date("ts")).repartition(16)
    path = write_snapshot(events, folder, ("day",))
    days = events.select("day").distinct().count()
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert days <= files <= 2 * days


def _files(spark, path):
    return {(r["path"], r["modificationTime"]) for r in spark.read.format("binaryFile").option(
        "recursiveFileLookup", "true").load(path).select("path", "modificationTime").collect()}


def test_labelling_leaves_the_table_alone(spark, folder):
    rows = Tables(spark, FOLDER).events.select(
        F.col("event_id").cast("string").alias("ticket_id"), F.col("props").alias("comment"), "ts", F.to_date("ts").alias("day"))
    path = write_snapshot(rows, folder, ("day",))
    before = _files(spark, path)

    def answer(request):
        return "[]" if request.startswith("ask ") else "no prompt"

    day = datetime(2024, 1, 3)
    args = (spark, folder, answer)
    options = {"order_by": ["ts", "ticket_id"], "ts_col": "ts", "day_col": "day", "prompt": "ask ", "parallelism": 2}
    empty = label_range(*args, datetime(1999, 1, 1), datetime(1999, 1, 2), **options)
    assert empty.count() == rows.count() and _files(spark, path) == before and not exists(spark, f"{path}/_labels")
    table = label_range(*args, day, datetime(2024, 1, 4), **options)
    chosen = rows.filter(F.col("ts").between(day, datetime(2024, 1, 4))).count()
    assert table.count() == rows.count() and _files(spark, path) == before
    assert table.filter("llm_label = 'Missing in JSON Response'").count() == chosen > 0
    folded = fold_labels(spark, folder, day_col="day")
    assert folded.filter("llm_label = 'Missing in JSON Response'").count() == chosen
    assert read_labeled(spark, folder).count() == rows.count()


def test_labels_small_by_size_are_broadcast_without_a_shuffle_of_the_table(spark, folder):
    spark.range(50_000).select(
        F.col("id").cast("string").alias("ticket_id"), F.lit("x").alias("comment")
    ).write.parquet(folder)
    table = spark.read.parquet(folder)
    labels = table.limit(10).select(
        "ticket_id",
        F.lit("Sufficient").alias("llm_label"),
        F.lit("r").alias("llm_reasoning"),
        F.lit(1).alias("place"),
    )
    assert "Exchange hashpartitioning" not in plan(merge_labels_upsert(table, labels, ["place"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(merge_labels_upsert(table, labels, ["place"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
