import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicloom.operators.filters import resolve_column, trim_column_names
from civicloom.operators.join import merge_labels_upsert
from civicloom.schemas import COMPLAINTS, HOSPITALS, LABELED_COMPLAINTS
from civicloom.session import shared_folder
from civicloom.sources.files import claim, exists
from civicloom.sources.nested import read_api_envelope, read_feature_collection, rejected_bodies
from civicloom.sources.snapshots import (
    export_range_csv,
    latest_snapshot,
    list_snapshots,
    load_labeled,
    read_snapshot,
    write_snapshot,
)
from civicloom.sources.tables import (
    count_bad_records,
    read_complaints,
    read_complaints_csv,
    read_enriched_or_raw,
    read_reference_csv,
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_multi_line_csv(spark, tmp_path):
    head = ",".join(COMPLAINTS.names)
    path = write(tmp_path / "c.csv", head + '\nT1,น้ำ,,"two\nlines, ""quoted""",,,,,,2024-01-02 03:04:05,,4\n')
    row = read_complaints_csv(spark, path, COMPLAINTS).first()
    assert (row["ticket_id"], row["comment"], row["star"]) == ("T1", 'two\nlines, "quoted"', "4")


def test_reference_csv_with_mark_and_blanks(spark, tmp_path):
    path = write(tmp_path / "h.csv", "﻿ลำดับ , ชื่อสถานพยาบาล (Thai),Hospital Name (English),หมายเลขโทรศัพท์ (Telephone)\n1,ก,A,02\n")
    df = read_reference_csv(spark, path, HOSPITALS)
    assert df.columns == HOSPITALS.names and df.first()["Hospital Name (English)"] == "A"


def test_enriched_or_raw(spark, tmp_path):
    raw = write(tmp_path / "raw.csv", "a\nx\n")
    schema = StructType.fromDDL("a string")
    missing = str(tmp_path / "none.csv")
    assert read_enriched_or_raw(spark, missing, raw, schema).first().asDict() == {
        "a": "x", "latitude": None, "longitude": None}
    better = write(tmp_path / "better.csv", "a,latitude,longitude\nx,1.5,2.5\n")
    assert read_enriched_or_raw(spark, better, raw, schema).first()["latitude"] == 1.5
    with pytest.raises(FileNotFoundError):
        read_enriched_or_raw(spark, missing, missing, schema)


def test_read_complaints_needs_the_time(spark, folder):
    spark.range(1).write.parquet(folder)
    with pytest.raises(ValueError):
        read_complaints(spark, folder)


def test_trim_names_rejects_collision(spark):
    with pytest.raises(ValueError):
        trim_column_names(spark.createDataFrame([(1, 2)], ["a", "a "]))


def test_resolve_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["no", "Hospital (TH)", "full name"])
    assert resolve_column(df, "no") == "no"
    assert resolve_column(df, "x", ["name", "hospital"]) == "Hospital (TH)"
    assert resolve_column(df, "x", position=-1) == "full name"
    with pytest.raises(ValueError):
        resolve_column(df, "x")


def test_snapshot_can_be_replaced_from_itself(spark, folder):
    ids = "ticket_id string, llm_label string, llm_reasoning string"
    write_snapshot(spark.createDataFrame([(str(i), None, None) for i in range(2000)], ids), folder)
    for run in range(3):
        new = spark.createDataFrame([(str(run), "Sufficient", "r", 1)], ids + ", place int")
        write_snapshot(merge_labels_upsert(read_snapshot(spark, folder), new, ["place"]), folder)
    table = read_snapshot(spark, folder)
    assert table.count() == 2000
    assert table.filter("llm_label = 'Sufficient'").count() == 3
    assert latest_snapshot(spark, folder).endswith("snapshot=4")


def test_unfinished_snapshot_is_passed_over(spark, folder):
    write_snapshot(spark.range(3), folder)
    spark.range(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{folder}/snapshot=2")
    assert read_snapshot(spark, folder).count() == 3
    assert write_snapshot(spark.range(7), folder).endswith("snapshot=3")
    assert read_snapshot(spark, folder).count() == 7


def test_listing_and_loading_labeled(spark, tmp_path):
    assert load_labeled(spark, LABELED_COMPLAINTS, str(tmp_path / "none")).count() == 0
    import os
    head = "ticket_id,province,llm_label\n"
    write(tmp_path / "a.csv", head + "1,กรุงเทพมหานคร,Sufficient\n2,other,Sufficient\n")
    write(tmp_path / "b.csv", head + "3,กรุงเทพมหานคร,Sufficient\n")
    write(tmp_path / "b.txt", "x")
    os.utime(tmp_path / "b.csv", (1, 1))
    assert [row["name"] for row in list_snapshots(spark, str(tmp_path)).collect()] == ["a.csv", "b.csv"]
    schema = StructType.fromDDL("ticket_id string, province string, llm_label string")
    assert [row["ticket_id"] for row in load_labeled(spark, schema, str(tmp_path)).collect()] == ["1"]
    older = load_labeled(spark, schema, path=str(tmp_path / "b.csv"))
    assert [row["ticket_id"] for row in older.collect()] == ["3"]


def test_feature_collection(spark, tmp_path):
    document = {"features": [{"properties": {"amp_en": "Dusit", "amp_th": "ดุสิต"}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}]}
    path = write(tmp_path / "d.geojson", json.dumps(document, indent=2))
    row = read_feature_collection(spark, path).first()
    assert row["amp_th"] == "ดุสิต" and json.loads(row["geometry"])["coordinates"] == [1.5, 2]


def test_envelope(spark):
    bodies = [
        {"success": True, "result": {"total": 9, "records": [{"_id": 1, "more": 1}, {"_id": 2}]}},
        {"success": False, "result": {"total": 9, "records": [{"_id": 3}]}},
        {"success": True, "result": {"total": 0, "records": []}},
    ]
    df = spark.createDataFrame([(json.dumps(body),) for body in bodies] + [("oops",)], "body string")
    rows = read_api_envelope(df, StructType.fromDDL("_id long")).collect()
    assert [tuple(row) for row in rows] == [(1, 9, 2), (2, 9, 2)]
    assert sorted(r["reason"] for r in rejected_bodies(df, StructType.fromDDL("_id long")).collect()) == [
        "incomplete", "unreadable", "unsuccessful"]


def test_envelope_without_a_flag(spark):
    bodies = ['{"result": {"total": 1, "records": [{"_id": 1}]}}', '{"result": {"total": 1}}', None, "[1]"]
    df = spark.createDataFrame([(body,) for body in bodies], "body string")
    schema = StructType.fromDDL("_id long")
    assert [tuple(row) for row in read_api_envelope(df, schema).collect()] == [(1, 1, 1)]
    assert read_api_envelope(df, schema, need_success=True).collect() == []
    assert sorted(r["reason"] for r in rejected_bodies(df, schema).collect()) == ["no records", "null", "unreadable"]
    assert "no flag" in [r["reason"] for r in rejected_bodies(df, schema, need_success=True).collect()]


def test_columns_go_by_their_names(spark, tmp_path):
    schema = StructType.fromDDL("ticket_id string, type string, star int")
    path = write(tmp_path / "c.csv", "star,ticket_id,comment, type \n3,T1,broken lamp,light\nx,T2,no,water\n")
    df = read_complaints_csv(spark, path, schema, "bad")
    assert df.columns == ["ticket_id", "type", "star", "comment", "bad"]
    assert [tuple(r)[:4] for r in df.collect()] == [("T1", "light", 3, "broken lamp"), ("T2", "water", None, "no")]
    assert tuple(count_bad_records(df, "bad").first()) == (2, 1)
    with pytest.raises(ValueError):
        read_complaints_csv(spark, write(tmp_path / "d.csv", "ticket_id,type\nT1,x\n"), schema)
    with pytest.raises(ValueError):
        read_complaints_csv(spark, write(tmp_path / "e.csv", "ticket_id,type,star, type\nT1,x,1,y\n"), schema)


def test_files_of_a_folder_must_agree(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", "a,b\n1,2\n")
    write(tmp_path / "in" / "b.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_reference_csv(spark, str(tmp_path / "in"), StructType.fromDDL("a string, b string")).collect()


def test_an_export_is_never_overwritten(spark, folder):
    rows = spark.createDataFrame([("1",), ("2",)], "id string")
    day = date(2024, 1, 1)
    first = export_range_csv(rows, folder, day, day)
    again = read_complaints_csv(spark, first, rows.schema)
    second = export_range_csv(again, folder, day, day)
    assert first.endswith("_01012024_01012024.csv") and second.endswith("_01012024_01012024.v2.csv")
    assert read_complaints_csv(spark, second, rows.schema).count() == again.count() == 2
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").csv(f"{folder}/unfinished.csv", header=True)
    assert [r["path"] for r in list_snapshots(spark, folder).collect()] == [second, first]
    with pytest.raises(FileNotFoundError):
        load_labeled(spark, rows.schema, path=f"{folder}/none.csv")


def test_two_writers_share_no_number(spark, folder):
    assert claim(spark, f"{folder}/_claims/snapshot=1") and not claim(spark, f"{folder}/_claims/snapshot=1")
    assert write_snapshot(spark.range(3), folder).endswith("snapshot=2")


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark).startswith(named)
    assert not exists(spark, shared_folder(spark) + "/nothing")
