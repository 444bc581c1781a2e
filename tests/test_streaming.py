from datetime import datetime

from pyspark.sql.types import StructType

from civicloom.streaming.jobs import newest_counts, read_stream, stream_clean_ingest, stream_counts

SCHEMA = StructType().add("comment", "string").add("timestamp", "string")


def test_ingest_reads_each_file_once(spark, folder):
    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        stream = read_stream(spark, f"{folder}/in", SCHEMA, max_files_per_trigger=1)
        stream_clean_ingest(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
        rows = spark.read.parquet(f"{folder}/out").collect()
        return sorted((row["comment"], row["timestamp"]) for row in rows)

    first = [("a, b", datetime(2024, 1, 1)), ("ไฟดับ", datetime(2024, 1, 2))]
    land([("a, b", "2024-01-01"), ("ไฟ🔥ดับ", "2024-01-02")])
    assert run() == [("a b", first[0][1]), first[1]]
    assert len(run()) == 2
    land([("c!", "2024-01-03")])
    assert [text for text, _ in run()] == ["a b", "c", "ไฟดับ"]


def test_late_rows_are_dropped(spark, folder):
    schema = StructType.fromDDL("ts timestamp, kind string")

    def feed(*rows):
        frame = spark.createDataFrame([(datetime(2024, 1, 1, h, m), "k") for h, m in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = read_stream(spark, f"{folder}/in", schema)
        stream_counts(stream, f"{folder}/out", f"{folder}/state", "ts", "kind").awaitTermination()
        found = newest_counts(spark, f"{folder}/out", "kind").collect()
        return {row["window_start"].hour: row["n"] for row in found}

    assert feed((1, 5), (1, 50), (4, 0)) == {1: 2, 4: 1}
    assert feed((1, 10), (3, 30), (7, 0)) == {1: 2, 3: 1, 4: 1, 7: 1}
    assert feed((7, 10)) == {1: 2, 3: 1, 4: 1, 7: 2}
