"""Tables changed by several writers, streams into them, and answers kept while they come."""

import os
import random
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicloom.operators.annotate import label_rows
from civicloom.operators.journal import compact_journal, read_journal
from civicloom.plans.labelling import (
    fold_labels,
    label_range,
    labeled_state,
    read_labeled,
    read_state,
    write_labels,
)
from civicloom.plans.loading import load_complaints
from civicloom.sources.files import put_if_absent, read_text
from civicloom.sources.manifests import Conflict, Manifest, commit, read_manifest
from civicloom.sources.snapshots import (
    append_batch,
    compact,
    read_snapshot,
    remove_unused,
    write_snapshot,
)
from civicloom.streaming.jobs import read_stream, stream_into_table

ROWS = "ticket_id string, comment string, timestamp timestamp, llm_label string, llm_reasoning string"


def complaints(spark, n, begin=0):
    rows = [(str(k), f"text {k}", datetime(2024, 1, 1 + k % 4, 12), None, None) for k in range(begin, begin + n)]
    return spark.createDataFrame(rows, ROWS).withColumn("day", F.col("timestamp").cast("date"))


def run_of(spark, ids, label):
    rows = [(i, label, "r", 1, n) for n, i in enumerate(ids)]
    return spark.createDataFrame(
        rows, "ticket_id string, llm_label string, llm_reasoning string, batch_num bigint, pos int")


def labels_of(df):
    return {r["ticket_id"]: r["llm_label"] for r in df.collect()}


def test_a_file_is_put_once(spark, folder):
    assert put_if_absent(spark, f"{folder}/a", "ไฟ")
    assert not put_if_absent(spark, f"{folder}/a", "other")
    assert read_text(spark, f"{folder}/a") == "ไฟ"


def test_changes_of_many_threads_all_count(spark, folder):
    def add(name):
        commit(spark, folder, lambda now: Manifest(0, now.snapshot, (*now.parts, name), now.held, now.done))

    threads = [threading.Thread(target=add, args=(f"p{k}",)) for k in range(12)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    found = read_manifest(spark, folder)
    assert sorted(found.parts) == sorted(f"p{k}" for k in range(12)) and found.version == 12


def test_labels_that_come_while_folding_stay(spark, folder):
    write_snapshot(complaints(spark, 8), folder, ("day",))
    write_labels(run_of(spark, ["0", "1"], "Sufficient"), folder)
    state = labeled_state(spark, folder)
    folded = read_state(spark, folder, state)
    write_labels(run_of(spark, ["1", "2"], "Not Sufficient"), folder)
    write_snapshot(folded, folder, ("day",), holds=state.runs, base=state.manifest)
    want = {str(k): None for k in range(8)} | {"0": "Sufficient", "1": "Not Sufficient", "2": "Not Sufficient"}
    assert labels_of(read_labeled(spark, folder)) == want
    assert len(labeled_state(spark, folder).runs) == 1
    assert labels_of(fold_labels(spark, folder, day_col="day")) == want
    assert labeled_state(spark, folder).runs == () and remove_unused(spark, folder)
    assert labels_of(read_labeled(spark, folder)) == want and read_manifest(spark, folder).held == ()


def test_a_fold_of_a_table_that_was_replaced_begins_again(spark, folder):
    write_snapshot(complaints(spark, 4), folder)
    write_labels(run_of(spark, ["0"], "Sufficient"), folder)
    state = labeled_state(spark, folder)
    write_snapshot(complaints(spark, 6), folder)
    with pytest.raises(Conflict):
        write_snapshot(read_state(spark, folder, state), folder, holds=state.runs, base=state.manifest)
    assert read_snapshot(spark, folder).count() == 6
    assert labels_of(fold_labels(spark, folder))["0"] == "Sufficient"


def test_only_days_with_labels_are_joined(spark, folder):
    write_snapshot(complaints(spark, 8), folder, ("day",))
    write_labels(run_of(spark, ["0", "4"], "Sufficient"), folder, ["2024-01-01"])
    merged = read_labeled(spark, folder, day_col="day")
    labeled = {"0": "Sufficient", "4": "Sufficient"}
    assert labels_of(merged) == {str(k): labeled.get(str(k)) for k in range(8)}
    text = merged._jdf.queryExecution().toString()
    assert "PartitionFilters: [cast(day" in text or "PartitionFilters: [isnotnull(day" in text or "day#" in text
    # A run that does not say its days makes all days be joined.
    write_labels(run_of(spark, ["1"], "Sufficient"), folder)
    assert labels_of(read_labeled(spark, folder, day_col="day"))["1"] == "Sufficient"


def test_appended_batches_count_once_and_outlive_a_compaction(spark, folder):
    write_snapshot(complaints(spark, 4), folder)
    assert append_batch(complaints(spark, 2, 10), folder, "s", 0)
    assert not append_batch(complaints(spark, 2, 10), folder, "s", 0)
    base = read_manifest(spark, folder)
    rows = read_snapshot(spark, folder)
    assert append_batch(complaints(spark, 3, 20), folder, "s", 1)
    write_snapshot(rows, folder, base=base)
    assert read_snapshot(spark, folder).count() == 9 and len(read_manifest(spark, folder).parts) == 1
    compact(spark, folder)
    assert read_snapshot(spark, folder).count() == 9 and read_manifest(spark, folder).parts == ()
    assert not append_batch(complaints(spark, 3, 20), folder, "s", 1)
    assert read_snapshot(spark, folder).count() == 9


def test_a_load_and_a_stream_fill_one_table(spark, folder):
    schema = StructType.fromDDL("ticket_id string, comment string, timestamp string")
    spark.createDataFrame([("a", "x, y", "2024-01-01 10:00:00")], schema).coalesce(1).write.csv(f"{folder}/csv", header=True)
    root = f"{folder}/table"
    load_complaints(spark, f"{folder}/csv", root, schema, day_col="day")

    def feed(rows, compact_after=32):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = read_stream(spark, f"{folder}/in", schema, max_files_per_trigger=1)
        stream_into_table(stream, root, f"{folder}/state", "feed", day_col="day", compact_after=compact_after).awaitTermination()
        return sorted((r["ticket_id"], r["comment"]) for r in read_snapshot(spark, root).collect())

    assert feed([("b", "ไฟ🔥ดับ", "2024-01-02 10:00:00")]) == [("a", "x y"), ("b", "ไฟดับ")]
    label_range(spark, root, lambda text: "[]", datetime(2024, 1, 1), datetime(2024, 1, 3), ["ticket_id"], day_col="day")
    assert feed([("c", "!", "2024-01-03 10:00:00")], 1)[-1] == ("c", "")
    assert read_manifest(spark, root).parts == () and read_manifest(spark, root).done == {"feed": 1}
    assert {r["llm_label"] for r in read_labeled(spark, root, day_col="day").where("ticket_id <> 'c'").collect()} == {
        "Missing in JSON Response"}


def asked_rows(spark, n=50):
    return spark.createDataFrame([(str(k), f"text {k}") for k in range(n)], "ticket_id string, comment string")


def counting(path, dies_after=None, failing=()):
    """Labels all rows of a request 1, noting their ids in a file; dies with its worker after so
    many calls, raises for requests that hold an id of ``failing``."""
    def fn(request):
        ids = [line.split("Ticket ID: ")[1].split(")")[0] for line in request.split("\n") if "Ticket ID: " in line]
        with open(path, "a") as out:
            out.write(" ".join(ids) + "\n")
        with open(path) as noted:
            if dies_after is not None and len(noted.readlines()) > dies_after:
                os._exit(1)
        if set(ids) & set(failing):
            raise RuntimeError("busy")
        return "[" + ",".join(f'{{"id": "{i}", "label": 1, "reasoning": "r"}}' for i in ids) + "]"

    return fn


def calls(path):
    return [line.split() for line in open(path)] if os.path.exists(path) else []


OPTIONS = {"order_by": ["ticket_id"], "batch_size": 5, "parallelism": 1}


def test_a_failed_run_does_not_pay_twice(spark, folder, tmp_path):
    rows, journal = asked_rows(spark), f"{folder}/journal"
    whole = sorted(map(tuple, label_rows(rows, counting(f"{tmp_path}/whole"), **OPTIONS).collect()))
    with pytest.raises(Exception, match="exit|crash|EOF"):
        label_rows(rows, counting(f"{tmp_path}/first", dies_after=4), journal=journal, **OPTIONS).collect()
    paid = calls(f"{tmp_path}/first")[:4]
    found = label_rows(rows, counting(f"{tmp_path}/second"), journal=journal, **OPTIONS)
    assert sorted(map(tuple, found.collect())) == whole
    assert sorted(sum(calls(f"{tmp_path}/second") + paid, [])) == sorted(str(k) for k in range(50))
    assert len(calls(f"{tmp_path}/second")) == 6
    # All is known now, also after compaction; new rows are asked for, in batches of their own.
    compact_journal(spark, journal)
    more = asked_rows(spark, 53)
    assert label_rows(more, counting(f"{tmp_path}/third"), journal=journal, **OPTIONS).count() == 53
    assert calls(f"{tmp_path}/third") == [["50", "51", "52"]]
    assert read_journal(spark, journal).count() == 11


def test_failed_calls_are_asked_again_and_others_if_wanted(spark, folder, tmp_path):
    rows, journal = asked_rows(spark, 10), f"{folder}/journal"
    first = label_rows(rows, counting(f"{tmp_path}/a", failing=["3"]), journal=journal, **OPTIONS)
    assert sorted(r["code"] for r in first.collect()) == ["1"] * 5 + ["255"] * 5
    second = label_rows(rows, lambda text: "[]", journal=journal, **OPTIONS)
    assert sorted(r["code"] for r in second.collect()) == ["1"] * 5 + ["253"] * 5
    third = label_rows(rows, counting(f"{tmp_path}/b"), journal=journal, **OPTIONS)
    assert sorted(r["code"] for r in third.collect()) == ["1"] * 5 + ["253"] * 5 and calls(f"{tmp_path}/b") == []
    last = label_rows(rows, counting(f"{tmp_path}/c"), journal=journal, ask_again=("253", "254", "255"), **OPTIONS)
    assert {r["code"] for r in last.collect()} == {"1"} and len(calls(f"{tmp_path}/c")) == 1
    # Another prompt is another question.
    label_rows(rows, counting(f"{tmp_path}/d"), journal=journal, prompt="p\n", **OPTIONS).collect()
    assert len(calls(f"{tmp_path}/d")) == 2
