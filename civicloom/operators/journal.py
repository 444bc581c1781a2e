"""A journal of paid answers, written by the tasks as the answers come.

A row is known by its content: the hash of its request text (without its place in a batch), of the
prompt and of its photo. Every answered batch is an entry with its rows' hashes; a task adds entries
as small files that appear whole, under names of their own, so an attempt that is repeated or lost
can neither harm nor hide what others wrote. Whoever asks again looks the rows up first.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.answers import FAILED, answer_for, read_answers
from civicloom.session import pin
from civicloom.sources.files import child_names, remove

ENTRIES = "members array<struct<ticket_id: string, key: string>>, answer string, error string, at double"
# Files of entries that ``compact_journal`` has brought together.
_COMPACTED = "compacted-"


def row_key(text: Column, photo: Column, prompt: str) -> Column:
    """What a row is known by: its own part of a request, the prompt, and its photo."""
    return F.sha2(F.to_json(F.struct(F.lit(prompt).alias("prompt"), text.alias("text"), photo.alias("photo"))), 256)


class JournalWriter:
    """Adds entries from a task; ``flush`` makes those since the last one appear."""

    def __init__(self, folder: str, every: int):
        self.folder, self.every, self.entries, self.files = folder, every, [], None

    def add(self, members, answer: str | None, error: str | None) -> None:
        rows = [{"ticket_id": m["ticket_id"], "key": m["key"]} for m in members]
        self.entries.append(json.dumps({"members": rows, "answer": answer, "error": error, "at": time.time()}))
        if len(self.entries) >= self.every:
            self.flush()

    def flush(self) -> None:
        if not self.entries:
            return
        if self.files is None:
            from pyarrow import fs

            # Hadoop spells local paths with one slash.
            uri = re.sub(r"^file:/(?!/)", "file:///", self.folder)
            self.files, self.path = fs.FileSystem.from_uri(uri)
            self.files.create_dir(self.path, recursive=True)
        name = f"{uuid.uuid4().hex}.json"
        with self.files.open_output_stream(f"{self.path}/.{name}") as out:
            out.write(("\n".join(self.entries) + "\n").encode())
        self.files.move(f"{self.path}/.{name}", f"{self.path}/{name}")
        self.entries = []


def read_journal(spark: SparkSession, folder: str) -> DataFrame:
    """All entries: ``members``, ``answer``, ``error``, ``at``."""
    names = [name for name in child_names(spark, folder) if not name.startswith((".", "_"))]
    if not names:
        return spark.createDataFrame([], ENTRIES)
    frames = []
    if any(name.endswith(".json") for name in names):
        frames.append(spark.read.schema(ENTRIES).json(f"{folder}/*.json"))
    if any(name.startswith(_COMPACTED) for name in names):
        frames.append(spark.read.schema(ENTRIES).parquet(f"{folder}/{_COMPACTED}*"))
    return frames[0] if len(frames) == 1 else frames[0].union(frames[1])


def known_rows(spark: SparkSession, folder: str, ask_again: tuple[str, ...] = (FAILED,)) -> DataFrame:
    """``(key, code, reasoning)`` of rows that need not be asked for again: of the answers whose
    code is not in ``ask_again``, the last. Calls that failed have the code 255."""
    entries = read_answers(read_journal(spark, folder), "answer", "error")
    rows = entries.select("at", F.explode(F.transform("members", lambda m: F.struct(
        m["key"].alias("key"), answer_for(m["ticket_id"]).alias("result")))).alias("row"))
    good = rows.select("at", "row.key", "row.result.code", "row.result.reasoning").where(~F.col("code").isin(*ask_again))
    last = F.max_by(F.struct("code", "reasoning"), F.struct("at", "code", "reasoning")).alias("last")
    return pin(good.groupBy("key").agg(last).select("key", "last.code", "last.reasoning"), "known-answers")


def compact_journal(spark: SparkSession, folder: str) -> None:
    """Bring the small files there are now together; call it when no job writes to the journal."""
    names = [name for name in child_names(spark, folder) if not name.startswith((".", "_"))]
    entries = read_journal(spark, folder)
    if entries.isEmpty():
        return
    entries.hint("rebalance").write.parquet(f"{folder}/{_COMPACTED}{uuid.uuid4().hex}")
    for name in names:
        remove(spark, f"{folder}/{name}")
