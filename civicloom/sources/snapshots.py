"""Versioned snapshots and the shared exports.

A table is never overwritten while it is read: every write is a new ``snapshot=n`` folder, and
appended rows are a new folder below ``_parts``. A manifest (``sources.manifests``) says which of
them are the table; a write that does not finish is in no manifest.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import replace
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.operators.filters import filter_province
from civicloom.schemas import HOME_PROVINCE
from civicloom.sources.files import child_names, claim, exists, listed, remove, success_marks
from civicloom.sources.manifests import Conflict, Manifest, commit, read_manifest, read_manifest_version
from civicloom.sources.tables import read_complaints_csv

_SNAPSHOT = re.compile(r"snapshot=(\d+)$")


def _numbers(spark: SparkSession, root: str) -> list[int]:
    found = (_SNAPSHOT.match(name) for name in child_names(spark, root))
    return sorted(int(match.group(1)) for match in found if match)


def write_snapshot(
    df: DataFrame,
    root: str,
    partition_by: tuple[str, ...] = (),
    holds: Sequence[str] = (),
    base: Manifest | None = None,
) -> str:
    """Write the next snapshot, make it the table, and return its path; nothing is overwritten.

    A number belongs to the writer that creates its claim, so two writers never share one. Rows
    are brought together by ``partition_by`` first, in as many tasks as their size asks for: a
    day is a few files, whatever the number of tasks, and a hot day is split.

    The snapshot replaces the one before and the parts there were when the write began (``base``,
    the table ``df`` was made from); parts appended since stay. ``holds`` names label runs whose
    labels are in ``df``. With ``base``, a table that has another snapshot by now is a
    ``Conflict``: its rows are not in ``df``.
    """
    spark = df.sparkSession
    began = read_manifest(spark, root) if base is None else base
    number = max(_numbers(spark, root), default=0) + 1
    while not claim(spark, f"{root}/_claims/snapshot={number}"):
        number += 1
    name = f"snapshot={number}"
    _write(df, f"{root}/{name}", partition_by)

    def change(current: Manifest) -> Manifest:
        if base is not None and current.snapshot != base.snapshot:
            raise Conflict(f"{root} has become {current.snapshot} while {name} was written")
        held = tuple(dict.fromkeys([*current.held, *holds]))
        later = tuple(part for part in current.parts if part not in began.parts)
        return replace(current, snapshot=name, parts=later, held=held)

    commit(spark, root, change)
    return f"{root}/{name}"


def _write(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)


def append_batch(
    df: DataFrame, root: str, stream: str, batch: int, partition_by: tuple[str, ...] = ()
) -> bool:
    """Add a stream's batch to the table, once: a batch that is in it already, because it runs
    again after a failure, is not added, and False is returned. Batches of a stream ascend."""
    spark = df.sparkSession
    if read_manifest(spark, root).done.get(stream, -1) >= batch:
        return False
    part = f"_parts/{stream}-{batch}-{uuid.uuid4().hex}"
    _write(df, f"{root}/{part}", partition_by)

    def change(current: Manifest) -> Manifest | None:
        if current.done.get(stream, -1) >= batch:
            return None
        return replace(current, parts=(*current.parts, part), done={**current.done, stream: batch})

    if part in commit(spark, root, change).parts:
        return True
    remove(spark, f"{root}/{part}")
    return False


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Path of the table's snapshot."""
    name = read_manifest(spark, root).snapshot
    return None if name is None else f"{root}/{name}"


def read_table(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    """The rows a manifest names, its snapshot's and its parts', without label runs."""
    names = [*([] if manifest.snapshot is None else [manifest.snapshot]), *manifest.parts]
    if not names:
        raise FileNotFoundError(f"no finished snapshot below {root}")
    frames = [spark.read.parquet(f"{root}/{name}") for name in names]
    return reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), frames)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The table: its snapshot and what was appended since."""
    return read_table(spark, root, read_manifest(spark, root))


def compact(spark: SparkSession, root: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write snapshot and parts as one new snapshot. Appends go on meanwhile and are not lost; if
    another writer replaces the snapshot, theirs stays and nothing is changed."""
    base = read_manifest(spark, root)
    if not base.parts:
        return
    try:
        write_snapshot(read_table(spark, root, base), root, partition_by, base=base)
    except Conflict:
        pass


def remove_unused(spark: SparkSession, root: str) -> list[str]:
    """Delete snapshots, parts and label runs that an earlier manifest named and the newest does
    not need, and return their folders. Call it when nobody reads the table as it was before;
    writes under way are in no manifest and stay."""
    current, dropped = read_manifest(spark, root), []
    for version in range(1, current.version):
        earlier = read_manifest_version(spark, root, version)
        for name in (earlier.snapshot, *earlier.parts):
            if name is not None and name != current.snapshot and name not in current.parts:
                dropped.append(name)
    dropped += [f"_label_data/{run}" for run in current.held]
    found = [name for name in dict.fromkeys(dropped) if exists(spark, f"{root}/{name}")]
    for name in found:
        remove(spark, f"{root}/{name}")
    for run in current.held:
        remove(spark, f"{root}/_labels/{run}")
    # What is gone needs no mention any more.
    commit(spark, root, lambda now: replace(now, held=tuple(run for run in now.held if run not in current.held)))
    return found


def export_name(start: date | datetime, end: date | datetime, prefix: str) -> str:
    return f"{prefix}_{start:%m%d%Y}_{end:%m%d%Y}.csv"


def export_range_csv(
    df: DataFrame,
    root: str,
    start: date | datetime,
    end: date | datetime,
    prefix: str = "labeled_output",
) -> str:
    """Write a folder of CSV parts, named after the time range, and return its path. Exporting a
    range again writes ``.v2.csv``, ``.v3.csv`` and so on: what is there may be being read."""
    spark, name, version = df.sparkSession, export_name(start, end, prefix), 1
    path = f"{root}/{name}"
    while exists(spark, path) or not claim(spark, f"{root}/_claims/{path.rsplit('/', 1)[1]}"):
        version += 1
        path = f"{root}/{name.removesuffix('.csv')}.v{version}.csv"
    df.write.mode("errorifexists").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    claim(spark, f"{root}/{_FINISHED}/{path.rsplit('/', 1)[1]}")
    return path


# Has an empty file for every export of this library that is finished.
_FINISHED = "_exports"
_EXPORTS = "name string, path string, modified timestamp"


def list_snapshots(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """``(name, path, modified)`` of the exports in a folder, newest first, ties by name.

    An export is a single file, or a folder whose write has finished. Two listings whatever the
    number of exports: the folder, and the names of finished exports kept beside them. Folders
    that something else wrote are asked for their ``_SUCCESS``, in one listing more.
    """
    folder = folder.rstrip("/")
    finished = {name: modified for name, _, modified in listed(spark, f"{folder}/{_FINISHED}")}
    entries = [entry for entry in listed(spark, folder)
               if entry[0].endswith(suffix) and not entry[0].startswith(("_", "."))]
    if any(is_folder and name not in finished for name, is_folder, _ in entries):
        finished = success_marks(spark, f"{folder}/*{suffix}") | finished
    rows = []
    for name, is_folder, modified in entries:
        if is_folder and name not in finished:
            continue
        at = finished[name] if is_folder else modified
        rows.append((name, f"{folder}/{name}", datetime.fromtimestamp(at / 1000, timezone.utc)))
    return spark.createDataFrame(rows, _EXPORTS).orderBy(F.desc("modified"), "name")


def load_labeled(
    spark: SparkSession,
    schema: T.StructType,
    folder: str | None = None,
    path: str | None = None,
    province_col: str = "province",
    province: str = HOME_PROVINCE,
) -> DataFrame:
    """The given export, or the newest in the folder, for one province. A folder without exports
    gives no rows; a path that is named must be there."""
    if path is not None and not exists(spark, path):
        raise FileNotFoundError(path)
    if path is None and folder is not None:
        newest = list_snapshots(spark, folder).limit(1).collect()
        path = newest[0]["path"] if newest else None
    if path is None:
        return spark.createDataFrame([], schema)
    return filter_province(read_complaints_csv(spark, path, schema), province_col, province)
