"""Range query and labelling: choose a time range, label what lacks a label, keep the result.

Labels stand beside the table, not in it: each run adds a small folder of labels, and reading
joins the newest label of each row to the table. Labelling an hour writes the labels of that hour;
no file of the table is written again. ``fold_labels`` makes a new snapshot of both when many runs
have gathered. The manifest says which runs a snapshot holds; readers take it and every other run
that is finished, so a run that ends while somebody folds is read beside the new snapshot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.operators.annotate import PARALLEL_CALLS, label_rows, pending_rows
from civicloom.operators.filters import filter_time_range
from civicloom.operators.join import LABEL, REASON, merge_labels_upsert
from civicloom.session import pin
from civicloom.sources.files import child_names, put_if_absent, read_text
from civicloom.sources.manifests import TRIES, Conflict, Manifest, read_manifest
from civicloom.sources.snapshots import read_snapshot, read_table, write_snapshot

_LABELS = f"ticket_id string, {LABEL} string, {REASON} string, batch_num bigint, pos int, run string"
_DATA, _FINISHED = "_label_data", "_labels"


@dataclass(frozen=True)
class LabeledState:
    """A table as it is at one moment: its manifest and the finished runs it does not hold."""

    manifest: Manifest
    runs: tuple[str, ...]


def labeled_state(spark: SparkSession, root: str) -> LabeledState:
    # The manifest first: a run that a later one holds is then at worst read twice over, which
    # gives the same labels; the other way round it could be missed.
    manifest = read_manifest(spark, root)
    held = set(manifest.held)
    finished = sorted(name for name in child_names(spark, f"{root}/{_FINISHED}") if not name.startswith("."))
    return LabeledState(manifest, tuple(run for run in finished if run not in held))


def _days(spark: SparkSession, root: str, runs: Sequence[str]) -> list[str] | None:
    """Days that the runs have labels for; None if some run does not say."""
    found: set[str] = set()
    for run in runs:
        days = json.loads(read_text(spark, f"{root}/{_FINISHED}/{run}"))["days"]
        if days is None:
            return None
        found.update(days)
    return sorted(found)


def read_state(
    spark: SparkSession, root: str, state: LabeledState, id_col: str = "ticket_id", day_col: str | None = None
) -> DataFrame:
    """The table of that moment with the labels of its runs; the last label of a row counts.

    With ``day_col``, the column the snapshots are partitioned by, only days that some run has
    labels for are joined; the folders of all other days are read as they are.
    """
    table = read_table(spark, root, state.manifest)
    if not state.runs:
        return table
    labels = spark.read.schema(_LABELS).parquet(*[f"{root}/{_DATA}/{run}" for run in state.runs])
    labels = labels.withColumnRenamed("ticket_id", id_col)
    order = ["run", "batch_num", "pos"]
    days = _days(spark, root, state.runs) if day_col is not None and day_col in table.columns else None
    if days is None:
        return merge_labels_upsert(table, labels, order, id_col)
    kind = table.schema[day_col].dataType
    touched = F.coalesce(F.col(day_col).isin([F.lit(day).cast(kind) for day in days]), F.lit(False))
    merged = merge_labels_upsert(table.where(touched), labels, order, id_col)
    return table.where(~touched).unionByName(merged, allowMissingColumns=True)


def read_labeled(
    spark: SparkSession, root: str, id_col: str = "ticket_id", day_col: str | None = None
) -> DataFrame:
    """The table with the labels of all finished runs (see ``read_state``)."""
    return read_state(spark, root, labeled_state(spark, root), id_col, day_col)


def write_labels(
    labels: DataFrame, root: str, days: Sequence[str] | None = None
) -> str:
    """Add a run: ``ticket_id``, label, reason, ``batch_num`` and ``pos``. It counts from the
    moment its name stands among the finished ones. ``days`` says which days its rows are of."""
    spark = labels.sparkSession
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"
    columns = ["ticket_id", LABEL, REASON, "batch_num", "pos"]
    labels.select(*columns, F.lit(run).alias("run")).write.parquet(f"{root}/{_DATA}/{run}")
    put_if_absent(spark, f"{root}/{_FINISHED}/{run}", json.dumps({"days": None if days is None else list(days)}))
    return run


def label_range(
    spark: SparkSession,
    root: str,
    fn: Callable[..., str],
    start: datetime,
    end: datetime,
    order_by: Sequence[str],
    id_col: str = "ticket_id",
    ts_col: str = "timestamp",
    roles: dict[str, str] | None = None,
    batch_size: int = 20,
    day_col: str | None = None,
    parallelism: int = PARALLEL_CALLS,
    prompt: str = "",
    journal: str | None = None,
) -> DataFrame:
    """Label what lacks a label in the range, write those labels, and return the labelled table.
    Labels outside the range, and good ones inside it, stay. A range with nothing to label writes
    nothing. ``day_col`` names the column the snapshots are partitioned by, if they are.
    ``journal`` is a folder for answers as they come (see ``label_rows``): a run that fails and is
    started again asks only for the rest."""
    table = read_labeled(spark, root, id_col, day_col)
    chosen = pin(pending_rows(filter_time_range(table, start, end, ts_col, day_col), roles), "pending")
    if chosen.isEmpty():
        return table
    labels = label_rows(chosen, fn, order_by, id_col, roles, batch_size, parallelism, prompt, journal)
    days = None
    if day_col is not None:
        # At most the days of the range; a null day is none that a range can reach.
        days = [row[0] for row in chosen.select(F.col(day_col).cast("string")).distinct().collect()]
    write_labels(labels, root, days)
    return read_labeled(spark, root, id_col, day_col)


def fold_labels(
    spark: SparkSession, root: str, id_col: str = "ticket_id", day_col: str | None = None
) -> DataFrame:
    """Write the labelled table as the next snapshot, for when joining many runs has become
    dearer than one rewrite, and return the table. Runs that finish meanwhile are not in the
    snapshot and stay beside it; if another writer replaces the snapshot meanwhile, the fold
    begins again from theirs."""
    for _ in range(TRIES):
        state = labeled_state(spark, root)
        folded = read_state(spark, root, state, id_col, day_col)
        try:
            write_snapshot(folded, root, (day_col,) if day_col else (), holds=state.runs, base=state.manifest)
        except Conflict:
            continue
        return read_snapshot(spark, root)
    raise Conflict(f"others replaced {root} {TRIES} times")
