"""What a table consists of, changed by compare-and-set.

A table is a folder with numbered manifests. A manifest names the snapshot, the parts appended to
it since, the label runs the snapshot holds, and how far each stream has come. A change writes the
next number; of two writers who start from the same one only one succeeds, and the other looks
again. Readers take the manifest with the largest number: whatever it names is written for good.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from civicloom.sources.files import child_names, put_if_absent, read_text

_FOLDER = "_manifests"
# A writer gives up after so many others were faster, one after the other.
TRIES = 1000


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    # Folder names below the table's folder.
    snapshot: str | None = None
    parts: tuple[str, ...] = ()
    # Label runs whose labels are in the snapshot.
    held: tuple[str, ...] = ()
    # For each stream the last batch that is in the table.
    done: dict[str, int] = field(default_factory=dict)


class Conflict(RuntimeError):
    """The table is no longer what a change was made from."""


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest; one without a snapshot if there is none."""
    versions = [int(name) for name in child_names(spark, f"{root}/{_FOLDER}") if name.isdigit()]
    if not versions:
        return Manifest()
    return read_manifest_version(spark, root, max(versions))


def read_manifest_version(spark: SparkSession, root: str, version: int) -> Manifest:
    found = json.loads(read_text(spark, f"{root}/{_FOLDER}/{version:012d}"))
    return Manifest(found["version"], found["snapshot"], tuple(found["parts"]), tuple(found["held"]), found["done"])


def commit(spark: SparkSession, root: str, change: Callable[[Manifest], Manifest | None]) -> Manifest:
    """Write what ``change`` makes of the newest manifest, again from the newest one whenever
    another writer was first. ``change`` returns None to leave the table as it is."""
    for _ in range(TRIES):
        current = read_manifest(spark, root)
        changed = change(current)
        if changed is None:
            return current
        changed = replace(changed, version=current.version + 1)
        if put_if_absent(spark, f"{root}/{_FOLDER}/{changed.version:012d}", json.dumps(asdict(changed))):
            return changed
    raise Conflict(f"{TRIES} other changes of {root} came first")
