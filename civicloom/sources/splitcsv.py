"""CSV with quoted line breaks, read in many tasks per file.

A line break ends a record unless it stands inside quotes, which a task that begins in the middle of
a file cannot see. So the lines of a split are first taken as a function of one bit: whether the
split ends inside quotes, if it begins outside, and if it begins inside. The functions of a file's
splits, one row per split, are applied one after the other; then every split knows how it begins,
joins its lines to records, and sends on only what hangs over its edges.

The file is scanned twice, both times in all tasks: once for the functions, once for the records.
No record passes the driver, and a record is never moved unless it crosses an edge.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A quote opens only at the start of a field; doubled inside quotes it is a character; what follows
# a closing quote belongs to the field until the next comma.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
_CLOSED = re.compile(rf"{_FIELD}(?:,{_FIELD})*+", re.DOTALL)
_INSIDE = re.compile(r'[^"]*+(?:""[^"]*+)*+')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the text after this line is inside quotes."""
    at = 0
    if inside:
        at = _INSIDE.match(line).end()
        if at == len(line):
            return True
        comma = line.find(",", at + 1)
        if comma < 0:
            return False
        at = comma + 1
    return _CLOSED.fullmatch(line, at) is None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``line``, and ``file`` and ``begin`` of its split; ``block`` names the split. The lines of
    a split come one after the other, in order."""
    text = spark.read.option("lineSep", "\n").text(path)
    file, begin = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return text.select(F.col("value").alias("line"), file.alias("file"), begin.alias("begin"),
                       F.xxhash64(file, begin).alias("block"))


def _runs(blocks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
    bounds = [0, *edges.tolist(), len(blocks)]
    return [(a, b) for a, b in zip(bounds[:-1], bounds[1:]) if a < b]


def _quoted(lines: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))


def _between(rows: np.ndarray, a: int, b: int) -> list[int]:
    return rows[np.searchsorted(rows, a):np.searchsorted(rows, b)].tolist()


_FUNCTIONS = pa.schema([("file", pa.string()), ("begin", pa.int64()), ("block", pa.int64()),
                        ("returns", pa.bool_()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_()),
                        ("starts_inside", pa.bool_())])
_FUNCTIONS_DDL = ("file string, begin long, block long, returns boolean, from_outside boolean, from_inside boolean, "
                  "starts_inside boolean")


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each split ends by how it begins, and whether a record starts in it if it begins
    inside quotes; ``returns`` says whether its first line ends with a carriage return."""
    split, outside, inside, starts = None, False, True, False
    for batch in batches:
        done, lines = [], batch.column("line")
        quoted = _quoted(lines)
        for a, b in _runs(batch.column("block").to_numpy()):
            if split is None or split[2] != batch.column("block")[a].as_py():
                if split is not None:
                    done.append((*split, outside, inside, starts))
                split = (*(batch.column(name)[a].as_py() for name in ("file", "begin", "block")),
                         lines[a].as_py().endswith("\r"))
                outside, inside, starts = False, True, False
            last = a - 1
            for row in _between(quoted, a, b):
                # Lines without quotes leave both as they are; a record starts at each line outside.
                starts = starts or not inside
                line = lines[row].as_py()
                after = ends_inside(line, outside)
                inside = after if inside == outside else ends_inside(line, inside)
                outside, last = after, row
            starts = starts or (not inside and last < b - 1)
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], schema=_FUNCTIONS)
    if split is not None:
        yield pa.record_batch([pa.array([v]) for v in (*split, outside, inside, starts)], schema=_FUNCTIONS)


def _beginnings(splits: pd.DataFrame) -> pd.DataFrame:
    """How the splits of one file begin, and in which split the record there started."""
    inside, owner, rows = False, 0, []
    splits = splits.sort_values("begin")
    # A file ends all its lines as it ends the first.
    returns = bool(splits["returns"].iloc[0])
    for split in splits.itertuples():
        rows.append((split.block, inside, owner, returns))
        if not inside or split.starts_inside:
            owner = split.block
        inside = bool(split.from_inside if inside else split.from_outside)
    return pd.DataFrame(rows, columns=["block", "inside", "owner", "returns"])


_RECORDS = pa.schema([("owner", pa.int64()), ("begin", pa.int64()), ("record", pa.string()), ("whole", pa.bool_()),
                      ("head", pa.bool_()), ("returns", pa.bool_())])
_RECORDS_DDL = "owner long, begin long, record string, whole boolean, head boolean, returns boolean"


class _Split:
    """The lines of one split, joined to records as they come."""

    def __init__(self, block: int, begin: int, inside: bool, owner: int, returns: bool):
        self.block, self.begin, self.inside, self.owner, self.returns = block, begin, inside, owner, returns
        # Lines of the record that is not complete; whether it started in this split, and first.
        self.open: list[str] = []
        self.own, self.first = not inside, False

    def _closed(self, whole: bool) -> list[tuple]:
        if not self.open:
            return []
        owner = self.block if self.own else self.owner
        head = self.own and self.first and self.begin == 0
        return [(owner, self.begin, "\n".join(self.open), whole and self.own, head, self.returns)]

    def add(self, lines: pa.Array, quoted: list[int]) -> Iterator[tuple[list[tuple], pa.Array | None]]:
        """Rows for records that came from earlier lines, and then the records inside ``lines``."""
        starts = np.zeros(len(lines), dtype=bool)
        before, inside = 0, self.inside
        for row in quoted:
            starts[before:row + 1] = not inside
            inside, before = ends_inside(lines[row].as_py(), inside), row + 1
        starts[before:] = not inside
        self.inside = inside
        at = np.flatnonzero(starts)
        if not len(at):
            self.open.extend(lines.to_pylist())
            return
        self.open.extend(lines.slice(0, at[0]).to_pylist())
        rows = self._closed(True)
        fresh = self.own and not self.open  # nothing of this split has come yet
        if fresh and len(at) > 1:
            rows.append((self.block, self.begin, "\n".join(lines.slice(0, at[1]).to_pylist()), True, self.begin == 0,
                         self.returns))
        middle = at[1:] if fresh else at
        self.own, self.first = True, fresh and len(at) == 1
        self.open = lines.slice(at[-1]).to_pylist()
        if len(middle) > 1:
            within = pa.ListArray.from_arrays(
                pa.array(middle - middle[0], pa.int32()), lines.slice(middle[0], middle[-1] - middle[0]))
            yield rows, pc.binary_join(within, "\n")
        else:
            yield rows, None

    def end(self) -> list[tuple]:
        return self._closed(not self.inside)


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c) for c in zip(*rows)], schema=_RECORDS)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        lines = batch.column("line")
        quoted = _quoted(lines)
        for a, b in _runs(batch.column("block").to_numpy()):
            first = {name: batch.column(name)[a].as_py() for name in ("block", "begin", "inside", "owner", "returns")}
            if split is None or split.block != first["block"]:
                if split is not None and (rows := split.end()):
                    yield _record_rows(rows)
                if first["inside"] is None:
                    raise RuntimeError("the file was cut into other splits than before")
                split = _Split(**first)
            for rows, within in split.add(lines.slice(a, b - a), [row - a for row in _between(quoted, a, b)]):
                if rows:
                    yield _record_rows(rows)
                if within is not None:
                    n = len(within)
                    yield pa.record_batch(
                        [pa.array(np.full(n, split.block)), pa.array(np.full(n, split.begin)), within,
                         pa.array(np.ones(n, dtype=bool)), pa.array(np.zeros(n, dtype=bool)),
                         pa.array(np.full(n, split.returns))], schema=_RECORDS)
    if split is not None and (rows := split.end()):
        yield _record_rows(rows)


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` (without its line end) and ``head`` (whether it is the first of its file) of all
    records but blank ones. Line breaks inside quotes are part of a record, ``"`` is doubled inside
    quotes. A file whose first line ends with a carriage return and a line feed ends all lines so,
    and has plain line feeds inside quotes."""
    lines = _lines(spark, path)
    functions = lines.mapInArrow(_functions, _FUNCTIONS_DDL)
    begins = functions.groupBy("file").applyInPandas(
        _beginnings, "block long, inside boolean, owner long, returns boolean")
    # One row per split, that is per read task. A shuffle would lose the order of the lines.
    told = lines.drop("file").join(F.broadcast(begins), "block", "left")
    found = told.mapInArrow(_records, _RECORDS_DDL)
    parts = found.where("not whole").groupBy("owner").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("begin", "record"))), lambda r: r["record"]), "\n")
        .alias("record"), F.max("head").alias("head"), F.max("returns").alias("returns"))
    columns = ["record", "head", "returns"]
    rows = found.where("whole").select(*columns).union(parts.select(*columns))
    record = F.col("record")
    ended = F.when(record.endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(record)
    plain = F.when(F.col("returns"), F.replace(ended, F.lit("\r\n"), F.lit("\n"))).otherwise(record)
    marked = F.when(F.col("head"), F.ltrim(F.col("record"), F.lit("\ufeff"))).otherwise(F.col("record"))
    return rows.select(plain.alias("record"), "head").select(marked.alias("record"), "head").where("record <> ''")
