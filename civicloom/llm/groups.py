"""Groups of rows of any size, handled in bounded blocks.

A group is dealt into blocks by hash; each pair of blocks is a unit of work that one task handles
in memory, so a group with a third of all rows is many units on many tasks. Groups of one row
have no pairs and go at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, keys: list[str], id_col: str, block_rows: int) -> DataFrame:
    """Rows of groups of two or more, once per pair of blocks they belong to.

    Adds ``_first`` and ``_second`` (the blocks of the unit, ``_first <= _second``) and ``_side``
    (0 or 1: the row's own block). A group of up to ``block_rows`` rows is one unit. The result
    is dealt and sorted by unit.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / block_rows)
    own = F.pmod(F.xxhash64(id_col), blocks)
    units = (
        rows.join(sizes, keys)
        .withColumn("_blocks", blocks)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .withColumn("_first", F.least("_own", "_other"))
        .withColumn("_second", F.greatest("_own", "_other"))
        .withColumn("_side", (F.col("_own") > F.col("_other")).cast("int"))
        .drop("_n", "_blocks", "_own", "_other")
    )
    unit = [*keys, "_first", "_second"]
    return units.repartition(*unit).sortWithinPartitions(*unit, "_side", id_col)


def whole_units(batches: Iterator[pa.RecordBatch], unit: list[str], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches put together to tables of about ``rows`` rows that end where a unit ends,
    each with the first row of every unit in it and the number of rows."""
    kept: pa.Table | None = None
    enough = rows
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        if len(kept) >= enough:
            starts = _starts(kept, unit)
            if len(starts) > 2:
                cut = int(starts[-2])
                yield kept.slice(0, cut).combine_chunks(), starts[:-1]
                kept = kept.slice(cut)
                enough = len(kept) + rows
            else:
                enough = 2 * len(kept)
    if kept is not None and len(kept):
        yield kept.combine_chunks(), _starts(kept, unit)


def _starts(table: pa.Table, unit: list[str]) -> np.ndarray:
    changes = np.ones(len(table), dtype=bool)
    changes[1:] = False
    for name in unit:
        values = table[name].to_numpy()
        changes[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changes), len(table))


def stars(n: int, linked: Callable[[np.ndarray, np.ndarray], np.ndarray], *,
          candidates: np.ndarray | None = None) -> np.ndarray:
    """Components of ``n`` items: for each, the smallest item reachable.

    ``linked(rows, columns)`` answers a matrix of which rows link to which columns. Items already
    reached are not asked about again, so a group that hangs together costs about one row.
    ``candidates`` (a matrix) limits the questions to pairs that may link.
    """
    root = np.arange(n)
    open_ = np.ones(n, dtype=bool)
    for seed in range(n):
        if not open_[seed]:
            continue
        open_[seed] = False
        frontier = np.array([seed])
        while len(frontier) and open_.any():
            rest = np.flatnonzero(open_)
            if candidates is not None:
                rest = rest[candidates[np.ix_(frontier, rest)].any(axis=0)]
                if not len(rest):
                    break
            # One item at a time first: it usually reaches all the others.
            reached, waiting = [], rest
            for item in frontier:
                if not len(waiting):
                    break
                hit = linked(np.array([item]), waiting)[0]
                reached.append(waiting[hit])
                waiting = waiting[~hit]
            frontier = np.concatenate(reached) if reached else np.array([], dtype=int)
            root[frontier] = seed
            open_[frontier] = False
    return root
