"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector, in units of a block of queries and a block of vectors.
No score leaves its task: a unit sends how many of a query's scores fall into each bin, the sums
over all units tell which bin holds the query's k-th best score, and the next round cuts that bin
into finer ones, until a query's bins above the border hold exactly k scores or the border bin is
one value. A last pass lets through what reaches the border, and ties go by id.

A unit's bins below its own k best scores cannot hold the k-th best of all, so they are not sent: a
query sends at most k bins and at most k candidates per block of vectors. Scores are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicloom.session import pin

QUERY_BLOCK = 8192
VECTOR_BLOCK = 4096
# Components of a block, so that long vectors come in smaller blocks.
BLOCK_COMPONENTS = 1 << 22
BIN_BITS = 12
# Queries scored at a time against a block of vectors.
_AT_ONCE = 256
_EXACT = 1 << 53


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if len(column) else pa.array([], pa.int64())
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _largest(values: np.ndarray) -> int:
    return max(int(values.max()), -int(values.min())) if values.size else 0


def score_blocks(queries: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Inner products, some queries at a time: exact, in floating point where that is exact."""
    bound = _largest(queries) * _largest(vectors) * queries.shape[1]
    kind = np.float64 if bound < _EXACT else np.int64 if bound < 1 << 63 else object
    right = vectors.astype(kind).T
    for begin in range(0, len(queries), _AT_ONCE):
        part = slice(begin, begin + _AT_ONCE)
        scores = queries[part].astype(kind) @ right
        if kind is object and any(abs(score) >= 1 << 63 for score in scores.ravel()):
            raise OverflowError("a score does not fit in a long")
        yield part, scores.astype(np.int64)


def _units(asked: DataFrame, vectors: DataFrame):
    """Blocks of queries beside blocks of vectors of the same number of components."""
    per_dim = vectors.select("dim", "blocks").distinct()
    left = (
        asked.join(per_dim, "dim")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    )
    per_question = asked.select(F.col("dim").alias("of_dim"), F.col("query_block").alias("of_query_block")).distinct()
    right = vectors.select("vec_id", "vector", F.col("dim").alias("of_dim"), F.col("block").alias("of_block"))
    right = right.join(per_question, "of_dim")
    return left.groupBy("dim", "query_block", "block").cogroup(right.groupBy("of_dim", "of_query_block", "of_block"))


_COUNTED = pa.schema([("query", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])
_FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _count(asked: DataFrame, vectors: DataFrame, above: int | None, shift: int, bins: int) -> DataFrame:
    """How many scores start with which bits: ``(query, bin, n)``, a bin being a score without its
    lowest ``shift`` bits, but for bins that cannot hold the border. Only scores in the query's
    ``border`` bin of the round before, of ``above`` bits, count; without ``above`` all do."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _COUNTED.empty_table()
        dim = left["dim"][0].as_py()
        ids, own = right["vec_id"].to_numpy(), left["query_id"].to_numpy()
        query, border, need = (left[name].to_numpy() for name in ("query", "border", "need"))
        first = np.full(len(left), -bins // 2) if above is None else border << (above - shift)
        parts = []
        for part, scores in score_blocks(_matrix(left["question"], dim), _matrix(right["vector"], dim)):
            inside = ids[None, :] != own[part, None]
            if above is not None:
                inside &= (scores >> above) == border[part, None]
            rows, places = np.nonzero(inside)
            place = (scores[rows, places] >> shift) - first[part][rows]
            n = len(scores)
            counts = np.bincount(rows * bins + place, minlength=n * bins).reshape(n, bins)
            higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
            rows, place = np.nonzero((counts > 0) & (higher < need[part, None]))
            parts.append(pa.table([query[part][rows], place + first[part][rows], counts[rows, place]], schema=_COUNTED))
        return pa.concat_tables(parts).combine_chunks()

    counted = _units(asked, vectors).applyInArrow(run, "query long, bin long, n long")
    return counted.groupBy("query", "bin").agg(F.sum("n").alias("n"))


_LOWEST = -(1 << 63)


def _borders(asked: DataFrame, vectors: DataFrame, k: int, bits: int) -> DataFrame:
    """``(query, low)``: a value that a query's k best scores reach, and no other score but ties
    of the k-th; the lowest long where there are fewer than k. Scores are of ``bits`` bits and a sign."""
    open_ = asked.withColumns({"border": F.lit(0).cast("long"), "need": F.lit(k).cast("long")})
    above, shift = None, max(0, bits + 1 - BIN_BITS)
    settled = []
    while True:
        bins = 1 << ((bits + 1 if above is None else above) - shift)
        counted = _count(open_, vectors, above, shift, bins)
        down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        reached = (
            counted.join(open_.select("query", "need"), "query").withColumn("so_far", F.sum("n").over(down))
            .where(F.col("so_far") - F.col("n") < F.col("need"))
            .groupBy("query").agg(F.min_by(F.struct("bin", "n", "so_far", "need"), "bin").alias("at"))
            .select("query", "at.*")
        )
        done = F.lit(True) if shift == 0 else F.col("so_far") <= F.col("need")
        low = F.when(F.col("so_far") < F.col("need"), F.lit(_LOWEST)).otherwise(F.shiftleft("bin", shift))
        found = pin(reached.select(
            "query", done.alias("done"), low.alias("low"), F.col("bin").alias("border"),
            (F.col("need") - F.col("so_far") + F.col("n")).alias("need")), "borders")
        settled.append(found.where("done").select("query", "low"))
        rest = found.where("not done").select("query", "border", "need")
        if shift == 0 or rest.isEmpty():
            break
        open_ = asked.join(rest, "query")
        above, shift = shift, max(0, shift - BIN_BITS)
    return reduce(DataFrame.union, settled)


def _reaching(asked: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """What reaches its query's ``low``: ``(query, vec_id, score)``, of one block the ``k`` best."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _FOUND.empty_table()
        dim = left["dim"][0].as_py()
        ids, own = right["vec_id"].to_numpy(), left["query_id"].to_numpy()
        query, low = left["query"].to_numpy(), left["low"].to_numpy()
        parts = []
        for part, scores in score_blocks(_matrix(left["question"], dim), _matrix(right["vector"], dim)):
            rows, places = np.nonzero((scores >= low[part, None]) & (ids[None, :] != own[part, None]))
            found = scores[rows, places]
            order = np.lexsort((ids[places], -found, rows))
            rows, places, found = rows[order], places[order], found[order]
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
            best = rank < k
            parts.append(pa.table([query[part][rows[best]], ids[places[best]], found[best]], schema=_FOUND))
        return pa.concat_tables(parts).combine_chunks()

    return _units(asked, vectors).applyInArrow(run, "query long, vec_id long, score long")


def _in_blocks(rows: DataFrame, vector: str, block_rows: int, block: str) -> DataFrame:
    """Adds ``dim``, ``blocks`` (of that dimension) and the row's own block."""
    rows = rows.withColumn("dim", F.size(vector).cast("long"))
    size = F.least(F.lit(block_rows), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_COMPONENTS) / F.greatest("dim", F.lit(1)))))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("_n")).withColumn("blocks", F.ceil(F.col("_n") / size)).drop("_n")
    return rows.join(sizes, "dim").withColumn(block, F.pmod(F.xxhash64(vector, "told_apart"), "blocks"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "vector",
          query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row of ``queries`` the ``k``
    rows of ``vectors`` of another id with the largest inner products, ties to the smaller id.

    Vectors are arrays of longs. Rows with a null id, a null vector or a null component take no
    part; a query compares with vectors of its length only, and has all of them if they are fewer
    than ``k``. Rows that repeat an id are rows of their own, as queries (each is answered) and as
    candidates. A score that no long can hold is an error. Extra columns are not looked at.
    """
    def usable(rows: DataFrame, name: str) -> DataFrame:
        whole = F.col(vector_col).isNotNull() & F.forall(vector_col, lambda x: x.isNotNull())
        return (
            rows.where(F.col(id_col).isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias(f"{name}_id"), F.col(vector_col).alias(name))
            .withColumn("told_apart", F.monotonically_increasing_id())
        )

    at = usable(vectors, "vector").withColumnRenamed("vector_id", "vec_id")
    at = pin(_in_blocks(at, "vector", vector_block, "block").drop("told_apart"), "score-vectors")
    asked = _in_blocks(usable(queries, "question"), "question", query_block, "query_block")
    asked = pin(
        asked.drop("blocks").withColumnsRenamed({"question_id": "query_id", "told_apart": "query"}), "score-queries")

    def largest(rows: DataFrame, name: str) -> int:
        size = F.array_max(F.transform(name, lambda x: F.greatest(F.abs(x), F.lit(0))))
        row = rows.agg(F.max(size).alias("size"), F.max("dim").alias("dim")).first()
        return (row["size"] or 0), (row["dim"] or 0)

    (one, dim), (other, _) = largest(at, "vector"), largest(asked, "question")
    bits = min(63, (one * other * max(dim, 1)).bit_length())
    borders = pin(_borders(asked, at, k, bits), "borders")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = (
        _reaching(asked.join(borders, "query"), at, k).withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
    )
    names = asked.select("query", "query_id")
    return ranked.join(names, "query").select("query_id", "rank", "vec_id", "score")
