"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by sign flips and fast Hadamard transforms, three rounds of them, and hashed to
the coordinate that is largest in absolute value, with its sign: the nearest vertex of a
cross-polytope. A table hashes by several rotations at once. Each vector enters, in every table,
the buckets of its few likeliest combinations of vertices, so that a pair that straddles a border
still meets. Vectors that share a bucket are compared exactly; a pair that shares several counts in
the first only, so links can be counted without listing pairs. The number of tables follows from the
threshold, the dimension and the share of pairs at the threshold that may be missed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.components import components
from civicloom.llm.groups import block_pairs, stars, whole_units
from civicloom.session import pin

# Share of the pairs exactly at the threshold that no table may bring together; pairs above it meet more often.
MISS = 1e-6
ROTATIONS_PER_TABLE = 2
PROBES = 3
# Vertices per rotation that combinations are made of.
NEAREST = 3
BLOCK = 1024
# Few dimensions are padded: Hadamard rotations of 2 or 4 of them are too few to differ between tables.
LEAST_WIDTH = 32
_SEED = 20
# Pairs and tables that a table's rate of meetings is measured with.
_TRIALS, _TRIAL_TABLES = 500, 8


def usable(vector: str) -> F.Column:
    """Vectors with a direction: not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(n, width // (2 * step), 2, step)
        rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
        step *= 2
    return rows.reshape(n, width) / np.sqrt(width)


def rotations(width: int, tables: int, seed: int = _SEED) -> np.ndarray:
    signs = np.random.default_rng([seed, width]).integers(0, 2, (tables * ROTATIONS_PER_TABLE, 3, width))
    return signs * 2.0 - 1.0


def _width(dim: int) -> int:
    return max(LEAST_WIDTH, 1 << (dim - 1).bit_length())


@lru_cache(maxsize=None)
def tables_for(dim: int, least: float, probes: int = PROBES, miss: float = MISS) -> int:
    """Tables after which at most ``miss`` of the pairs of cosine ``least`` share no bucket.

    A table's rate of meetings is measured on random pairs of that cosine and dimension, with
    rotations that the search does not use, and taken three standard errors lower.
    """
    if not 0 < least <= 1 or not 0 < miss < 1:
        raise ValueError("least must be above 0 and at most 1, miss between 0 and 1")
    draw = np.random.default_rng([_SEED + 1, dim])
    one, other = draw.standard_normal((2, _TRIALS, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (one * other).sum(axis=1, keepdims=True) * one
    length = np.linalg.norm(other, axis=1, keepdims=True)
    other /= np.where(length > 0, length, 1)
    turned = least * one + np.sqrt(1 - least * least) * other
    turned /= np.linalg.norm(turned, axis=1, keepdims=True)
    a, b = (buckets(side, _TRIAL_TABLES, probes, _SEED + 1).reshape(-1, probes) for side in (one, turned))
    n = len(a)
    meet = (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean()
    meet = min(meet - 3 * np.sqrt(meet * (1 - meet) / n), 1 - 3 / n)
    if meet <= 0:
        raise ValueError(f"pairs of cosine {least} in {dim} dimensions hardly share buckets: give tables")
    return int(np.ceil(np.log(miss) / np.log(1 - meet)))


def buckets(unit: np.ndarray, tables: int, probes: int = PROBES, seed: int = _SEED) -> np.ndarray:
    """For each unit vector, ``tables`` x ``probes`` bucket numbers, a table's likeliest first."""
    n, dim = unit.shape
    width = _width(dim)
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    signs = rotations(width, tables, seed)
    near = min(NEAREST, 2 * width)
    found = np.zeros((n, tables, probes), dtype=np.int64)
    for table in range(tables):
        cost = np.zeros((n, 1))
        code = np.zeros((n, 1), dtype=np.int64)
        for r in range(ROTATIONS_PER_TABLE):
            turned = padded
            for flip in signs[table * ROTATIONS_PER_TABLE + r]:
                turned = _hadamard(turned * flip)
            both = np.concatenate((turned, -turned), axis=1)
            best = np.argpartition(-both, near - 1, axis=1)[:, :near]
            height = np.take_along_axis(both, best, axis=1)
            order = np.argsort(-height, axis=1, kind="stable")
            best, height = np.take_along_axis(best, order, axis=1), np.take_along_axis(height, order, axis=1)
            cost = (cost[:, :, None] + (height[:, :1] - height)[:, None, :]).reshape(n, -1)
            code = (code[:, :, None] * (2 * width) + best[:, None, :]).reshape(n, -1)
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        chosen = np.take_along_axis(code, order, axis=1)
        found[:, table, :chosen.shape[1]] = chosen
        found[:, table, chosen.shape[1]:] = chosen[:, :1]
    return (found + np.arange(tables)[None, :, None] * (1 << 40)).reshape(n, tables * probes)


def _rows(column) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _hashed(classes: DataFrame, least: float, miss: float, tables: int | None, probes: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                vectors = _rows(own.column("vector"))
                vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
                count = tables or tables_for(int(size), least, probes, miss)
                keys = np.sort(buckets(vectors, count, probes), axis=1)
                lists = pa.ListArray.from_arrays(
                    np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*own.columns, lists], names=[*own.schema.names, "buckets"])

    kind = classes.schema["vector"].dataType.simpleString()
    group = classes.schema["label"].dataType.simpleString()
    return classes.mapInArrow(
        run, f"vec long, copies long, label {group}, dim int, vector {kind}, buckets array<long>")


def _bucket_links(units: DataFrame, least: float, probes: int) -> DataFrame:
    """For each unit of a bucket: links counted here first, and stars that join what they join."""

    def run(batches):
        for table, starts in whole_units(batches, ["label", "dim", "bucket", "_first", "_second"], 4096):
            names = table["vec"].to_numpy()
            copies = table["copies"].to_numpy()
            bucket = table["bucket"].to_numpy()
            side = table["_side"].to_numpy()
            cross = table["_first"].to_numpy() != table["_second"].to_numpy()
            left, right, counted, links = [], [], [], []
            for begin, end in zip(starts[:-1], starts[1:]):
                part = table.slice(begin, end - begin)
                vectors = _rows(part["vector"])
                lengths = np.sqrt((vectors * vectors).sum(axis=1))
                cosine = (vectors @ vectors.T) / (lengths[:, None] * lengths[None, :])
                near = cosine >= least
                np.fill_diagonal(near, False)
                if cross[begin]:
                    near &= side[begin:end][:, None] != side[begin:end][None, :]
                if not near.any():
                    continue
                one, other = np.nonzero(np.triu(near))
                keys = _rows_of_keys(part["buckets"])
                first = _first_shared(keys, one, other, probes) == bucket[begin]
                one, other = one[first], other[first]
                if not len(one):
                    continue
                own, own_copies = names[begin:end], copies[begin:end]
                n = int(end - begin)
                total = np.bincount(one, weights=own_copies[other], minlength=n) + np.bincount(
                    other, weights=own_copies[one], minlength=n)
                some = np.flatnonzero(total)
                counted.append(own[some]), links.append(total[some].astype(np.int64))
                # Two vectors linked in an earlier bucket are joined there.
                new = np.zeros((n, n), dtype=bool)
                new[one, other] = new[other, one] = True
                root = stars(n, lambda rows, columns: new[np.ix_(rows, columns)])
                moved = np.flatnonzero(root != np.arange(n))
                left.append(own[root[moved]]), right.append(own[moved])
            if not counted:
                continue
            a, b = np.concatenate(left), np.concatenate(right)
            c, n_links = np.concatenate(counted), np.concatenate(links)
            none = np.zeros(0, dtype=np.int64)
            for columns in ((a, b, np.zeros(len(a), dtype=np.int64)), (c, c, n_links)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((none, x)), pa.int64()) for x in columns],
                    names=["a", "b", "n_links"])

    return units.mapInArrow(run, "a long, b long, n_links long")


def _rows_of_keys(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _first_shared(keys: np.ndarray, one: np.ndarray, other: np.ndarray, probes: int) -> np.ndarray:
    """The smallest bucket number that both vectors of each pair are in.

    Numbers ascend in a row and a table has ``probes`` of them, so a number is looked for among its
    table's only, for pairs that share none of the smaller ones.
    """
    answer = np.full(len(one), np.iinfo(np.int64).max)
    for begin in range(0, len(one), 1 << 14):
        a, b = keys[one[begin:begin + (1 << 14)]], keys[other[begin:begin + (1 << 14)]]
        left = np.arange(len(a))
        for k in range(a.shape[1]):
            table = k // probes * probes
            shared = (b[left, table:table + probes] == a[left, k:k + 1]).any(axis=1)
            hit = left[shared]
            answer[begin + hit] = a[hit, k]
            left = left[~shared]
            if not len(left):
                break
    return answer


def near_duplicate_vectors(vectors: DataFrame, *, least: float = 0.93, miss: float = MISS,
                           tables: int | None = None, probes: int = PROBES, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label") -> DataFrame:
    """One row per vector: ``id_col``, ``label_col``, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable) and ``kept`` (whether that is its own).

    Vectors of equal, non-null label and equal dimension are linked if their cosine, in double
    precision, is at least ``least`` and they share a bucket; of pairs exactly at ``least``, ``miss`` may
    not (``tables_for``), unless ``tables`` fixes the number of tables. A vector that is null, all zero or
    holds a null or non-finite component, and one without a label, links with nothing, and so
    does one without an id, whose component is null. Equal vectors are one class from the start.
    Rows that share an id count as vectors of their own in ``n_links``. No rows give no rows.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec"), F.col(label_col).alias("label"),
        F.col(vector_col).alias("vector"))
    # 0.0 and -0.0 are equal numbers; grouping tells arrays apart by value.
    able = rows.where(usable("vector") & F.col("label").isNotNull() & F.col("vec").isNotNull())
    classes = (
        able.groupBy("label", "vector").agg(F.min("vec").alias("vec"), F.count("*").alias("copies"))
        .select("vec", "copies", "label", F.size("vector").alias("dim"), "vector")
    )
    classes = pin(_hashed(classes, least, miss, tables, probes), "vector-classes")
    place = ["label", "dim", "bucket"]
    entered = classes.select("vec", "label", "dim", F.explode(F.array_distinct("buckets")).alias("bucket"))
    # Only vectors that meet another one carry their components on.
    crowded = entered.groupBy(*place).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    meeting = entered.join(crowded, place).join(
        classes.select("vec", "label", "dim", "copies", "vector", "buckets"), ["vec", "label", "dim"])
    units = block_pairs(meeting, place, "vec", BLOCK)
    found = pin(_bucket_links(units, least, probes), "vector-links")
    counts = found.where("n_links > 0").groupBy(F.col("a").alias("vec")).agg(F.sum("n_links").alias("_n"))
    joined = components(found.where("n_links = 0")).select(F.col("id").alias("vec"), "component_id")
    facts = (
        classes.join(counts, "vec", "left").join(joined, "vec", "left")
        .where("copies > 1 or _n is not null")
        .select(
            F.col("label").alias("_label"), F.col("vector").alias("_vector"),
            F.xxhash64("label", "vector").alias("name"),
            (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias("_links"),
            F.coalesce("component_id", "vec").alias("_component"))
    )
    named = rows.withColumn(
        "name", F.when(usable("vector") & F.col("label").isNotNull() & F.col("vec").isNotNull(),
                       F.xxhash64("label", "vector")))
    same = (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
    answer = named.join(facts, (named["name"] == facts["name"]) & same, "left")
    component = F.coalesce("_component", "vec")
    return answer.select(
        F.col("vec").alias(id_col), F.col("label").alias(label_col),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec") == component, F.lit(True)).alias("kept"))
