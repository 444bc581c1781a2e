"""Token ids in one compressed file per shard: a wavelet matrix.

A shard holds the ids of consecutive documents. Its file has one bit plane per bit of the largest
id. The first plane holds the highest bit of every id in order; the ids whose bit is 0 then move,
in order, before those whose bit is 1, and the next plane holds their next bit. Counts of ones
before every 512th bit make ``rank`` a look-up and a sum over at most 64 bytes, so the file
answers which id stands at a place, how often an id occurs, and where it occurs for the k-th time
without unpacking the ids.

The files are Parquet, one row each, so that any store Spark writes to can hold them and a lost
task leaves no half-written shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicloom.llm.tokens import Coder
from civicloom.session import pin

RANK_BITS = 512
# A shard is closed at this many ids; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 21


class WaveletMatrix:
    """Bit planes of a sequence of ids, with rank and select."""

    def __init__(self, length: int, planes: bytes, zeros: np.ndarray, ranks: bytes):
        self.length = int(length)
        self.zeros = np.asarray(zeros, dtype=np.int64)
        self.levels = len(self.zeros)
        self.bits = np.frombuffer(planes, dtype=np.uint8).reshape(self.levels, -1)
        self.ranks = np.frombuffer(ranks, dtype="<u4").reshape(self.levels, -1)

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids, dtype=np.uint32)
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        ids = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        other = np.empty_like(ids)
        width = -(-max(len(ids), 1) // RANK_BITS) * RANK_BITS // 8
        planes = np.zeros((levels, width), dtype=np.uint8)
        ranks = np.zeros((levels, width * 8 // RANK_BITS), dtype="<u4")
        zeros = np.zeros(levels, dtype=np.int64)
        for level in range(levels):
            ones = (ids & ids.dtype.type(1 << (levels - 1 - level))).astype(bool)
            packed = np.packbits(ones)
            planes[level, : len(packed)] = packed
            counts = np.bitwise_count(planes[level].view(np.uint64))
            each = counts.reshape(-1, RANK_BITS // 64).sum(axis=1, dtype=np.int64)
            ranks[level, 1:] = np.cumsum(each)[:-1]
            first = zeros[level] = len(ids) - int(each.sum())
            np.compress(ones, ids, out=other[first:])
            np.compress(np.logical_not(ones, out=ones), ids, out=other[:first])
            ids, other = other, ids
        return cls(len(ids), planes.tobytes(), zeros, ranks.tobytes())

    def _ones_before(self, level: int, place: int) -> int:
        block, rest = divmod(place, RANK_BITS)
        if not rest:
            if block < self.ranks.shape[1]:
                return int(self.ranks[level, block])
            return self.length - int(self.zeros[level])
        first = block * RANK_BITS // 8
        whole, odd = divmod(rest, 8)
        row = self.bits[level]
        n = int(self.ranks[level, block]) + int(np.bitwise_count(row[first:first + whole]).sum())
        return n + (int(row[first + whole]) >> (8 - odd)).bit_count() if odd else n

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.length:
            raise IndexError(place)
        value = 0
        for level in range(self.levels):
            one = int(self.bits[level, place >> 3]) >> (7 - (place & 7)) & 1
            ones = self._ones_before(level, place)
            place = int(self.zeros[level]) + ones if one else place - ones
            value = value << 1 | one
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of an id among the first ``end`` ids stand after the last plane."""
        if token < 0 or token >> self.levels:
            return 0, 0
        first, last = 0, end
        for level in range(self.levels):
            a, b = self._ones_before(level, first), self._ones_before(level, last)
            if token >> (self.levels - 1 - level) & 1:
                first, last = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of an id among the first ``end`` ids (default all)."""
        first, last = self._range(token, self.length if end is None else min(end, self.length))
        return last - first

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0) of an id."""
        first, last = self._range(token, self.length)
        if not 0 <= k < last - first:
            raise IndexError(k)
        place = first + k
        for level in range(self.levels - 1, -1, -1):
            one = place >= self.zeros[level]
            wanted = place - int(self.zeros[level]) if one else place
            low, high = 0, self.length  # the first place with more than ``wanted`` such bits up to it
            while high - low > 1:
                middle = (low + high) // 2
                ones = self._ones_before(level, middle)
                if (ones if one else middle - ones) <= wanted:
                    low = middle
                else:
                    high = middle
            place = low
        return place

    def ids(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        values = np.zeros(self.length, dtype=kind)
        before = np.empty_like(values)
        for level in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.bits[level], count=self.length).view(bool)
            zeros = int(self.zeros[level])
            values[zeros:] |= kind(1 << (self.levels - 1 - level))
            before[np.flatnonzero(ones)] = values[zeros:]
            before[np.flatnonzero(np.logical_not(ones, out=ones))] = values[:zeros]
            values, before = before, values
        return values.astype("<u4")


_FILE = """shard_part int, shard_piece int, n_tokens long, doc_ids array<{kind}>,
           doc_tokens array<long>, zeros array<long>, ranks binary, planes binary"""


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int | None, path: str, *,
                      id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode whole texts, ``end_id`` after each, and write them in ascending order of ``id_col``,
    one file per shard. A null text counts as empty.

    The order is total over ``id_col`` (nulls first) and the text, so rows that share an id are
    spread over tasks too. Texts are dealt by ranges before they are encoded, which moves less
    than their ids would; a task writes shards as it goes and holds one at a time. No rows give
    no file.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    order = [F.col(id_col).asc_nulls_first(), F.col("_tie")]
    ordered = (
        docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
        .withColumn("_tie", F.xxhash64("_text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_tie")
    )
    id_type = pa_type(docs, id_col)
    end = np.array([] if end_id is None else [end_id], dtype="<u4")

    def run(batches):
        part, piece = TaskContext.get().partitionId(), 0
        docs, sizes, ids, held = [], [], [], 0
        for batch, flat, ends in Coder(tokenizer).encode_all(batches):
            if len(end):
                flat = np.insert(flat, ends, end[0])
                ends = ends + np.arange(1, len(ends) + 1)
            begin = 0
            while begin < len(ends):
                start = int(ends[begin - 1]) if begin else 0
                # As many documents as fit; one that is too long starts a shard of its own.
                last = max(begin, int(np.searchsorted(ends, start + shard_tokens - held, "right")))
                if last == begin and held == 0:
                    last = begin + 1
                if last > begin:
                    docs.append(batch.column(0)[begin:last])
                    sizes.append(np.diff(ends[begin:last], prepend=start))
                    ids.append(flat[start:ends[last - 1]])
                    held += int(ends[last - 1]) - start
                if last < len(ends):
                    yield _shard(part, piece, docs, sizes, ids, id_type)
                    piece, docs, sizes, ids, held = piece + 1, [], [], [], 0
                begin = last
        if docs:
            yield _shard(part, piece, docs, sizes, ids, id_type)

    (
        ordered.mapInArrow(run, _FILE.format(kind=kind))
        .write.option("compression", "zstd").option("maxRecordsPerFile", 1)
        .parquet(path)
    )


def pa_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _shard(part: int, piece: int, docs: list, sizes: list, ids: list, id_type) -> pa.RecordBatch:
    matrix = WaveletMatrix.of(np.concatenate(ids))
    names_of = pa.concat_arrays([d.cast(id_type) for d in docs])
    columns = [
        pa.array([part], pa.int32()), pa.array([piece], pa.int32()),
        pa.array([matrix.length], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(names_of)], pa.int32()), names_of),
        pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
        pa.array([matrix.zeros.tolist()], pa.list_(pa.int64())),
        pa.array([matrix.ranks.tobytes()], pa.binary()), pa.array([matrix.bits.tobytes()], pa.binary()),
    ]
    names = ["shard_part", "shard_piece", "n_tokens", "doc_ids", "doc_tokens", "zeros",
             "ranks", "planes"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def open_matrix(row) -> WaveletMatrix:
    """The wavelet matrix of one row of the files."""
    return WaveletMatrix(row["n_tokens"], row["planes"], row["zeros"], row["ranks"])


def read_token_files(spark, path: str, id_type: str = "long", *, id_col: str = "doc_id") -> DataFrame:
    """Documents in the files: ``id_col``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids``. The start of a shard is the sum over the shards before it: one number
    per shard is added up, not one per document."""
    files = spark.read.schema(_FILE.format(kind=id_type)).parquet(path)
    shards = files.select("shard_part", "shard_piece", "n_tokens")
    parts = shards.groupBy("shard_part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("shard_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    before = (
        Window.partitionBy("shard_part").orderBy("shard_piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        shards.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
        .join(parts, "shard_part")
        .select("shard_part", "shard_piece", (F.col("_inside") + F.col("_before")).alias("shard_start"))
    )
    # Written first, so that its size is known: the planes are not shuffled to meet a short list.
    placed = files.join(pin(starts, "shard-starts"), ["shard_part", "shard_piece"]).select(
        "shard_start", "n_tokens", "doc_ids", "doc_tokens", "zeros", "ranks", "planes")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names
                       if name != "doc_ids"}
                flat = open_matrix(row).ids()
                sizes = np.array(row["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[k].values,
                        pa.array(starts + row["shard_start"], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([flat[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    names=[id_col, "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(run, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")
