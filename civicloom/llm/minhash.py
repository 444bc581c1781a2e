"""Near-duplicate documents by b-bit MinHash.

Each document keeps one minimum per hash function over its word shingles. Rows of minima make
bands; documents that share a band are candidates. Of each minimum only the low bits are kept, in
one packed signature: for a candidate pair the number of equal low bits, corrected for those that
agree by chance, estimates the similarity. What passes, with a margin for the estimate's error,
is confirmed on the full sets of shingles.

Documents with equal sets are one from the start, and the answer is each document's component, so
pairs are never listed: inside a block of candidates only links that join something new are looked
for, and they come out as stars.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.components import components
from civicloom.llm.groups import block_pairs, stars, whole_units
from civicloom.session import pin

ROWS_PER_BAND = 4
LOW_BITS = 4
# Chance that two documents exactly at the threshold share no band.
MISSED_AT_THRESHOLD = 1e-5
# Standard errors below the threshold at which an estimate rules a pair out.
MARGIN = 5.0
SIGNATURE_BLOCK = 2048
SET_BLOCK = 1024
# Shingles hashed at a time, for documents of any length.
SHINGLES_AT_ONCE = 1 << 13
_MIX = np.uint64(0x9E3779B97F4A7C15)


def bands_for(similarity: float) -> int:
    return math.ceil(math.log(MISSED_AT_THRESHOLD) / math.log(1 - similarity**ROWS_PER_BAND))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int):
    """The set of each text as sorted 64-bit hashes. A-Z count as a-z; words are runs of anything
    but blank, tab, line feed, vertical tab, form feed and carriage return. A text of fewer words
    gives one shingle of all of them, a text without words the empty set."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    coded = split.flatten().dictionary_encode()
    by_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
                          dtype=np.uint64, count=len(coded.dictionary))
    empty = np.fromiter((len(w) == 0 for w in coded.dictionary.to_pylist()), dtype=bool,
                        count=len(coded.dictionary))
    index = coded.indices.to_numpy()
    hashes = by_word[index]
    real = ~empty[index] if len(index) else np.zeros(0, dtype=bool)
    if not real.all():
        before = np.concatenate(([0], np.cumsum(real)))
        bounds = before[bounds]
        hashes = hashes[real]
    runs = len(hashes) - words + 1
    if runs > 0:
        rolled = hashes[:runs].copy()
        for k in range(1, words):
            rolled = _mixed(rolled * _MIX + hashes[k:k + runs])
    with np.errstate(over="ignore"):
        for begin, end in zip(bounds[:-1], bounds[1:]):
            n = end - begin
            if n >= words:
                yield np.unique(rolled[begin:end - words + 1])
            elif n:
                value = hashes[begin:begin + 1] + np.uint64(n)
                for k in range(1, n):
                    value = _mixed(value * _MIX + hashes[begin + k:begin + k + 1])
                yield _mixed(value + _MIX)
            else:
                yield hashes[:0]


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, count + 1, dtype=np.uint64)
    return _mixed(k * _MIX), _mixed(k * _MIX + np.uint64(77)) | np.uint64(1)


def minima(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    shift, factor = functions
    least = np.full(len(shift), np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(shingles), SHINGLES_AT_ONCE):
        part = shingles[k:k + SHINGLES_AT_ONCE]
        np.minimum(least, ((part[None, :] ^ shift[:, None]) * factor[:, None]).min(axis=1), out=least)
    return least


def _packed(least: np.ndarray) -> bytes:
    """The low bits of mixed minima, 16 to a word; the last word is filled up with zeros."""
    low = np.zeros(-(-len(least) // 16) * 16, dtype=np.uint8)
    low[:len(least)] = _mixed(least) & np.uint64((1 << LOW_BITS) - 1)
    return (low[0::2] | low[1::2] << LOW_BITS).tobytes()


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minima differ in their low bits; signatures as rows of 64-bit words, broadcast."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=-1, dtype=np.int64)


def most_differing(similarity: float, count: int) -> int:
    """Minima that may differ in a pair at the threshold: the estimate (agreeing share, corrected
    for chance agreement of the low bits) may fall short by the margin."""
    chance = 2.0**-LOW_BITS
    agree = chance + (1 - chance) * similarity
    lowest = agree - MARGIN * math.sqrt(agree * (1 - agree) / count)
    return math.floor((1 - lowest) * count)


def sketch(docs: DataFrame, words: int, bands: int, *, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, ``n_shingles``, ``set_id`` (16 bytes that name the set; null if empty),
    ``bands`` and ``signature``, of the whole text. No shuffle."""
    plain = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))

    def run(batches):
        functions = _functions(bands * ROWS_PER_BAND)
        for batch in batches:
            sizes, names, keys, signatures = [], [], [], []
            with np.errstate(over="ignore"):
                for shingles in shingle_sets(batch.column(1), words):
                    sizes.append(len(shingles))
                    if not len(shingles):
                        names.append(None), keys.append(None), signatures.append(None)
                        continue
                    names.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    least = minima(shingles, functions)
                    rows = least.reshape(bands, ROWS_PER_BAND)
                    band = np.arange(bands, dtype=np.uint64)
                    for k in range(ROWS_PER_BAND):
                        band = _mixed(band * _MIX + rows[:, k])
                    keys.append(band.view(np.int64))
                    signatures.append(_packed(least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                names=[id_col, "n_shingles", "set_id", "bands", "signature"],
            )

    kind = plain.schema[id_col].dataType.simpleString()
    return plain.mapInArrow(
        run, f"`{id_col}` {kind}, n_shingles long, set_id binary, bands array<long>, signature binary")


def _words_of(column: pa.ChunkedArray) -> np.ndarray:
    """Binary values of one length as rows of 64-bit words."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype="<u8").reshape(len(column), -1)


SMALL_UNIT = 16


def _candidate_links(shared: DataFrame, most: int) -> DataFrame:
    """Stars of documents whose signatures pass, within each unit of a shared band."""
    units = block_pairs(shared, ["band"], "doc", SIGNATURE_BLOCK)

    def run(batches):
        for table, starts in whole_units(batches, ["band", "_first", "_second"], 20_000):
            docs = table["doc"].to_numpy()
            signatures = _words_of(table["signature"])
            sizes = np.diff(starts)
            unit = np.repeat(np.arange(len(sizes)), sizes)
            small = np.repeat(sizes <= SMALL_UNIT, sizes) & (
                table["_first"].to_numpy() == table["_second"].to_numpy())
            left, right = [], []
            for step in range(1, SMALL_UNIT):
                pair = np.flatnonzero((unit[step:] == unit[:-step]) & small[step:])
                if not len(pair):
                    break
                passes = pair[differing(signatures[pair], signatures[pair + step]) <= most]
                left.append(docs[passes]), right.append(docs[passes + step])
            for k in np.flatnonzero(~small[starts[:-1]]):
                begin, end = starts[k], starts[k + 1]
                own, names = signatures[begin:end], docs[begin:end]
                side = table["_side"].to_numpy()[begin:end]
                cross = table["_first"][int(begin)].as_py() != table["_second"][int(begin)].as_py()

                def linked(rows, columns):
                    near = differing(own[rows][:, None, :], own[columns][None, :, :]) <= most
                    return near & (side[rows][:, None] != side[columns][None, :]) if cross else near

                root = stars(len(names), linked)
                moved = np.flatnonzero(root != np.arange(len(root)))
                left.append(names[root[moved]]), right.append(names[moved])
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(left), pa.int64()), pa.array(np.concatenate(right), pa.int64())],
                    names=["a", "b"])

    return units.mapInArrow(run, "a long, b long")


def _confirmed_links(sets: DataFrame, numerator: int, denominator: int, most: int) -> DataFrame:
    """Stars of documents that are similar on their full sets, within each group of candidates."""
    units = block_pairs(sets, ["candidates"], "doc", SET_BLOCK)

    def run(batches):
        for table, starts in whole_units(batches, ["candidates", "_first", "_second"], 512):
            docs = table["doc"].to_numpy()
            signatures = _words_of(table["signature"])
            side = table["_side"].to_numpy()
            sets = [np.frombuffer(value.as_buffer(), dtype="<u8") for value in table["shingles"]]
            left, right = [], []
            for begin, end in zip(starts[:-1], starts[1:]):
                cross = table["_first"][int(begin)].as_py() != table["_second"][int(begin)].as_py()
                unit = _SetUnit(sets[begin:end], signatures[begin:end],
                                side[begin:end] if cross else None, numerator, denominator, most)
                root = stars(int(end - begin), unit.linked)
                names = docs[begin:end]
                moved = np.flatnonzero(root != np.arange(len(root)))
                left.append(names[root[moved]]), right.append(names[moved])
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(left), pa.int64()), pa.array(np.concatenate(right), pa.int64())],
                    names=["a", "b"])

    return units.mapInArrow(run, "a long, b long")


class _SetUnit:
    def __init__(self, sets, signatures, side, numerator, denominator, most):
        self.sets, self.signatures, self.side = sets, signatures, side
        self.numerator, self.denominator, self.most = numerator, denominator, most
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)

    def linked(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        answer = np.zeros((len(rows), len(columns)), dtype=bool)
        for k, row in enumerate(rows):
            may = differing(self.signatures[row], self.signatures[columns]) <= self.most
            if self.side is not None:
                may &= self.side[columns] != self.side[row]
            chosen = np.flatnonzero(may)
            if not len(chosen):
                continue
            others = [self.sets[c] for c in columns[chosen]]
            flat, own = np.concatenate(others), self.sets[row]
            place = np.searchsorted(own, flat)
            place[place == len(own)] = 0
            common = np.add.reduceat((own[place] == flat).astype(np.int64),
                                     np.concatenate(([0], np.cumsum([len(o) for o in others])[:-1])))
            union = self.sizes[row] + self.sizes[columns[chosen]] - common
            answer[k, chosen] = self.denominator * common >= self.numerator * union
        return answer


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if 100 times the shingles they share is at least ``percent`` times the
    shingles of both together; ``component_id`` is the smallest id reachable over links, ``kept``
    whether it is the document's own. A null text, or one without words, has the empty set and
    links with nothing. Rows that share an id are one document of several texts. A row without
    an id links with nothing: its component is null and it is kept. ``id_col`` is a whole number.
    No rows give no rows.

    Sets go over the network once, for documents that have a candidate.
    """
    similarity = percent / 100
    bands = bands_for(similarity)
    most = most_differing(similarity, bands * ROWS_PER_BAND)
    sketched = pin(sketch(docs, words, bands, id_col=id_col, text_col=text_col), "sketches")
    classes = pin(
        sketched.where(F.col("set_id").isNotNull() & F.col(id_col).isNotNull())
        .groupBy("set_id").agg(
            F.min(F.col(id_col).cast("long")).alias("doc"), F.max(id_col).alias("_last"),
            F.first("bands").alias("bands"), F.first("signature").alias("signature")),
        "sets",
    )
    bare = classes.select("doc", F.posexplode("bands").alias("pos", "band"))
    bare = bare.select("doc", F.xxhash64("pos", "band").alias("band"))
    crowded = bare.groupBy("band").agg(F.count("*").alias("_n")).where("_n > 1").select("band")
    shared = pin(bare.join(crowded, "band").join(classes.select("doc", "signature"), "doc"), "shared-bands")
    candidates = components(_candidate_links(shared, most))
    asked = pin(
        candidates.select(F.col("id").alias("doc"), F.col("component_id").alias("candidates"))
        .join(classes.select("doc", "set_id", "signature"), "doc"),
        "candidates",
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("_text"))
    sets = (
        _full_sets(texts.join(asked, "doc"), words)
        .dropDuplicates(["doc", "set_id"])
    )
    confirmed = components(_confirmed_links(pin(sets, "candidate-sets"), percent, 100, most))
    # Sets whose documents' smallest id is not the document's own.
    moved = (
        classes.join(confirmed.withColumnRenamed("id", "doc"), "doc", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc"))
        .where(F.col("component_id") != F.col("_last"))
        .select("set_id", "component_id")
    )
    component = F.coalesce("component_id", F.col(id_col).cast("long"))
    return (
        sketched.select(id_col, "n_shingles", "set_id").join(moved, "set_id", "left")
        .select(
            id_col, "n_shingles",
            F.when(F.col(id_col).isNotNull(), component).alias("component_id"),
            F.coalesce(F.col(id_col) == component, F.lit(True)).alias("kept"),
        )
    )


def _full_sets(texts: DataFrame, words: int) -> DataFrame:
    """The shingles of candidate documents; another text under the same id is left out."""

    def run(batches):
        for batch in batches:
            with np.errstate(over="ignore"):
                sets = [s.tobytes() for s in shingle_sets(batch.column("_text"), words)]
            right = [xxhash.xxh3_128_digest(s) == name for s, name in
                     zip(sets, batch.column("set_id").to_pylist())]
            table = pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("candidates"), batch.column("set_id"),
                 batch.column("signature"), pa.array(sets, pa.binary())],
                names=["doc", "candidates", "set_id", "signature", "shingles"])
            yield table.filter(pa.array(right, pa.bool_()))

    return texts.select("doc", "candidates", "set_id", "signature", "_text").mapInArrow(
        run, "doc long, candidates long, set_id binary, signature binary, shingles binary")
