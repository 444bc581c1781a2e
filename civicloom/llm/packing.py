"""Best-fit packing: pieces of documents into sequences of a fixed length.

Minimum bin slack: for each sequence, a subset-sum over the lengths still available (a bitset in
which bit t says that t tokens can be filled) finds the fullest feasible combination around the
longest piece left; the combination is taken out and the search goes on. Pieces of one length are
interchangeable, so the search runs over the count of each length, at most ``max_tokens``
numbers whatever the size of the corpus; the pieces themselves stay on the executors, where each
finds its sequence from its rank among the pieces of its length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicloom.session import pin


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(sequences, [(length, pieces of it in each sequence), ...])`` that use up
    ``counts`` (pieces of each length from 1 to ``capacity``).

    A combination found is used for up to half the sequences its pieces would allow, so that
    the lengths run out together; the number of patterns is at most ``capacity`` times the
    binary logarithm of the largest count.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError(f"a piece must hold 1 to {capacity} tokens")
    descending = sorted(left, reverse=True)
    patterns = []
    while descending:
        combination = _fullest(left, descending, capacity)
        fits = min(left[length] // n for length, n in combination)
        times = fits if len(combination) == 1 else (fits + 1) // 2
        patterns.append((times, combination))
        for length, n in combination:
            left[length] -= times * n
            if left[length] == 0:
                del left[length]
                descending.remove(length)
    return patterns


def _fullest(left: dict[int, int], descending: list[int], capacity: int) -> list[tuple[int, int]]:
    seed = descending[0]
    room = capacity - seed
    mask = (1 << (room + 1)) - 1
    reach, tried = [1], []
    for length in descending:
        if length > room:
            continue
        copies = min(left[length] - (length == seed), room // length)
        now, step = reach[-1], 1
        while copies > 0:
            taken = min(step, copies)
            now |= (now << (length * taken)) & mask
            copies -= taken
            step *= 2
        tried.append(length)
        reach.append(now)
        if now >> room & 1:
            break
    filled = reach[-1].bit_length() - 1
    used = {seed: 1}
    for place in range(len(tried) - 1, -1, -1):
        while not reach[place] >> filled & 1:
            filled -= tried[place]
            used[tried[place]] = used.get(tried[place], 0) + 1
    return sorted(used.items(), reverse=True)


def cut_pieces(encoded: DataFrame, max_tokens: int, *, id_col: str = "doc_id") -> DataFrame:
    """Pieces ``(id_col, piece, start, length, ids)`` of encoded documents.

    A document of at most ``max_tokens`` is one piece. A longer one is cut into pieces of
    ``max_tokens``; its first piece takes what remains. A document without ids gives no piece.
    """
    n = (F.octet_length("ids") / 4).cast("long")
    first = F.when(F.col("_n") % max_tokens == 0, F.least(F.col("_n"), F.lit(max_tokens))).otherwise(
        F.col("_n") % max_tokens)
    more = ((F.col("_n") - F.col("_first")) / max_tokens).cast("int")
    start = F.when(F.col("piece") == 0, F.lit(0)).otherwise(
        F.col("_first") + (F.col("piece") - 1) * max_tokens).cast("long")
    length = F.when(F.col("piece") == 0, F.col("_first")).otherwise(F.lit(max_tokens)).cast("long")
    return (
        encoded.withColumn("_n", n).where("_n > 0")
        .withColumn("_first", first)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), more)))
        .withColumn("start", start)
        .withColumn("length", length)
        .select(
            id_col, "piece", "start", "length",
            F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))").alias("ids"),
        )
    )


def pack(pieces: DataFrame, max_tokens: int, *, order_by: list[str]) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences as minimum bin slack
    finds, each filled from 0 without gaps. ``length`` says how long a piece is.

    ``order_by`` names the columns that tell pieces apart; pieces equal in all of them are
    interchangeable. Keep token ids and texts out of ``pieces``: its rows are written once and
    shuffled once, dealt by length and hash so that a frequent length is spread.
    No rows give no rows; a null length, or one outside 1 to ``max_tokens``, is an error.
    """
    spark = pieces.sparkSession
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pin(
        pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order_by), F.lit(buckets)).cast("int")),
        "pieces",
    )
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    counts = {row["length"]: row["n"] for row in
              sizes.groupBy("length").agg(F.sum("_n").alias("n")).limit(max_tokens + 2).collect()}
    if None in counts:
        raise ValueError("a piece has no length")
    slots = _slots(minimum_bin_slack(counts, max_tokens))

    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy(*order_by)
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(within))
        .join(offsets, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
        .drop("_bucket", "_before")
    )
    names = [name for name in pieces.columns if name not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in names)

    def place(batches):
        for batch in batches:
            yield slots.place(batch)[[*names, "sequence_id", "offset"]]

    return ranked.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def fill_sequences(placed: DataFrame, ids: DataFrame, *, key: str, id_col: str = "doc_id") -> DataFrame:
    """The packed sequences: ``sequence_id``, ``n_tokens``, ``ids`` (of the whole sequence, from
    its first token on) and ``pieces``, an array by ``offset`` of ``offset, length, id_col, piece,
    start``.

    ``placed`` is what ``pack`` gives; ``key`` names a column that is different for every piece
    and tells which of the rows of ``ids``, ``(key, ids)``, belongs to it. Ids move once to their
    piece and once to their sequence; in between they are written, so that one of the two shuffles
    is on disk at a time, and ``placed`` and ``ids`` are not read again.
    """
    facts = ["offset", "length", id_col, "piece", "start"]
    joined = pin(placed.join(ids.select(key, F.col("ids").alias("_ids")), key).drop(key), "placed-ids")
    together = joined.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", F.struct(*facts).alias("fact"), "_ids"))).alias("_all"))
    return together.select(
        "sequence_id",
        F.expr("aggregate(_all, 0L, (n, p) -> n + p.fact.length)").alias("n_tokens"),
        F.expr("aggregate(_all, cast('' as binary), (whole, p) -> concat(whole, p._ids))").alias("ids"),
        F.col("_all.fact").alias("pieces"),
    )


def pieces_of(sequences: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The pieces of filled sequences, a row each: ``id_col, piece, start, length, ids,
    sequence_id, offset``."""
    rows = sequences.select("sequence_id", "ids", F.explode("pieces").alias("_fact"))
    own = F.expr("substring(ids, cast(_fact.offset * 4 + 1 as int), cast(_fact.length * 4 as int))")
    return rows.select(
        F.col("_fact")[id_col].alias(id_col), "_fact.piece", "_fact.start", "_fact.length", own.alias("ids"),
        "sequence_id", "_fact.offset")


class _Slots:
    """For each length, which ranks go to which sequences, and where in them."""

    def __init__(self, table: pd.DataFrame):
        self.by_length = {
            int(length): tuple(rows[name].to_numpy() for name in ("first", "pieces", "sequence", "offset"))
            for length, rows in table.groupby("length")
        }

    def place(self, batch: pd.DataFrame) -> pd.DataFrame:
        sequence = np.zeros(len(batch), dtype=np.int64)
        offset = np.zeros(len(batch), dtype=np.int64)
        ranks = batch["_rank"].to_numpy()
        for length, rows in batch.groupby("length").indices.items():
            first, pieces, start, base = self.by_length[int(length)]
            slot = np.searchsorted(first, ranks[rows], side="right") - 1
            inside = ranks[rows] - first[slot]
            sequence[rows] = start[slot] + inside // pieces[slot]
            offset[rows] = base[slot] + inside % pieces[slot] * int(length)
        return batch.assign(sequence_id=sequence, offset=offset)


def _slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> _Slots:
    rows, used, sequence = [], {}, 0
    for times, combination in patterns:
        offset = 0
        for length, n in combination:
            rows.append((length, used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + times * n
            offset += length * n
        sequence += times
    return _Slots(pd.DataFrame(rows, columns=["length", "first", "pieces", "sequence", "offset"]))
