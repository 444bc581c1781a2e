"""Near-duplicate lines by a segment-partition edit join.

A line that equals an earlier line, or differs from it by at most ``edits`` characters inserted,
deleted or replaced, goes. Of two such lines, cut the shorter into ``edits`` + 1 segments: one of
them stands unchanged in the other, at one of a few places that follow from the lengths. So every
line is indexed by its segments, probes the indexes of lines of its length and a little less with
its own substrings at those places, and the pairs that meet are verified: bits of a word say which
positions within ``edits`` of the diagonal are reachable with 0, 1, ... errors, and a character
moves all of them at once.

Only DataFrame functions. Equal lines are one line from the start. Few lines meet any other; only
their texts are fetched, and their letters counted: an edit changes the counts of two letters at
most, so pairs must agree in all others, which is checked while they are joined. Where many lines
share a segment, they are dealt out by the counts of five groups of letters, one of which two edits
leave alone, and are first compared with the earliest line of each deal: a line found near an
earlier one is settled and compared no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.llm.names import numbered
from civicloom.session import pin

# Letters whose counts are compared; any letters are right, frequent ones tell more.
_LETTERS = "etaoinsrhldcumgpfwybvkxj0123456."
# A segment that more lines share is dealt out by letter counts.
HOT = 64
# Bits of the map of lines to fetch: 2 MB at most are broadcast.
FILTER_BITS = 1 << 24


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int | None) -> DataFrame:
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("_row"),
        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("_line_no", "_line"),
    )
    looked_at = F.col("_line").rlike(r"\S") if min_chars is None else F.char_length("_line") >= min_chars
    return rows.where(looked_at).withColumns({
        "_h1": F.xxhash64("_line"), "_h2": F.xxhash64(F.lit(1), "_line")})


def _shared_places(edits: int) -> list[tuple[int, int, int]]:
    """``(shorter by, segment, shift)``: where a segment of a line that is so much shorter may
    stand in the longer one. A match further left or right would need more edits before or after
    it than are left."""
    return [
        (less, k, shift)
        for less in range(edits + 1)
        for k in range(edits + 1)
        for shift in range(max(-k, less - (edits - k)), min(k, less + (edits - k)) + 1)
    ]


def _key(wide: str, less: int, k: int, shift: int, edits: int) -> Column:
    """What the ``k``-th segment of a line that is ``less`` characters shorter is looked up by.
    ``wide`` has four bytes for every character, so that a place is found without counting."""
    own = f"(cast(octet_length({wide}) div 4 as int) - {less})"
    start, end = (f"cast(({own} * {n}) div {edits + 1} as int)" for n in (k, k + 1))
    piece = f"substring({wide}, 4 * ({start} + {shift}) + 1, 4 * ({end} - {start}))"
    return F.expr(f"xxhash64({k}, {own}, {piece})")


def _counts(line: Column, letters: str) -> Column:
    """Counts of up to 16 letters, each modulo 16, as a long."""
    found = F.lit(0).cast("long")
    for k, letter in enumerate(letters):
        # Letters of one byte: bytes are counted faster than characters.
        count = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        found = found.bitwiseOR(F.shiftleft(count.bitwiseAND(15).cast("long"), 4 * k))
    return found


def _letters_apart(one: Column, other: Column) -> Column:
    """How many letters' counts differ."""
    apart = one.bitwiseXOR(other)
    for shift in (1, 2):
        apart = apart.bitwiseOR(F.shiftrightunsigned(apart, shift))
    return F.bit_count(apart.bitwiseAND(F.lit(0x1111111111111111)))


def within_edits(pairs: DataFrame, short: str, long: str, edits: int) -> DataFrame:
    """The rows whose strings, the first not longer, are within ``edits`` edits of each other.

    Bit ``d`` of state ``e`` says that the first ``j - edits + d`` characters of the one can
    become the first ``j`` of the other with at most ``e`` edits. A character keeps the bits where
    it matches; the state of one error less adds itself (replaced), itself one lower (inserted)
    and, after the move, itself one higher (deleted).
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1
    # Exploding makes columns of the characters. Any other expression for them would be moved
    # into the steps and worked out anew for every character.
    chars = F.struct(F.split(short, "").alias("x"), F.split(long, "").alias("y"))
    rows = pairs.withColumn("_chars", F.explode(F.array(chars)))
    xs, ys = F.col("_chars.x"), F.col("_chars.y")
    start = F.struct(*[
        F.lit(sum(1 << (edits + i) for i in range(e + 1))).alias(f"s{e}") for e in range(edits + 1)])

    def step(state: Column, j: Column) -> Column:
        char = F.get(ys, j)
        same = F.lit(0)
        for d in range(width):
            equal = F.coalesce(F.get(xs, j - edits + d) == char, F.lit(False))
            same = same.bitwiseOR(F.when(equal, F.lit(1 << d)).otherwise(F.lit(0)))

        def moved(match: Column) -> Column:
            states = [state["s0"].bitwiseAND(match)]
            for e in range(1, edits + 1):
                less = state[f"s{e - 1}"]
                states.append(
                    state[f"s{e}"].bitwiseAND(match).bitwiseOR(less).bitwiseOR(F.shiftright(less, 1))
                    .bitwiseOR(F.shiftleft(states[-1], 1)).bitwiseAND(F.lit(mask)))
            return F.struct(*[s.alias(f"s{e}") for e, s in enumerate(states)])

        # Once no position can be reached none ever will.
        return F.when(state[f"s{edits}"] == 0, state).otherwise(F.transform(F.array(same), moved)[0])

    less = F.size(ys) - F.size(xs)
    bit = F.lit(0)
    for d in range(edits + 1):
        bit = F.when(less == edits - d, F.lit(1 << d)).otherwise(bit)
    end = F.aggregate(F.sequence(F.lit(0), F.size(ys) - 1), start, step)[f"s{edits}"]
    return rows.where((less <= edits) & (end.bitwiseAND(bit) != 0)).drop("_chars")


def _meeting(lines: DataFrame, edits: int) -> DataFrame:
    """``_h1``, ``_h2`` and ``_size`` of lines for each segment key they share with another line,
    with ``_key``, ``_own`` (whether the key is of a segment of the line itself) and ``_owners``
    (how many such lines the key has)."""
    indexed = [n for n, (less, _, shift) in enumerate(_shared_places(edits)) if less == 0 and shift == 0]
    keyed = lines.select("_h1", "_h2", "_size", F.posexplode("_keys").alias("_slot", "_key"))
    # Dealt by key once: what is counted and what the counts select are the same shuffle.
    dealt = keyed.withColumn("_own", F.col("_slot").isin(indexed)).drop("_slot").repartition("_key")
    live = (
        dealt.groupBy("_key")
        .agg(F.count_if("_own").alias("_owners"), F.min("_h1").alias("_a"), F.max("_h1").alias("_b"),
             F.min("_h2").alias("_c"), F.max("_h2").alias("_d"), F.max("_size").alias("_most"))
        .where((F.col("_owners") > 0) & ((F.col("_a") != F.col("_b")) | (F.col("_c") != F.col("_d")))
               & (F.col("_most") > 0))
        .select("_key", "_owners")
    )
    return dealt.join(live.hint("shuffle_hash"), "_key")


def _likely(found: DataFrame, asked: DataFrame) -> DataFrame:
    """Rows of ``found`` whose hash may be among the ``asked`` ones, before any of them moves: the
    broadcast is a bitmap of ``FILTER_BITS`` bits, however many lines are asked for."""
    spot = F.pmod("_h1", F.lit(FILTER_BITS)) + 1
    bits = asked.select(F.bitmap_bucket_number(spot).alias("_bucket"), F.bitmap_bit_position(spot).alias("_bit"))
    bits = bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    placed = found.withColumn("_bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(bits), "_bucket")
    bit = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return placed.where(F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1).drop("_bucket", "_bits")


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """The later line ``(_h1, _h2)`` of each pair that is within the edits."""
    sides = [texts.select(*[F.col(f"_{name}").alias(f"{side}_{name}") for name in ("h1", "h2", "place", "line")])
             for side in ("short", "long")]
    together = pairs.join(sides[0], ["short_h1", "short_h2"]).join(sides[1], ["long_h1", "long_h2"])
    near = within_edits(together, "short_line", "long_line", edits)
    short_later = F.col("short_place") > F.col("long_place")
    return near.select(*[
        F.when(short_later, F.col(f"short_{name}")).otherwise(F.col(f"long_{name}")).alias(f"_{name}")
        for name in ("h1", "h2")]).distinct()


_PAIR = ["short_h1", "short_h2", "long_h1", "long_h2"]


def near_earlier(lines: DataFrame, found: DataFrame, place: Column, edits: int) -> DataFrame:
    """``(_h1, _h2)`` of the lines that are within ``edits`` edits of an earlier one.

    ``lines`` has one row per line: ``_h1``, ``_h2``, ``_size`` and ``_keys``, in the order of the
    shared places; ``found`` has the lines' texts at all their places, which ``place`` gives."""
    members = pin(_meeting(lines, edits), "line-members")
    asked = pin(members.select("_h1", "_h2").distinct(), "lines-asked")
    texts = pin(
        _likely(found, asked).groupBy("_h1", "_h2")
        .agg(F.min(place).alias("_place"), F.first("_line").alias("_line"))
        .join(asked, ["_h1", "_h2"], "left_semi"),
        "line-texts",
    )
    line, half = F.col("_line"), len(_LETTERS) // 2
    counts = texts.select(
        "_h1", "_h2", "_place", _counts(line, _LETTERS[:half]).alias("_some"), _counts(line, _LETTERS[half:]).alias("_others"))
    # Two edits change four letters at most: one of five groups is as it was.
    groups = 2 * edits + 1

    def nibbles(group: int) -> int:
        mask = sum(15 << (4 * k) for k in range(group, half, groups))
        return mask - (1 << 64) if mask >> 63 else mask

    deals = F.array(*[F.xxhash64(F.lit(g), F.col("_some").bitwiseAND(F.lit(nibbles(g)).cast("long")),
                                 F.col("_others").bitwiseAND(F.lit(nibbles(g)).cast("long"))) for g in range(groups)])
    one = F.array(F.lit(0).cast("long"))
    dealt = pin(
        members.join(counts, ["_h1", "_h2"])
        .withColumn("_deal", F.explode(F.when(F.col("_owners") > HOT, deals).otherwise(one))).drop("_owners"),
        "line-deals",
    )
    # First everything against the earliest line of its deal.
    shared = ["_key", "_deal"]
    first = dealt.groupBy(*shared).agg(
        F.min_by(F.struct("_h1", "_h2", "_size", "_some", "_others"), "_place").alias("_first"))
    beside = dealt.select(*shared, "_h1", "_h2", "_size", "_some", "_others").join(first, shared)
    apart = _letters_apart(F.col("_some"), F.col("_first._some")) + _letters_apart(F.col("_others"), F.col("_first._others"))
    own_short = F.col("_size") <= F.col("_first._size")
    stars = beside.where(
        (F.abs(F.col("_size") - F.col("_first._size")) <= edits) & (apart <= 2 * edits)
        & ((F.col("_h1") != F.col("_first._h1")) | (F.col("_h2") != F.col("_first._h2"))))
    stars = stars.select(*[
        F.when(own_short if side == "short" else ~own_short, F.col(f"_{name}")).otherwise(F.col(f"_first._{name}"))
        .alias(f"{side}_{name}") for side in ("short", "long") for name in ("h1", "h2")]).distinct()
    settled = pin(_verified(stars, texts, edits), "lines-settled")
    # Then those not settled against all that share a segment and a deal with them.
    open_ = dealt.join(settled.withColumn("_settled", F.lit(True)), ["_h1", "_h2"], "left").withColumn(
        "_settled", F.col("_settled").isNotNull())
    names = ["h1", "h2", "place", "size", "some", "others", "settled"]
    short = open_.where("_own").select(*shared, *[F.col(f"_{name}").alias(f"short_{name}") for name in names])
    long = open_.select(*shared, *[F.col(f"_{name}").alias(f"long_{name}") for name in names])
    less = F.col("long_size") - F.col("short_size")
    apart = _letters_apart(F.col("short_some"), F.col("long_some")) + _letters_apart(F.col("short_others"), F.col("long_others"))
    later = F.when(F.col("short_place") > F.col("long_place"), F.col("short_settled")).otherwise(F.col("long_settled"))
    different = (F.col("short_h1") != F.col("long_h1")) | (F.col("short_h2") != F.col("long_h2"))
    met = less.between(0, edits) & different & (apart <= 2 * edits) & ~later
    pairs = short.join(long, shared).where(met).select(*_PAIR).distinct()
    return settled.union(_verified(pin(pairs, "line-pairs"), texts, edits)).distinct()


def repeated_lines(docs: DataFrame, *, edits: int = 2, min_chars: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Lines that go: ``_id``, ``_row`` (the document, by id and a hash of id and text) and
    ``removed`` (numbers of its lines from 0, ascending). Documents that lose none are not listed.

    Lines are what line feeds divide. A line goes if an equal line, or one within ``edits`` edits,
    stands first in an earlier place; documents are in order of their id (null first) and that
    hash. Blank lines always stay, and lines of less than ``(edits + 1) ** 2`` characters go for
    equal ones only. With ``min_chars``, all shorter lines stay. Rows equal in id and text are one
    document. Null texts have no lines.
    """
    segments_from = (edits + 1) ** 2
    if min_chars is not None and min_chars < segments_from:
        raise ValueError("segments must be longer than the edits")
    found = _lines(docs, id_col, text_col, min_chars)
    place = F.struct("_id", "_row", "_line_no").alias("_place")
    size = F.char_length("_line")
    # Exploding makes columns of them; as expressions they would be worked out once per key.
    wide = F.struct("_h1", "_h2", place, size.alias("_size"), F.when(size >= segments_from, F.encode("_line", "UTF-32")).alias("_wide"))
    keys = F.array(*[_key("_wide", *p, edits) for p in _shared_places(edits)])
    lines = pin(
        found.select(F.explode(F.array(wide)).alias("_of")).select("_of.*")
        .withColumn("_keys", F.when(F.col("_wide").isNotNull(), keys)).drop("_wide")
        .groupBy("_h1", "_h2").agg(
            F.min("_place").alias("_place"), F.count("*").alias("_n"), F.first("_size").alias("_size"),
            F.first("_keys").alias("_keys")),
        "lines",
    )
    gone = near_earlier(lines.where(F.col("_size") >= segments_from), found, place, edits).withColumn("_gone", F.lit(True))
    ruled = pin(
        lines.select("_h1", "_h2", "_place", "_n").join(gone, ["_h1", "_h2"], "left")
        .where(F.col("_gone") | (F.col("_n") > 1))
        .select("_h1", "_h2", F.when(F.col("_gone").isNull(), F.col("_place")).alias("_kept")),
        "line-rules",
    )
    return (
        found.select("_id", "_row", "_line_no", "_h1", "_h2", place)
        .join(ruled, ["_h1", "_h2"]).where(~F.col("_place").eqNullSafe(F.col("_kept")))
        .groupBy("_id", "_row").agg(F.array_sort(F.collect_set("_line_no")).alias("removed"))
    )


def line_report(docs: DataFrame, *, edits: int = 2, min_chars: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_lines`` (0 for a null text), ``n_removed`` and
    ``removed`` (see ``repeated_lines``). Texts are not moved."""
    removed = repeated_lines(docs, edits=edits, min_chars=min_chars, id_col=id_col, text_col=text_col)
    text = F.col(text_col)
    plain = docs.select(
        F.col(id_col).alias("_own"), F.xxhash64(F.col(id_col), text).alias("_row"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.split(text, "\n", -1))).alias("n_lines"))
    none = F.array().cast("array<int>")
    return (
        plain.join(removed, ["_row"], "left").where("_id <=> _own or _id is null")
        .select(F.col("_own").alias(id_col), "n_lines",
                F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
                F.coalesce("removed", none).alias("removed"))
    )


def drop_repeated_lines(docs: DataFrame, *, edits: int = 2, min_chars: int | None = None, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that go (see ``repeated_lines``), in the same columns. A
    document of which no character but white space is left goes too, unless it lost no line."""
    rows, name = numbered(docs)
    own_id, own_text = name[id_col], name[text_col]
    removed = repeated_lines(rows, edits=edits, min_chars=min_chars, id_col=own_id, text_col=own_text)
    text = F.col(own_text)
    kept = F.expr("array_join(filter(_lines, (line, k) -> not array_contains(_removed, k)), '\\n')")
    joined = (
        rows.withColumn("_row", F.xxhash64(own_id, own_text))
        .join(removed.select("_row", F.col("_id").alias("_removed_id"), F.col("removed").alias("_removed")),
              ["_row"], "left")
        .where(F.col("_removed").isNull() | F.col("_removed_id").eqNullSafe(F.col(own_id)))
        .withColumn("_lines", F.split(text, "\n", -1))
        .withColumn(own_text, F.when(F.col("_removed").isNull(), text).otherwise(kept))
    )
    left = joined.where(F.col("_removed").isNull() | F.col(own_text).rlike(r"\S"))
    return left.select(*rows.columns).toDF(*docs.columns)
