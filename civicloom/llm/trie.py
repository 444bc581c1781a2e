"""The prefix trie of conversations, built by a van Emde Boas recursion.

Cut the trie at half its depth: the prefixes that reach the cut are named, the upper half is a trie
of its own, and below every name hangs a lower trie; all of them are cut at half their depth in the
same way, until they are one turn deep. The halves of one size do not need each other's names, so a
round names the cuts of all tries of that size at once, and the rounds are as many as the binary
logarithm of the longest conversation. What a prefix is compared by, from the trie's root to the
cut, is one digest per conversation, built from pairs of digests of half the size.

A node's name is the smallest conversation below it. Totals of subtrees come together in the other
direction: as two halves are put together again, what the lower tries sum up to is grafted onto
the names they hang from and goes to all their ancestors in the upper trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.turns import in_order, mark_of
from civicloom.session import pin

# Conversation ids that are joined before they are sent on to be hashed.
_CHUNK = 4096


def rebuilt(conversations: DataFrame, *, group: int = 100, heads: int = 6) -> DataFrame:
    """Turns ``(conv, depth, mark, n_chars)`` of rebuilt conversations, and for each conversation
    a row of depth 0 without mark.

    The first h turns of conversation ``c - c % group`` come before c's own turns after its first
    h; h is the CRC-32 of c's decimal, modulo ``heads``. Turns go by ``turn``, null first, equal
    ones by the SHA-256 of role and text. Null roles and texts are empty; rows without ``conv_id``
    belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), mark_of(role, text).alias("mark"),
        F.char_length(text).cast("long").alias("n_chars"))
    numbered, starts = in_order(turns, "conv", "turn", "mark")
    starts = pin(starts, "conversation-starts")
    own = numbered.join(starts.select("conv", "start"), "conv").select(
        "conv", (F.col("number") - F.col("start")).alias("place"), "mark", "n_chars")
    base, taken = F.col("conv") - F.col("conv") % group, F.crc32(F.col("conv").cast("string")) % heads
    asked = starts.select("conv", base.alias("base"), taken.alias("taken"), "rows")
    # At most ``heads`` - 1 turns of few conversations.
    first = pin(own.where((F.col("conv") % group == 0) & (F.col("place") < heads - 1)).withColumnRenamed("conv", "base"), "heads")
    sizes = first.groupBy("base").agg(F.count("*").alias("there"))
    asked = pin(
        asked.join(sizes, "base", "left")
        .withColumn("head", F.least("taken", F.coalesce("there", F.lit(0)))), "rebuilt-heads")
    begun = asked.join(first, "base").where("place < head").select(
        "conv", (F.col("place") + 1).alias("depth"), "mark", "n_chars")
    rest = own.join(asked.select("conv", "taken", "head"), "conv").where("place >= taken").select(
        "conv", (F.col("place") - F.col("taken") + F.col("head") + 1).alias("depth"), "mark", "n_chars")
    roots = asked.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("mark"),
                         F.lit(0).cast("long").alias("n_chars"))
    return begun.union(rest).union(roots)


def _digests(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For each size 1, 2, 4, ... the digests ``(conv, part, digest)`` of whole parts of that many
    turns; part 0 begins with the first turn."""
    found = [turns.where("depth > 0").select("conv", (F.col("depth") - 1).alias("part"), F.col("mark").alias("digest"))]
    for _ in range(levels - 1):
        even = F.col("part") % 2 == 0
        pairs = found[-1].groupBy("conv", F.expr("part div 2").alias("part")).agg(
            F.max(F.when(even, F.col("digest"))).alias("one"), F.max(F.when(~even, F.col("digest"))).alias("other"))
        whole = pairs.where("one is not null and other is not null")
        found.append(pin(whole.select("conv", "part", F.unhex(F.sha2(F.concat("one", "other"), 256)).alias("digest")), "digests"))
    return found


def name_prefixes(turns: DataFrame, depth: int, root: int) -> DataFrame:
    """``(conv, depth, name)`` for every conversation and every depth it has, 0 included: the
    smallest conversation with the same turns so far. ``depth`` is the greatest of all, ``root`` the
    smallest conversation."""
    levels = depth.bit_length()
    roots = turns.where("depth = 0").select("conv", "depth", F.lit(root).cast("long").alias("name"))
    known = [pin(roots, "names")]
    digests = _digests(turns, levels) if levels else []
    for level in reversed(range(levels)):
        size = 1 << level
        # Parts in even places begin where a trie of this round has its root.
        cuts = digests[level].where("part % 2 = 0").select(
            "conv", (F.col("part") * size).alias("root_depth"), "digest")
        above = known[0]
        for names in known[1:]:
            above = above.union(names)
        tops = above.select("conv", F.col("depth").alias("root_depth"), F.col("name").alias("root"))
        cuts = pin(cuts.join(tops, ["conv", "root_depth"]), "cuts")
        # Written, so that its true size is known: a small one is broadcast, and in a join of two
        # shuffles a prefix that many share is split.
        named = pin(cuts.groupBy("root_depth", "root", "digest").agg(F.min("conv").alias("name")), "cut-names")
        found = cuts.join(named, ["root_depth", "root", "digest"])
        known.append(pin(found.select("conv", (F.col("root_depth") + size).alias("depth"), "name"), "names"))
    whole = known[0]
    for names in known[1:]:
        whole = whole.union(names)
    return whole


def _graft(totals: DataFrame, parents: DataFrame, paths: DataFrame, depth: int) -> DataFrame:
    """``totals`` of nodes ``(depth, name, n_leaves, saved)`` summed over subtrees.

    ``parents`` has the ``(depth, name, parent)`` of every node but the root, ``paths`` the
    ``(conv, depth, name)`` of the conversations that name a node."""
    sums = ["n_leaves", "saved"]
    size = 1
    while size < depth:
        two = 2 * size
        # Roots of the lower tries: the first depth of the second half of each pair.
        below = totals.where((F.col("depth") - 1) % two == size).join(parents, ["depth", "name"])
        grafts = below.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("cut")).agg(
            *[F.sum(name).alias(name) for name in sums])
        above = paths.where((F.col("depth") - 1) % two < size).select(
            "conv", "depth", "name", (F.expr(f"(depth - 1) div {two}") * two + size).alias("cut"))
        up = grafts.join(above, ["conv", "cut"]).select("depth", "name", *sums)
        totals = pin(totals.union(up).groupBy("depth", "name").agg(*[F.sum(name).alias(name) for name in sums]), "grafted")
        size = two
    return totals


_JOINED = pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_HASHED = pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("ends_sha256", pa.string())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's ids as one text each, of at most ``_CHUNK`` ids."""
    node, ids = None, []

    def row() -> tuple:
        return (*node, ids[0], ",".join(map(str, ids)))

    for batch in batches:
        rows = []
        for depth, name, conv in zip(*(batch.column(n).to_pylist() for n in ("depth", "name", "conv"))):
            if node != (depth, name) or len(ids) == _CHUNK:
                if ids:
                    rows.append(row())
                node, ids = (depth, name), []
            ids.append(conv)
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], schema=_JOINED)
    if ids:
        yield pa.record_batch([pa.array(c) for c in zip(*[row()])], schema=_JOINED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None
    for batch in batches:
        rows = []
        for depth, name, ids in zip(*(batch.column(n).to_pylist() for n in ("depth", "name", "ids"))):
            if node == (depth, name):
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                rows.append((*node, digest.hexdigest()))
            node, digest = (depth, name), hashlib.sha256(ids.encode())
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], schema=_HASHED)
    if node is not None:
        yield pa.record_batch([pa.array(c) for c in zip(*[(*node, digest.hexdigest())])], schema=_HASHED)


def hash_members(ends: DataFrame) -> DataFrame:
    """``(depth, name, ends_sha256)``: the SHA-256 of each node's ``conv`` ids, ascending and
    joined by commas. Ids are sorted in ranges and joined to long texts by many tasks; only these
    texts are brought together, since a digest is sequential."""
    run = ends.repartitionByRange("depth", "name", "conv").sortWithinPartitions("depth", "name", "conv")
    texts = run.select("depth", "name", "conv").mapInArrow(_joined, "depth long, name long, first long, ids string")
    dealt = texts.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return dealt.mapInArrow(_hashed, "depth long, name long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (see ``rebuilt``): ``conv_id``, ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``. Every conversation has a row of depth 0 and rows of depth 1, 2, ... without a
    gap. Without conversations there is no node.

    Hot prefixes are partial sums; where names go back to conversations, a prefix that a third of
    them share is split by adaptive execution.
    """
    turns = pin(turns, "trie-turns")
    depth, least = turns.agg(F.max("depth"), F.min("conv")).first()
    schema = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
              "saved_tokens long, ends_sha256 string")
    if depth is None:
        return turns.sparkSession.createDataFrame([], schema)
    names = pin(name_prefixes(turns, depth, least), "trie-names")
    lengths = turns.groupBy("conv").agg(F.max("depth").alias("depth"))
    naming = names.where("conv = name").select("conv").distinct()
    paths = pin(names.join(naming, "conv"), "trie-paths")
    own = paths.where("conv = name")
    above = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    sizes = names.groupBy("depth", "name").agg(F.count("*").alias("n_convs"))
    nodes = (
        own.join(turns.select("conv", "depth", "n_chars"), ["conv", "depth"])
        .join(above, ["conv", "depth"], "left")
        .join(sizes, ["depth", "name"])
        .select("depth", "name", "parent", "n_convs", ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"))
    )
    nodes = pin(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = pin(nodes.join(children, ["depth", "name"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")
    start = nodes.where("depth > 0").select(
        "depth", "name", (F.col("n_children") == 0).cast("long").alias("n_leaves"), "saved")
    totals = _graft(start, nodes.where("depth > 0").select("depth", "name", "parent"), paths.where("depth > 0"), depth)
    # The root: what the tries below it sum up to, or a leaf itself.
    below = totals.where("depth = 1").withColumns({"depth": F.lit(0).cast("long"), "name": F.lit(least).cast("long")})
    root = nodes.where("depth = 0").select("depth", "name", (F.col("n_children") == 0).cast("long").alias("n_leaves"), "saved")
    totals = totals.union(root.union(below).groupBy("depth", "name").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")))
    ends = hash_members(names.join(lengths, ["conv", "depth"]))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.drop("saved").join(totals, ["depth", "name"]).join(ends, ["depth", "name"], "left")
        .select(F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                F.coalesce("ends_sha256", none).alias("ends_sha256"))
    )
